"""Line deduplication across documents, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiolume.llm.common import BLANKS, ascii_lower, id_or_least, inner_prefix
from regiolume.session import stage


def _lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """One row per line whose key is long enough: two hashes of the key, the document, the position."""
    whole = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    lines = docs.select(
        id_or_least(id_col).alias("doc"),
        F.xxhash64(whole).alias("mark"),
        F.posexplode(F.split(whole, "\n", -1)).alias("pos", "line"),
    )
    key = ascii_lower(F.btrim(F.col("line"), F.lit(BLANKS)))
    return (
        lines.select("doc", "mark", "pos", key.alias("key"))
        .where(F.length("key") >= min_chars)
        .select("doc", "mark", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2"))
    )


def dedup_lines(
    docs: DataFrame, min_chars: int = 10, min_docs: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Drop lines that stand in ``min_docs`` documents or more, except in the document of the smallest id.

    A line's key is the line without blanks at its ends and with A-Z in lower case; keys of fewer than
    ``min_chars`` code points are never dropped. Returns the input's columns, the text without the dropped
    lines, and ``n_lines`` and ``n_dropped``.

    Lines are hashed to 128 bits and counted by partial aggregation, so a line that stands everywhere
    reaches the shuffle as one row per task. Only hashes and positions are joined; the join with the
    repeated keys reads them from a staged table, so adaptive execution can split a hot key. A document's
    dropped positions (never more than its lines) meet its text once and the other lines are joined by position.

    A NULL or empty text is one empty line and comes back empty. A NULL id counts as the smallest. Rows
    of one id are one document when they are counted; each row keeps or drops its own lines, so repeated rows
    give equal rows. An empty table gives an empty one.
    """
    lines = _lines(docs, id_col, text_col, min_chars)
    if min_docs == 2:  # two documents or more: the smallest and the largest id differ
        seen = lines.groupBy("h1", "h2").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
        shared = seen.where(F.col("first") < F.col("last")).drop("last")
    else:
        once = lines.select("h1", "h2", "doc").distinct()
        seen = once.groupBy("h1", "h2").agg(F.min("doc").alias("first"), F.count(F.lit(1)).alias("n"))
        shared = seen.where(F.col("n") >= min_docs).drop("n")
    shared = stage(shared, "shared-lines")
    own = inner_prefix(docs)
    doc, mark, gone, row, row_mark, parts, kept_text, n_lines, n_dropped = (
        own + c for c in ("doc", "mark", "gone", "id", "text_mark", "lines", "kept", "n_lines", "n_dropped")
    )
    dropped = (
        lines.join(shared, ["h1", "h2"])
        .where(F.col("doc") > F.col("first"))
        .groupBy("doc", "mark")
        .agg(F.collect_set("pos").alias("gone"))
        .select(F.col("doc").alias(doc), F.col("mark").alias(mark), F.col("gone").alias(gone))
    )
    whole = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    at = docs.select("*", id_or_least(id_col).alias(row), F.xxhash64(whole).alias(row_mark))
    met = at.join(dropped, (F.col(row) == F.col(doc)) & (F.col(row_mark) == F.col(mark)), "left")
    met = met.withColumn(parts, F.split(whole, "\n", -1))
    n = F.size(parts)
    kept = F.array_except(F.sequence(F.lit(0), n - 1), F.col(gone))
    text = F.when(F.col(gone).isNull(), whole).otherwise(
        F.array_join(F.transform(kept, lambda i: F.element_at(parts, i + 1)), "\n")
    )
    out = met.withColumns({
        kept_text: text,
        n_lines: n.cast("long"),
        n_dropped: F.coalesce(F.size(gone), F.lit(0)).cast("long"),
    })
    given = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    return out.select(
        *[F.col(kept_text).alias(c) if c == text_col else F.col(f"`{c}`") for c in given],
        F.col(n_lines).alias("n_lines"),
        F.col(n_dropped).alias("n_dropped"),
    )
