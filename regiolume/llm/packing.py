"""Best-fit packing of documents into sequences of several permitted lengths."""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiolume.llm.common import BATCH_ROWS, BLANKS
from regiolume.llm.pieces import piece_coder
from regiolume.session import arrow_rows, stage

CAPACITIES = (512, 1024, 2048, 4096)
RESULT = "id long, piece int, n_tokens long, bucket long, bin int, start int, capacity int"


def cheapest(costs: dict[int, float], need: int, left: int) -> int:
    """The bin size to open for a piece of ``need`` tokens while ``left`` tokens, this piece included, have no place yet:
    the least cost for each token that can come into it."""
    return min((c for c in costs if c >= need), key=lambda c: (costs[c] / min(c, left), c))


def pack(lengths: list[int], costs: dict[int, float]) -> list[tuple[int, int, int]]:
    """Bin, start and capacity for each length; the lengths come in descending order.

    Every piece goes into the open bin it fills best; if it fits none, the least-cost size is opened. At the end each
    bin shrinks to the smallest permitted size that holds its contents.
    """
    sizes = sorted(costs)
    rooms: list[int] = []  # the rooms that open bins have, ascending, each once
    bins: dict[int, list[int]] = {}  # room: bins
    used: list[int] = []
    left, out = sum(lengths), []
    for n in lengths:
        at = bisect_left(rooms, n)
        if at < len(rooms):
            room = rooms[at]
            b = bins[room].pop()
            if not bins[room]:
                del bins[room], rooms[at]
        else:
            room, b = cheapest(costs, n, left), len(used)
            used.append(0)
        out.append((b, used[b]))
        used[b] += n
        left -= n
        if room > n:
            if room - n not in bins:
                insort(rooms, room - n)
                bins[room - n] = []
            bins[room - n].append(b)
    final = [sizes[bisect_left(sizes, u)] for u in used]
    return [(b, start, final[b]) for b, start in out]


def _packer(costs: dict[int, float]):
    def run(group: pa.Table) -> pa.Table:
        n = group["n_tokens"].to_numpy()
        order = np.lexsort((
            group["piece"].to_numpy(), group["mark"].to_numpy(), group["id"].fill_null(-(2**63)).to_numpy(), -n
        ))
        group = group.take(pa.array(order))
        bins, starts, sizes = zip(*pack(n[order].tolist(), costs), strict=True)
        made = {"bin": bins, "start": starts, "capacity": sizes}
        out = group.select(["id", "piece", "n_tokens", "bucket"])
        for name, values in made.items():
            out = out.append_column(name, pa.array(values, pa.int32()))
        return out

    return run


def token_lengths(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, mark`` (a hash of the text) and ``n_tokens``: words between blanks, and one end mark. For tables whose words are
    the tokens; a sequence of a model with a vocabulary is packed by ``id_lengths``."""
    whole = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    words = F.size(F.split(F.btrim(whole, F.lit(BLANKS)), r"[ \t\n\x0B\f\r]+", -1)).cast("long")
    words = F.when(F.btrim(whole, F.lit(BLANKS)) == "", 0).otherwise(words)
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(whole).alias("mark"), (words + 1).alias("n_tokens")
    )


def _counter(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = piece_coder(path)
        for batch in batches:
            sizes = pa.array(coder.lengths(batch.column("text")) + 1)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("mark"), sizes], ["id", "mark", "n_tokens"])

    return run


def id_lengths(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, mark`` (a hash of the text) and ``n_tokens``: the ids that ``write_token_ids`` writes for the text, with the end id.

    Each task encodes the texts as it reads them and keeps the lengths only. ``tokenizer`` is the path of a vocabulary file
    that all executors have, of a kind that ``PieceCoder`` supports.
    """
    whole = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    given = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(whole).alias("mark"), whole.alias("text"))
    return given.mapInArrow(_counter(tokenizer), "id long, mark long, n_tokens long")


def pack_documents(
    lengths: DataFrame,
    capacities: tuple[int, ...] = CAPACITIES,
    overhead: int = 64,
    bucket_rows: int = 50_000,
) -> DataFrame:
    """Pack documents (``id, mark, n_tokens``) into bins of the permitted ``capacities``.

    A bin costs its capacity and ``overhead`` tokens, so that fewer, longer sequences win where they fill up. A document
    longer than the largest capacity is cut into pieces of that size and a rest. Pieces are dealt by
    a hash into buckets of about ``bucket_rows`` and each bucket is packed by one task, longest first; the loss against one
    single bucket is less than a few bins for each bucket.

    Returns ``id, piece`` (from 0), ``n_tokens, bucket, bin`` (within the bucket), ``start`` and ``capacity``. Nothing is
    dropped: a document without text is one end mark, a NULL id is packed like any other, repeated rows each
    have their place, an empty table gives no bins.
    """
    most = max(capacities)
    piece = F.posexplode(F.sequence(F.lit(0).cast("long"), F.expr(f"greatest(n_tokens - 1, 0) div {most}")))
    pieces = lengths.select("id", "mark", "n_tokens", piece.alias("piece", "at")).select(
        "id", "mark", "piece", F.least(F.lit(most).cast("long"), F.col("n_tokens") - F.col("at") * most).alias("n_tokens")
    )
    with arrow_rows(lengths.sparkSession, BATCH_ROWS):
        pieces = stage(pieces, "pieces")
    buckets = max(1, math.ceil(pieces.count() / bucket_rows))
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("id", "mark", "piece"), F.lit(buckets)))
    return dealt.groupBy("bucket").applyInArrow(_packer({c: c + overhead for c in capacities}), RESULT)
