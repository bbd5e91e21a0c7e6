"""The corpus pipeline: stages that each apply one operator to what the stage before kept.

Each stage takes ``(spark, docs, sf_dir)``; ``docs`` has the columns of ``documents``. NULL values, empty and very long
texts, repeated rows and empty tables have the results that the operators define; further columns pass through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiolume.llm.common import BLANKS, id_or_least, inner_prefix, may_be_in, ship, table
from regiolume.llm.decontam import find_contamination
from regiolume.llm.jaccard import jaccard_components
from regiolume.llm.language import identify, train
from regiolume.llm.line_dedup import dedup_lines
from regiolume.llm.packing import id_lengths, pack_documents
from regiolume.session import stage


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language. The label is the declared language, the source the host. What the operator rejects
    (text without letters, or in no language of the model) goes; the few rejected ids are staged, so that
    Spark knows their size when it joins. Where no document has a label there is nothing to learn from, and all stay."""
    ship(spark)
    own = inner_prefix(docs)
    row, mark = f"{own}id", f"{own}mark"
    given = docs.select(id_or_least("doc_id").alias(row), F.xxhash64("text").alias(mark), "text", "lang", "source")
    model = train(given.select(F.col(row).alias("key"), "text", "lang"))
    if not model.languages:
        return docs
    found = identify(
        given, model, F.col("text"), F.col("lang"), F.lit(None).cast("string"), F.col("source"), keep=[row, mark]
    )
    rejected = stage(found.where(~F.col("accepted")).select(row, mark).distinct(), "rejected")
    same = (id_or_least("doc_id") == F.col(row)) & (F.xxhash64("text") == F.col(mark))
    return docs.join(rejected, same, "left_anti")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that an earlier document has; ``n_chars`` follows the text. Documents of which no word is left,
    such as exact copies, leave the pipeline here."""
    ship(spark)
    emptied = (F.col("n_dropped") > 0) & (F.btrim("text", F.lit(BLANKS)) == "")
    kept = dedup_lines(docs).where(~emptied)
    columns = [F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns]
    return kept.select(columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by a similarity of 0.8 on shingles of five words, the row of the smallest id.

    Every row is a document of its own, whether it repeats another, shares its id or has none. Where ids are shared, rows are
    numbered in order of id and text and written with their numbers, so that exactly one of each group stays; elsewhere
    the ids are the numbers and nothing is copied. Texts without words are linked with nothing."""
    ship(spark)
    key = f"{inner_prefix(docs)}key"
    numbered = docs.withColumn(key, id_or_least("doc_id"))
    if not numbered.groupBy(key).count().where("count > 1").isEmpty():
        order = [id_or_least("doc_id"), F.xxhash64("text")]
        ordered = docs.repartitionByRange(*order).sortWithinPartitions(*order)
        numbered = stage(ordered.withColumn(key, F.monotonically_increasing_id()), "numbered")
    found = jaccard_components(numbered, width=5, percent=80, id_col=key)
    copies = stage(found.where("not (id <=> component_id)").select(id_or_least("id").alias(key)), "copies")
    # Most texts are no copies and stay where they are read.
    mark = f"{key}_may_go"
    marked = may_be_in(numbered, copies, key, mark)
    kept = marked.where(~F.col(mark)).unionByName(marked.where(F.col(mark)).join(copies, key, "left_anti"))
    return kept.select([F.col(f"`{c}`") for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a test item occurs."""
    ship(spark)
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.where(F.col("n_hit") == 0).select([F.col(f"`{c}`") for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every remaining document, or of its pieces, in a training sequence."""
    ship(spark)
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return pack_documents(id_lengths(docs, vocabulary)).withColumnRenamed("id", "doc_id")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]
#: Language scores, the order of packing and the connected components of a whole corpus have no usable SQL; the tests
#: hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
