"""Global shuffle of a table into shards in two passes, with DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regiolume.session import scratch_folder

#: Buckets whose offsets are summed by one task.
OFFSETS_AT_ONCE = 4096


def _offsets(counts: DataFrame) -> DataFrame:
    """Rows in all buckets before each one: sums inside runs of buckets, then over the few runs."""
    run = (F.col("bucket") / OFFSETS_AT_ONCE).cast("long")
    within = Window.partitionBy("run").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("run", run)
    runs = counts.groupBy("run").agg(F.sum("n").alias("all"))
    runs = runs.select("run", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("base"))
    inside = counts.select("run", "bucket", F.coalesce(F.sum("n").over(within), F.lit(0)).alias("inner"))
    return inside.join(runs, "run").select("bucket", (F.col("base") + F.col("inner")).alias("offset"))


def shuffle_into_shards(
    docs: DataFrame,
    shards: int = 24,
    seed: int = 17,
    bucket_bytes: int = 8 << 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    folder: str | None = None,
) -> DataFrame:
    """Write all rows in random order into ``shards`` folders and read them back; counts are at most one apart.

    Pass one scatters the rows by a seeded hash of id and text into buckets of about ``bucket_bytes``, as many as
    the input needs. Pass two puts one bucket at a time into memory and shuffles it with ``shuffle``, which is
    a Fisher-Yates permutation. Buckets stand one after another; a row's place in that order gives its shard, a
    run of places, and its ``slot`` in it. So each bucket is written to one or two shards.

    Returns the id and the text under their names with ``slot`` and ``shard``. A NULL text stays NULL and a NULL id
    NULL; repeated rows are kept, each with its own slot. Rows that agree in id and text share a bucket, all others
    are spread evenly, copies of one text under many ids included. An empty table gives empty shards.
    """
    spark = docs.sparkSession
    whole = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    size = F.octet_length(whole).cast("long") + 8
    n, n_bytes = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    buckets = max(1, math.ceil(n_bytes / bucket_bytes))
    place = F.xxhash64(F.lit(seed), F.col("id"), whole)
    rows = rows.select("id", "text", F.pmod(place, F.lit(buckets)).alias("bucket"), place.alias("place"))
    offsets = _offsets(rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")))
    packed = rows.repartition("bucket").groupBy("bucket").agg(
        F.sort_array(F.collect_list(F.struct("place", "id", "text"))).alias("rows")
    )
    least, longer = divmod(n, shards)  # the first shards take one row more
    rank, cut = F.col("rank"), longer * (least + 1)
    early = rank < cut
    dealt = (
        packed.join(offsets, "bucket")
        .select("offset", F.posexplode(F.shuffle("rows", F.lit(seed))).alias("pos", "row"))
        .select((F.col("offset") + F.col("pos")).alias("rank"), "row.id", "row.text")
        .select(
            "id",
            "text",
            F.when(early, F.expr(f"rank % {least + 1}")).otherwise(F.expr(f"(rank - {cut}) % {max(1, least)}"))
            .cast("long").alias("slot"),
            F.when(early, F.expr(f"rank div {least + 1}"))
            .otherwise(F.expr(f"{longer} + (rank - {cut}) div {max(1, least)}"))
            .cast("int").alias("shard"),
        )
    )
    folder = folder or scratch_folder(spark, "shards")
    dealt.write.partitionBy("shard").option("compression", "zstd").parquet(folder)
    back = spark.read.schema(dealt.schema).parquet(folder)
    return back.select(F.col("id").alias(id_col), F.col("text").alias(text_col), "slot", "shard")
