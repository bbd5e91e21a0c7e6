"""Token ids of documents in coded files, and back."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from regiolume.llm.id_coder import BLOCK, decode, encode
from regiolume.llm.pieces import piece_coder
from regiolume.session import stage

#: Ids that one frame gathers before it is coded; a document is never parted. Each step of the coder costs about the same
#: for few blocks as for some thousand.
FRAME_IDS = 8 << 20
FRAME = (
    "part int, frame int, n_ids long, bits int, block int, doc_ids array<long>, doc_tokens array<long>, payload binary, "
    "lengths array<int>, checks array<long>"
)
FRAME_TYPES = [
    pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(),
    pa.list_(pa.int32()), pa.list_(pa.int64()),
]
FRAME_NAMES = ["part", "frame", "n_ids", "bits", "block", "doc_ids", "doc_tokens", "payload", "lengths", "checks"]


def _frames(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = piece_coder(path)
        part, number = TaskContext.get().partitionId(), 0
        held: list[np.ndarray] = []
        docs: list[int | None] = []
        sizes: list[int] = []

        def frame() -> pa.RecordBatch:
            ids = np.concatenate(held)
            bits = max(1, int(ids.max()).bit_length())
            block = min(BLOCK, max(512, len(ids) // 512))  # small frames in shorter blocks: at least some hundred at once
            payload, lengths, checks = encode(ids, bits, block)
            row = (part, number, len(ids), bits, block, docs, sizes, payload, lengths, checks)
            return pa.RecordBatch.from_arrays(
                [pa.array([x], t) for x, t in zip(row, FRAME_TYPES, strict=True)], FRAME_NAMES
            )

        for batch in batches:
            names = batch.column("id").to_pylist()
            for first, ids, n in coder.encode(batch.column("text")):
                held.append(np.insert(ids, np.cumsum(n), end_id))
                docs += names[first : first + len(n)]
                sizes += (n + 1).tolist()
                if sum(map(len, held)) >= FRAME_IDS:
                    yield frame()
                    number += 1
                    held, docs, sizes = [], [], []
        if docs:
            yield frame()

    return run


def write_token_ids(
    docs: DataFrame, tokenizer: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode whole texts and write their ids, each document followed by ``end_id``, as coded frames; read them back.

    Documents are dealt by ranges of their id and sorted, so that file order is id order (NULL first; rows of one id by
    text). A task encodes its texts and codes some millions of ids at a time as one frame of independent blocks, see
    ``id_coder``; a frame is a row of a Parquet table in the shared folder, with its documents, block lengths
    and checksums. ``part`` and ``frame`` give the order. ``tokenizer`` is the path of a vocabulary file that all
    executors have, of a kind that ``PieceCoder`` supports.

    A NULL or empty text is its end id alone. Repeated rows are kept. An empty table has no frames.
    """
    given = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    ordered = given.repartitionByRange("id").sortWithinPartitions("id", F.xxhash64("text"))
    return stage(ordered.mapInArrow(_frames(tokenizer, end_id), FRAME), "token-ids")


def _frame_starts(frames: DataFrame) -> DataFrame:
    """Ids in all frames before each: sums in a part, then over the parts."""
    heads = frames.select("part", "frame", "n_ids")
    inside = Window.partitionBy("part").orderBy("frame").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = heads.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    heads = heads.select("part", "frame", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("inner"))
    return heads.join(parts, "part").select("part", "frame", (F.col("base") + F.col("inner")).alias("start"))


READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i] for name in batch.schema.names}
            lengths, checks = row["lengths"].as_py(), row["checks"].as_py()
            n, bits, block = (row[name].as_py() for name in ("n_ids", "bits", "block"))
            ids = decode(row["payload"].as_py(), lengths, checks, n, bits, block)
            sizes = np.array(row["doc_tokens"].as_py(), np.int64)
            ends = np.cumsum(sizes)
            raw = memoryview(ids.astype("<u4")).cast("B")
            crc = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [row["doc_ids"].values, pa.array(row["start"].as_py() + ends - sizes), pa.array(sizes), pa.array(crc, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def read_token_ids(frames: DataFrame) -> DataFrame:
    """Per document ``doc_id, start`` (ids of all documents before it), ``n_tokens, ids_crc32``, from decoded frames.

    A frame whose checksum is wrong fails.
    """
    return frames.join(_frame_starts(frames), ["part", "frame"]).mapInArrow(_read, READ)
