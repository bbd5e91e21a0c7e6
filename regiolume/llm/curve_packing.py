"""Packing along a space-filling curve: documents of like words share sequences."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from regiolume.llm.bytes_view import mix
from regiolume.llm.pieces import piece_coder
from regiolume.session import stage

#: Buckets of the hashed document vector, dimensions of the curve and bits of each.
BUCKETS, DIMENSIONS, BITS = 4096, 3, 21
CODED = "id long, curve long, n_tokens long, wide boolean, ids binary"
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, curve long"
)
#: Ids that are laid out at once.
_AT_ONCE = 4 << 20


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places on the Hilbert curve of points with whole coordinates below ``2 ** bits``.

    Going from the highest bit down, the axes are exchanged and mirrored as the curve turns; what is left is the Gray code of
    the place, whose bits are then interleaved.
    """
    x = [c.astype(np.int64) for c in points.T]
    n = len(x)
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for i in range(n):
            turned = (x[i] >> b & 1).astype(bool)
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(turned, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        flip ^= np.where(x[-1] >> b & 1, (1 << b) - 1, 0)
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | ((x[i] ^ flip) >> b & 1)
    return key


def projection(n_ids: int, seed: int) -> np.ndarray:
    """What an id adds to the projected vector of its document: the row of its bucket in a random matrix."""
    rows = np.random.default_rng(seed).normal(size=(BUCKETS, DIMENSIONS))
    return rows[(mix(np.arange(n_ids, dtype=np.uint64) + np.uint64(seed + 1)) % np.uint64(BUCKETS)).astype(np.int64)]


def curve_keys(ids: np.ndarray, sizes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Places on the curve of documents: their counts of hashed ids, over their length, projected."""
    points = np.zeros((len(sizes), DIMENSIONS))
    some = sizes > 0
    if some.any():
        starts = (np.cumsum(sizes) - sizes)[some]
        points[some] = np.add.reduceat(rows[ids], starts, axis=0) / sizes[some][:, None]
    # Means of normal numbers: beyond 4 deviations the grid ends.
    grid = np.clip((points + 4) / 8 * (1 << BITS), 0, (1 << BITS) - 1)
    return hilbert_keys(grid.astype(np.int64))


def _coder(path: str, end_id: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = piece_coder(path)
        rows = projection(coder.tokenizer.get_vocab_size(), seed)
        wide = max(len(rows) - 1, end_id) > 65_535
        for batch in batches:
            for first, ids, sizes in coder.encode(batch.column("text")):
                ends = np.cumsum(sizes)
                whole = np.insert(ids, ends, end_id).astype("<u4" if wide else "<u2")
                at = np.concatenate([[0], ends + np.arange(1, len(ends) + 1)]) * whole.itemsize
                cells = pa.Array.from_buffers(
                    pa.large_binary(), len(sizes), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(whole)]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(first, len(sizes)), pa.array(curve_keys(ids, sizes, rows)),
                        pa.array(sizes + 1), pa.array(np.full(len(sizes), wide)), cells.cast(pa.binary()),
                    ],
                    ["id", "curve", "n_tokens", "wide", "ids"],
                )

    return run


def tail_bounds(start: int, left: int) -> np.ndarray:
    """Ends of the last sequences of a task: the rest in powers of two, the largest first, so that none is padded."""
    sizes = [1 << b for b in range(left.bit_length() - 1, -1, -1) if left >> b & 1]
    return start + np.cumsum(np.array(sizes, np.int64))


class _Stream:
    """Documents one after another, cut where a sequence is full; what does not fill one waits for the next."""

    def __init__(self, capacity: int):
        self.capacity, self.sequences = capacity, TaskContext.get().partitionId() << 33
        self.docs = {c: np.empty(0, np.int64) for c in ("id", "null", "curve", "n_tokens", "start", "size")}
        self.ids = np.empty(0, np.uint32)

    def add(self, docs: dict[str, np.ndarray], ids: np.ndarray, last: bool = False) -> pa.RecordBatch:
        docs = {c: np.concatenate([self.docs[c], docs[c]]) for c in self.docs}
        ids = np.concatenate([self.ids, ids.astype(np.uint32)])
        ends = np.cumsum(docs["size"])
        full = len(ids) // self.capacity * self.capacity
        bounds = np.arange(self.capacity, full + 1, self.capacity)
        if last:
            bounds = np.concatenate([bounds, tail_bounds(full, len(ids) - full)])
            full = len(ids)
        stops = np.union1d(ends[ends < full], bounds)
        starts = np.concatenate([[0], stops[:-1]]).astype(np.int64)[: len(stops)]
        doc = np.searchsorted(ends, starts, side="right")
        sequence = np.searchsorted(bounds, starts, side="right")
        first = np.concatenate([[0], bounds])[sequence]
        raw = memoryview(ids.astype("<u4")).cast("B")
        crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]
        values = {
            "doc_id": pa.array(docs["id"][doc], mask=docs["null"][doc].astype(bool)),
            "start": docs["start"][doc] + starts - (ends - docs["size"])[doc], "length": stops - starts,
            "ids_crc32": np.array(crc, np.int64), "doc_tokens": docs["n_tokens"][doc],
            "sequence_id": self.sequences + sequence, "offset": starts - first, "curve": docs["curve"][doc],
        }
        self.sequences += len(bounds)
        rest = ends > full
        begun = np.maximum(full - (ends - docs["size"])[rest], 0)
        self.docs = {c: v[rest] for c, v in docs.items()}
        self.docs["start"] = self.docs["start"] + begun
        self.docs["size"] = self.docs["size"] - begun
        self.ids = ids[full:]
        return pa.RecordBatch.from_arrays([pa.array(v) for v in values.values()], list(values))


def _packer(capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = _Stream(capacity)
        for batch in batches:
            sizes = batch.column("n_tokens").to_numpy()
            kinds = ["<u4" if w else "<u2" for w in batch.column("wide").to_pylist()]
            cells = batch.column("ids")
            first, upto = 0, np.cumsum(sizes)
            while first < len(sizes):
                base = upto[first - 1] if first else 0
                end = max(first + 1, int(np.searchsorted(upto, base + _AT_ONCE, side="right")))
                part = slice(first, end)
                ids = np.concatenate([np.frombuffer(cells[i].as_buffer(), kinds[i]) for i in range(first, end)])
                named = batch.column("id").slice(first, end - first)
                docs = {
                    "id": named.fill_null(0).to_numpy(), "null": named.is_null().to_numpy(False).astype(np.int64),
                    "curve": batch.column("curve").to_numpy()[part], "n_tokens": sizes[part],
                    "start": np.zeros(end - first, np.int64), "size": sizes[part],
                }
                yield stream.add(docs, ids)
                first = end
        if len(stream.ids):
            yield stream.add({c: v[:0] for c, v in stream.docs.items()}, stream.ids[:0], last=True)

    return run


def pack_along_curve(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 1024,
    end_id: int = 0,
    seed: int = 12,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pack documents into sequences of ``capacity`` tokens, in the order of a Hilbert curve through their vectors.

    A task encodes whole texts and hashes their ids into the buckets of a document vector, which, over its length and projected
    by a seeded random matrix to three dimensions, gives the document's place on the Hilbert curve. Documents with like
    words lie close to each other there. Rows are dealt to tasks by ranges of the curve and sorted; each task lays its
    documents one after another and cuts at every full sequence, so that a sequence holds neighbours. The rest of a task
    is cut at powers of two: no sequence is padded. Equal documents share a place on the curve, so the ranges
    go on with id and row number, and a document that a third of all rows repeat is spread over tasks. The encoded rows
    are written once with their numbers: a task that is run again finds the same rows.

    Returns for each piece of a document ``doc_id, start`` (ids of the document before it), ``length, ids_crc32, doc_tokens``
    (with ``end_id``, which follows every document), ``sequence_id, offset`` (in the sequence) and ``curve``. A NULL or empty
    text is its end id alone, at the middle of the curve. NULL ids come back as NULL, repeated rows are packed each, an empty table gives
    no pieces. ``tokenizer`` is the path of a vocabulary file that all executors have, of a kind that ``PieceCoder`` supports.
    """
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    given = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    coded = given.mapInArrow(_coder(tokenizer, end_id, seed), CODED)
    coded = stage(coded.withColumn("row", F.monotonically_increasing_id()), "coded")
    order = ["curve", "id", "row"]
    return coded.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_packer(capacity), PIECES)
