"""Benchmark decontamination: one Aho-Corasick automaton over the windows of all test items."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from itertools import repeat

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regiolume.llm.common import inner_prefix

#: Bytes of words: digits, letters (A-Z become a-z) and everything beyond ASCII; all others part words.
TO_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
RESULT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.LongType())),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType())
    ]))),
])
#: What the workers hold: the automaton and the numbers of its words.
Windows = tuple[ahocorasick.Automaton, dict[bytes, int]]
_AUTOMATA: dict[str, Windows | None] = {}


def build(items: list[tuple[int, bytes]], width: int) -> Windows | None:
    """All windows of all items, over numbers of words: a window has no more nodes than words, however long these are."""
    windows: dict[tuple[int, ...], set[int]] = {}
    known: dict[bytes, int] = {}
    for item, text in items:
        words = [known.setdefault(w, len(known) + 1) for w in text.translate(TO_WORDS).split()]
        for i in range(max(1, len(words) - width + 1) if words else 0):
            windows.setdefault(tuple(words[i : i + width]), set()).add(item)
    if not windows:
        return None
    found = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for window, ids in windows.items():
        found.add_word(window, (len(window), ids))
    found.make_automaton()
    return found, known


def _automaton(name: str, block, width: int) -> Windows | None:
    """Built once per Python worker and block."""
    if name not in _AUTOMATA:
        _AUTOMATA.clear()
        _AUTOMATA[name] = build(block.value, width)
    return _AUTOMATA[name]


def scan(text: bytes, windows: Windows | None) -> tuple[int, list[tuple[int, int]], set[int]]:
    """Number of words, merged runs of hit words, items that occur."""
    words = text.translate(TO_WORDS).split()
    if not words or windows is None:
        return len(words), [], set()
    automaton, known = windows
    found, items = [], set()
    for end, (n, ids) in automaton.iter(tuple(map(known.get, words, repeat(0)))):
        found.append((end - n + 1, end + 1))
        items |= ids
    return len(words), merge(found), items


def merge(runs) -> list[tuple[int, int]]:
    """Overlapping and touching runs as one."""
    out: list[list[int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def to_code_points(text: bytes, runs: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Runs of words as offsets into the original text."""
    word = np.frombuffer(text.translate(TO_WORDS), np.uint8) != 32
    edge = np.diff(np.concatenate(([0], word.view(np.int8), [0])))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    points = np.concatenate(([0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)))
    return [{"start": int(points[starts[a]]), "end": int(points[ends[b - 1]])} for a, b in runs]


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    width: int = 10,
    block_bytes: int = 4 << 20,
    keep: list[str] | None = None,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Find the windows of ``width`` words of test items in documents; a shorter item is one window.

    Words are runs of digits, letters and characters beyond ASCII, with A-Z in lower case. All windows make one
    Aho-Corasick automaton over the numbers of their words, each text is normalised and scanned once, as it is read: no
    shuffle. Items are broadcast in blocks of about ``block_bytes``, whatever their number: a larger set of items is
    dealt to blocks by a hash of the id, and the documents pass one automaton after another in the same task.

    Returns the columns ``keep`` of the documents (all, if not given) with ``n_words``, ``n_hit`` (words inside an
    occurrence), ``items`` (ids of the items that occur, ascending) and ``spans``: runs of hit words as code point
    offsets into the text as it was. A NULL or empty text has no words. Items without words or without id take no
    part; rows of one item id add up. Repeated rows each get their result; empty tables are fine.
    """
    spark = docs.sparkSession
    given = items.select(
        F.col(f"`{item_col}`").cast("long").alias("item"), F.col(f"`{item_text}`").cast("binary").alias("words")
    ).dropna()
    size = given.agg(F.coalesce(F.sum(F.octet_length("words") + 16), F.lit(0))).first()[0]
    n_blocks = max(1, math.ceil(size / block_bytes))
    given = given.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(n_blocks)))
    own = {f.name.lower() for f in RESULT.fields}
    kept = [c for c in (keep if keep is not None else docs.columns) if c.lower() not in own]
    wanted = list(dict.fromkeys([*kept, text_col]))
    out = docs.select([F.col(f"`{c}`") for c in wanted])
    mark = inner_prefix(docs)
    carried = T.StructType([
        T.StructField(f"{mark}runs", T.ArrayType(T.ArrayType(T.LongType()))),
        T.StructField(f"{mark}items", T.ArrayType(T.LongType())),
    ])
    for i in range(n_blocks):
        rows = [(r["item"], bytes(r["words"])) for r in given.where(F.col("block") == i).collect()]
        block, last = spark.sparkContext.broadcast(rows), i == n_blocks - 1
        names = kept if last else wanted
        schema = T.StructType([docs.schema[c] for c in names] + (RESULT if last else carried).fields)
        out = out.mapInArrow(_scanner(block, width, names, text_col, mark, i == 0, last), schema)
    return out


def _scanner(block, width: int, names: list[str], text_col: str, mark: str, first: bool, last: bool):
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(name, block, width)
        for batch in batches:
            texts = batch.column(text_col).cast(pa.binary()).to_pylist()
            runs = [[]] * len(texts) if first else batch.column(f"{mark}runs").to_pylist()
            ids = [[]] * len(texts) if first else batch.column(f"{mark}items").to_pylist()
            rows = []
            for text, old, old_ids in zip(texts, runs, ids, strict=True):
                n, new, found = scan(text or b"", automaton)
                new = merge([*map(tuple, old), *new]) if old else new
                found = sorted(found.union(old_ids)) if old_ids else sorted(found)
                rows.append((n, new, found, to_code_points(text, new) if last and new else []))
            if last:
                result = [
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([sum(b - a for a, b in r[1]) for r in rows], pa.int64()),
                    pa.array([r[2] for r in rows], pa.list_(pa.int64())),
                    pa.array([r[3] for r in rows], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                ]
                added = [f.name for f in RESULT.fields]
            else:
                result = [
                    pa.array([r[1] for r in rows], pa.list_(pa.list_(pa.int64()))),
                    pa.array([r[2] for r in rows], pa.list_(pa.int64())),
                ]
                added = [f"{mark}runs", f"{mark}items"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], *result], [*names, *added])

    return run
