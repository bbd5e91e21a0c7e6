"""Ranked lexical search without an index of the documents: one automaton of all item terms reads the texts."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regiolume.llm.bytes_view import as_bytes, slices
from regiolume.llm.common import LEAST_ID, LOWER, UPPER
from regiolume.llm.decontam import TO_WORDS
from regiolume.session import stage

#: Runs of digits, letters and characters beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TO_WORDS = np.frombuffer(TO_WORDS, np.uint8)
#: Letters of terms, with their two guards, that one automaton holds: about 60 bytes of memory each in a worker.
BLOCK_LETTERS = 2 << 20
COUNTS = "term int, n long"
FOUND = "item_id long, doc_id long, score long"
_BUILT: dict[str, object] = {}


def terms_of(text) -> F.Column:
    """All terms of a text in order, A-Z in lower case; none for NULL."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(TERM), F.lit(0))


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _once(name: str, make):
    """What a worker builds once for each block of items; the block before it is forgotten."""
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = make()
    return _BUILT[name]


def automaton_of(terms: list[str]) -> ahocorasick.Automaton:
    """Every term between blanks, so that only whole words match; a match gives the place of the term."""
    found = ahocorasick.Automaton()
    for i, term in enumerate(terms):
        found.add_word(f" {term.encode().decode('latin-1')} ", i)
    found.make_automaton()
    return found


class Scanner:
    """Reads texts of an Arrow column: terms of each text, and how often each known term occurs in it."""

    def __init__(self, terms: list[str]):
        self.automaton, self.n_terms = automaton_of(terms), len(terms)

    def read(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For slices of rows: first row, terms of each row, then rows, terms and counts of what occurs."""
        for first, data, offsets in slices(*as_bytes(column)):
            n = len(offsets) - 1
            # One blank before, between and behind the texts.
            places = np.arange(len(data)) + 1 + np.repeat(np.arange(n), np.diff(offsets))
            spaced = np.full(len(data) + n + 1, 32, np.uint8)
            spaced[places] = _TO_WORDS[data]
            word = spaced != 32
            starts = np.flatnonzero(word[1:] & ~word[:-1]) + 1
            bounds = offsets[1:] + np.arange(1, n + 1)  # the blank behind each text
            sizes = np.bincount(np.searchsorted(bounds, starts), minlength=n)
            hits = self.automaton.iter(spaced.tobytes().decode("latin-1"))
            flat = np.fromiter(chain.from_iterable(hits), np.int64).reshape(-1, 2)
            rows = np.searchsorted(bounds, flat[:, 0])
            keys, counts = np.unique(rows * self.n_terms + flat[:, 1], return_counts=True)
            yield first, sizes, keys // self.n_terms, keys % self.n_terms, counts


def _count(name: str, block):
    """How many texts hold each term; under -1 the texts with terms and under -2 all their terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _once(name, lambda: Scanner(block.value[0]))
        held, totals = np.zeros(scanner.n_terms, np.int64), np.zeros(2, np.int64)
        for batch in batches:
            for _, sizes, _, found, _ in scanner.read(batch.column("text")):
                held += np.bincount(found, minlength=scanner.n_terms)
                totals += (np.count_nonzero(sizes), sizes.sum())
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([some, [-1, -2]]), pa.int32()), pa.array(np.concatenate([held[some], totals]))],
            ["term", "n"],
        )

    return run


def length_norms(sizes: np.ndarray, n_docs: int, n_all: int) -> np.ndarray:
    """100 - 90 + 90 * n * N div L, exact also where the product needs more than 64 bits."""
    if 90 * int(sizes.max(initial=0)) * n_docs < 2**63:
        return 10 + 90 * sizes * n_docs // n_all
    return np.array([10 + 90 * int(n) * n_docs // n_all for n in sizes], np.int64)


def best_of(items: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """Each item's k best, equal scores by ascending id."""
    order = np.lexsort((ids, -scores, items))
    items, ids, scores = items[order], ids[order], scores[order]
    best = np.arange(len(items)) - np.searchsorted(items, items) < k
    return items[best], ids[best], scores[best]


def sum_by(keys: np.ndarray, values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys below ``size`` that have values, and the sum of each in whole numbers."""
    if size <= 1 << 22:
        sums = np.zeros(size, np.int64)
        np.add.at(sums, keys, values)
        found = np.flatnonzero(sums)
        return found, sums[found]
    found, place = np.unique(keys, return_inverse=True)
    sums = np.zeros(len(found), np.int64)
    np.add.at(sums, place, values)
    return found[sums > 0], sums[sums > 0]


def _rank(name: str, block, weights: np.ndarray, n_docs: int, n_all: int, k: int):
    """The k best texts of each item in a task; weights are in the order of the block's terms."""

    def prepare():
        terms, items, places, names = block.value
        return Scanner(terms), items, np.searchsorted(places, np.arange(len(terms) + 1)), pa.array(names, pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, items_of, starts, names = _once(name, prepare)
        n_items = len(names)
        best = tuple(np.empty(0, np.int64) for _ in range(3))
        least = np.zeros(n_items, np.int64)  # the score of each item's k-th best so far
        for batch in batches:
            ids = batch.column("id").fill_null(LEAST_ID).to_numpy()
            for first, sizes, rows, found, counts in scanner.read(batch.column("text")):
                norms = length_norms(sizes, n_docs, n_all)[rows]
                scores = weights[found] * (1_000_000_000 * counts // (1000 * counts + 8 * norms))
                # A term's score goes to every item that holds the term.
                fan = starts[found + 1] - starts[found]
                at = np.repeat(starts[found] - np.cumsum(fan) + fan, fan) + np.arange(fan.sum())
                keys, sums = sum_by(np.repeat(rows, fan) * n_items + items_of[at], np.repeat(scores, fan), len(sizes) * n_items)
                items = keys % n_items
                good = sums >= np.maximum(least[items], 1)
                new = (items[good], ids[first + keys[good] // n_items], sums[good])
                best = best_of(*(np.concatenate(x) for x in zip(best, new, strict=True)), k)
                full = np.flatnonzero(np.bincount(best[0], minlength=n_items) == k)
                least[full] = best[2][np.searchsorted(best[0], full, side="right") - 1]
        yield pa.RecordBatch.from_arrays(
            [names.take(pa.array(best[0])), pa.array(best[1]), pa.array(best[2])], ["item_id", "doc_id", "score"]
        )

    return run


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    block_letters: int = BLOCK_LETTERS,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The ``k`` documents that score highest for each item: ``item_id, rank`` (from 1), ``doc_id, score``.

    An item's score for a document is the sum over the item's distinct terms that the document holds of
    ``w * ((10^9 * tf) div (1000 * tf + 8 * m))``, with ``w = floor(1000 * ln((2N + 2) / (2df + 1)))`` and
    ``m = 10 + (90 * n * N) div L``; N counts documents with a term, L all their terms, n one document's. Only scores above
    0 are ranked; equal scores go by ascending id.

    The terms of all items, each between blanks, make one Aho-Corasick automaton. It reads every text twice: once for
    N, L and each term's document frequency, once to score. A task keeps the ``k`` best of each item and nothing else,
    so no postings are written or shuffled, whatever the length of the texts. What is broadcast is bounded by
    ``block_letters`` letters of terms: more items make more blocks of whole items, one after another (an item whose own
    terms exceed the bound is a block for itself). A block's ranks are written to the shared folder before the next begins.

    A NULL or empty text has no terms and is never ranked. Rows of one item id are one item; rows without id are the item
    NULL. Items without terms have no rows. Every row of the documents is a document of its own, repeated rows too; a
    NULL id counts as the smallest one and comes back as NULL. Empty tables give no rows. Further columns are not read.
    """
    spark = docs.sparkSession
    given = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    held = items.select(
        F.col(f"`{item_col}`").cast("long").alias("item"), F.explode(terms_of(F.col(f"`{item_text}`"))).alias("term")
    ).distinct()
    held = stage(held, "item-terms")
    letters = held.agg(F.coalesce(F.sum(F.octet_length("term") + 2), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(letters / block_letters))
    block = F.pmod(F.xxhash64("item"), F.lit(blocks))
    ranked = []
    for i in range(blocks):
        rows = held.where(block == i).select("item", "term").collect()
        if rows:
            ranked.append(_rank_block(given, [tuple(r) for r in rows], k))
    if not ranked:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    out = ranked[0]
    for more in ranked[1:]:
        out = out.unionAll(more)
    return out


def _rank_block(given: DataFrame, rows: list[tuple[int | None, str]], k: int) -> DataFrame:
    spark = given.sparkSession
    terms = sorted({term for _, term in rows})
    names = sorted({item for item, _ in rows}, key=lambda i: (i is not None, i or 0))
    place, number = {t: i for i, t in enumerate(terms)}, {item: i for i, item in enumerate(names)}
    places, held = np.array(sorted((place[term], number[item]) for item, term in rows), np.int64).T
    block = spark.sparkContext.broadcast((terms, held, places, names))
    counted = given.mapInArrow(_count(uuid.uuid4().hex, block), COUNTS).groupBy("term").agg(F.sum("n").alias("n"))
    counts = {r["term"]: r["n"] for r in counted.collect()}  # no more than the block has terms
    n_docs, n_all = counts.get(-1, 0), counts.get(-2, 0)
    weights = np.array([weight(n_docs, counts.get(i, 0)) for i in range(len(terms))], np.int64)
    found = given.mapInArrow(_rank(uuid.uuid4().hex, block, weights, n_docs, n_all, k), FOUND)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    doc_id = F.nullif("doc_id", F.lit(LEAST_ID)).alias("doc_id")
    done = stage(best.select("item_id", "rank", doc_id, "score"), "ranked")
    block.destroy()
    return done
