"""Lexical search, curve packing and whitening against brute force, on awkward rows."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from regiolume.llm import curve_packing, whitening
from regiolume.llm.pieces import PieceCoder
from regiolume.llm.term_search import length_norms, rank_documents, sum_by

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
NASTY = ["a", "Z", "the", " ", "  ", "\n", "\n\n", "\t", ".", "'s", "can't", "|", "<|endoftext|>", "<|startoftext|>", "é", "É.", "×",
         "÷", " ", "　", "日本", "…", "1", "²", "ΑΣ", "́", "\x00", "\x7f", "🙂", "\r\n", "_", "$", "'ll", " "]


def nasty_texts(n, seed=1):
    r = random.Random(seed)
    return ["".join(r.choice(NASTY) for _ in range(r.randrange(40))) for _ in range(n)]


# ------------------------------------------------------------ lexical search


def terms(text):
    return [t.translate({c: c + 32 for c in range(65, 91)}) for t in TERM.findall(text or "")]


def search_rows():
    r = random.Random(5)
    words = ["the", "The", "of", "Zürich", "naïve", "x2", "日本", "rare1", "rare2", "ΑΣ"]
    docs = [(k, "".join(r.choice(words) + r.choice([" ", ", ", "\n", "-", "'"]) for _ in range(r.randrange(30)))) for k in range(80)]
    docs += [(90, None), (91, ""), (92, " .,\n"), (93, "the " * 20_000 + "rare1"), (None, "rare2 of the"), (None, "rare2 of the"), docs[3], docs[3]]
    docs += [(200 + k, docs[7][1]) for k in range(25)]  # equal scores
    items = [(1, "The rare1 of"), (1, "x2 the"), (2, None), (3, ""), (4, "nowhere words"), (5, "ΑΣ 日本! naïve"), (None, "Zürich"), (6, "the"), (6, "the")]
    return docs, items


def ranked_by_hand(docs, items, k=10):
    words = [terms(t) for _, t in docs]
    n_docs, n_all = sum(bool(w) for w in words), sum(map(len, words))
    df = Counter(t for w in words for t in set(w))
    held = defaultdict(set)
    for item, text in items:
        held[item] |= set(terms(text))
    out = set()
    for item, own in held.items():
        scored = []
        for (doc, _), w in zip(docs, words, strict=True):
            tf, m = Counter(w), 100 - 90 + (90 * len(w) * n_docs) // n_all
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * tf[t]) // (1000 * tf[t] + 8 * m))
                for t in own if tf[t]
            )
            if score > 0:
                scored.append((-score, doc is not None, doc or 0, doc))
        out |= {(item, i + 1, doc, -s) for i, (s, _, _, doc) in enumerate(sorted(scored, key=lambda x: x[:3])[:k])}
    return out


@pytest.mark.parametrize("block_letters", [1 << 20, 30])
def test_lexical_search(spark, block_letters):
    docs, items = search_rows()
    df = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in docs], "doc_id long, text string, rank int, score int, item string")
    asked = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, term int")
    got = rank_documents(df, asked, block_letters=block_letters)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert {tuple(r) for r in got.collect()} == ranked_by_hand(docs, items)
    assert rank_documents(df.limit(0), asked).count() == 0
    assert rank_documents(df, asked.limit(0)).count() == 0


def test_search_beyond_64_bits():
    sizes = np.array([10**7, 5], np.int64)
    assert length_norms(sizes, 10**12, 10**15).tolist() == [10 + 90 * int(n) * 10**12 // 10**15 for n in sizes]
    keys, values = np.array([3, 9, 3]), np.array([2, 5, 1])
    for size in (10, 1 << 30):
        assert [x.tolist() for x in sum_by(keys, values, size)] == [[3, 9], [3, 5]]


# ------------------------------------------------------------- curve packing


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_encode_as_whole_texts(name):
    path = public_tokenizers.path(name)
    texts = [*nasty_texts(6000), None, "", "x" * 5000, "a b " * 3000]
    coder, whole = PieceCoder(path), Tokenizer.from_file(path)
    want = [e.ids for e in whole.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    for _ in range(2):  # the second time from memory
        got = []
        for _, ids, sizes in coder.encode(pa.array(texts)):
            got += [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]
        assert got == want
    assert coder.lengths(pa.array(texts)).tolist() == [len(w) for w in want]
    assert coder.lengths(pa.array([], pa.string())).tolist() == []


@pytest.mark.parametrize("n", [2, 3, 4])
def test_hilbert_curve_visits_neighbours(n):
    bits = 3
    points = np.array(np.meshgrid(*[range(1 << bits)] * n)).reshape(n, -1).T
    keys = curve_packing.hilbert_keys(points, bits)
    assert sorted(keys.tolist()) == list(range(len(points)))
    assert (np.abs(np.diff(points[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_tail_has_no_padding():
    for left in range(1, 1024):
        sizes = np.diff(np.concatenate([[5], curve_packing.tail_bounds(5, left)]))
        assert sizes.sum() == left and all(x & (x - 1) == 0 for x in sizes.tolist())


def test_curve_packing(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    coder = Tokenizer.from_file(path)
    rows = list(enumerate(nasty_texts(150, 2))) + [(500, None), (501, ""), (502, "word " * 9000), (None, "no id"), (7, "known id")]
    rows += [(None, "")] * 400 + [rows[3]] * 3  # more than a third of all rows are one
    df = spark.createDataFrame([(i, t, 0, 0) for i, t in rows], "doc_id long, text string, row int, curve int")
    got = curve_packing.pack_along_curve(df, path).collect()
    whole = Counter()
    codes = {}
    for i, t in rows:
        ids = np.array([*coder.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        whole[(i, len(ids), zlib.crc32(ids.tobytes()))] += 1
        codes.setdefault((i, len(ids)), []).append(ids)
    assert sum(r.length for r in got) == sum(k[1] * n for k, n in whole.items())
    one = Counter((r.doc_id, r.doc_tokens, r.ids_crc32) for r in got if r.length == r.doc_tokens)
    assert all(whole[k] >= n for k, n in one.items())
    parts = defaultdict(list)
    for r in got:
        assert any(zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for ids in codes[(r.doc_id, r.doc_tokens)])
        if r.doc_id == 502:
            parts[r.doc_id].append((r.start, r.length))
    assert [a for a, _ in sorted(parts[502])] == np.cumsum([0] + [n for _, n in sorted(parts[502])])[:-1].tolist()
    filled = defaultdict(list)
    for r in got:
        filled[r.sequence_id].append((r.offset, r.length))
    for held in filled.values():
        held.sort()
        used = sum(n for _, n in held)
        assert [a for a, _ in held] == np.cumsum([0] + [n for _, n in held])[:-1].tolist()
        assert used <= 1024 and used & (used - 1) == 0
    assert curve_packing.pack_along_curve(df.limit(0), path).count() == 0


def test_sequences_hold_neighbours(spark):
    """Documents of two vocabularies, dealt in turns: nearly every sequence has documents of one."""
    r = random.Random(8)
    kinds = [["river", "stone", "water", "bridge", "valley"], ["tensor", "kernel", "vector", "matrix", "gradient"]]
    rows = [(k, " ".join(r.choice(kinds[k % 2]) for _ in range(60))) for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = curve_packing.pack_along_curve(df, public_tokenizers.path("byte_bpe_50k.json")).collect()
    kinds_of = defaultdict(set)
    for x in got:
        kinds_of[x.sequence_id].add(x.doc_id % 2)
    assert sum(len(k) == 1 for k in kinds_of.values()) >= 0.9 * len(kinds_of)


# ----------------------------------------------------------------- whitening


def test_minres_solves_side_by_side():
    r = np.random.default_rng(2)
    m = r.normal(size=(30, 30))
    m = m + m.T
    shifts, right = np.array([0.3, 50.0, -4.0]), r.normal(size=(30, 3))
    none = np.zeros((30, 0))
    x = whitening.minres_block(lambda v: m @ v, shifts, none, np.zeros((30, 3)), right, 200, 1e-13)
    assert np.abs(m @ x - x * shifts - right).max() < 1e-8


@pytest.mark.parametrize("kind", ["plain", "wide", "low rank", "one", "equal", "short", "close"])
def test_jacobi_davidson(kind):
    r = np.random.default_rng(3)
    z = {
        "plain": lambda: r.normal(size=(500, 64)), "wide": lambda: r.normal(size=(500, 200)),
        "low rank": lambda: r.normal(size=(500, 6)) @ r.normal(size=(6, 40)), "one": lambda: r.normal(size=(500, 1)) * np.ones((1, 30)),
        "equal": lambda: np.linalg.qr(r.normal(size=(500, 60)))[0], "short": lambda: r.normal(size=(50, 3)),
        "close": lambda: r.normal(size=(500, 48)) * np.concatenate([np.full(24, 1 + 1e-9), np.full(24, 0.01)]),
    }[kind]()
    v = z.T @ z / len(z)
    values, vectors = whitening.jacobi_davidson(lambda u: z.T @ (z @ u) / len(z), z.shape[1], 16)
    want = np.linalg.eigvalsh(v)[::-1][:16]
    assert len(values) == min(16, z.shape[1])
    assert np.abs(values - want).max() <= 1e-13 * want[0]
    assert np.linalg.norm(v @ vectors - vectors * values, axis=0).max() <= 1e-13 * want[0]
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13


def whitened_by_hand(x, fit):
    n, s = len(fit), fit.sum(axis=0)
    z = (n * fit - s) / n
    v = z.T @ z / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:16], u[:, ::-1][:, :16]
    return ((n * x - s) ** 2).sum(axis=1), ((n * x - s) / n) @ u / np.sqrt(e), e / np.trace(v), n


def test_whitening(spark):
    r = np.random.default_rng(6)
    plain = [(k, [float(c) for c in r.normal(size=20) * (1 + k % 5)]) for k in range(300)]
    rows = plain + [(1000 + k, plain[9][1]) for k in range(150)] + [(None, plain[4][1]), plain[0], plain[0]]
    odd = [(400, None), (401, [1.0, None] + [0.0] * 18), (402, [float("nan")] * 20), (403, [float("-inf")] * 20), (404, [])]
    short = [(600 + k, [float(k % 2), float(k)]) for k in range(6)] + [(700, [3.0])]  # lists of their own; one vector gives nothing
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows + odd + short], "vec_id long, embedding array<double>, n int, x int")
    got = whitening.whiten(df).collect()
    assert {r.vec_id for r in got} & {400, 401, 402, 403, 404, 700} == set()
    whole = lambda some: np.array([np.floor(64 * np.array(v)).astype(np.int64) + 1_000_000 for _, v in some])
    for part, k in ((rows, 16), (short[:6], 2)):
        names = {i for i, _ in part}
        mine = [r for r in got if r.vec_id in names]
        assert len(mine) == k * len(part)
        deviation, white, explained, n = whitened_by_hand(whole(part), np.unique(whole(part), axis=0))
        assert {r.n for r in mine} == {n} and len({r.identity_error for r in mine}) == 1 and mine[0].identity_error < 1e-10
        for c in range(k):
            have = sorted((r.vec_id is not None, r.vec_id or 0, r.deviation, r.whitened) for r in mine if r.component == c + 1)
            order = sorted(range(len(part)), key=lambda j: (part[j][0] is not None, part[j][0] or 0))
            assert [h[2] for h in have] == deviation[order].tolist()
            a, b = np.array([h[3] for h in have]), white[order, c]
            assert np.abs(a - b * np.sign(a @ b)).max() < 1e-9
            assert all(abs(r.explained - explained[c]) < 1e-12 for r in mine if r.component == c + 1)
    assert whitening.whiten(df.limit(0)).count() == 0


def test_whitening_of_huge_entries(spark):
    """Whole numbers stay exact beyond 64 bits; a deviation that does not fit is NULL."""
    rows = [(1, [1e12, 0.0]), (2, [-1e12, 1.0]), (3, [1e300, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = whitening.whiten(df).collect()
    assert {r.vec_id for r in got} == {1, 2, 3} and all(r.deviation is None for r in got if r.vec_id == 3)
    assert all(np.isfinite(r.whitened) for r in got)
