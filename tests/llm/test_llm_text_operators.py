"""Line dedup, decontamination, repeats, Jaccard join and packing against brute force on awkward rows."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from regiolume.llm.decontam import find_contamination
from regiolume.llm.jaccard import jaccard_components
from regiolume.llm.line_dedup import dedup_lines
from regiolume.llm.packing import cheapest, pack, pack_documents, token_lengths
from regiolume.llm.repeats import remove_repeats

SCHEMA = "doc_id long, text string, n_lines string, spans string, id string, lang string"


def table(spark, rows):
    """Documents with columns whose names clash with those of results and of inner steps."""
    return spark.createDataFrame([(i, t, "x", "y", "z", None) for i, t in rows], SCHEMA)


def words(n, seed, common=12):
    r = random.Random(seed)
    return [f"w{r.randrange(common)}" if r.random() < 0.3 else f"t{r.randrange(10**6)}" for _ in range(n)]


def awkward():
    """NULLs, empty and long texts, ties, repeated rows, exact and near copies, a hot line, many languages."""
    base = words(120, 1)
    rows = [(1, " ".join(base)), (2, " ".join(base)), (9, " ".join(base)), (9, " ".join(base))]
    for k in range(14):
        near = list(base)
        near[(k * 7) % 120] = f"changed{k}"
        rows.append((20 + k, " ".join(near)))
    rows += [(3, None), (4, ""), (5, "   \t "), (6, "one"), (7, "One\x0b"), (8, "two words"), (None, "no id at all here, no"), (10, "ab\n\ncd\n")]
    hot = "A line that is everywhere"
    rows += [(40 + k, f"{hot}\nown line number {k} of this\n  {hot.upper()} \r\nÉté à la plage n° {k % 3} ici") for k in range(30)]
    rows += [(80, " ".join(words(6000, 2))), (81, " ".join(words(6000, 2)[:3000])), (82, "aaaa" * 400), (83, "aaaa" * 300 + "b")]
    rows += [(90, "日本語のテキスト、" * 12), (91, "x" + "日本語のテキスト、" * 12), (None, "no id at all here, no")]
    return rows


def blanks(s):
    return s.strip(" \t\n\x0b\x0c\r")


def low(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


def least(i):
    return -(2**63) if i is None else i


def lines_by_hand(rows, least_docs=2):
    key = lambda line: low(blanks(line))
    seen = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            seen[key(line)].add(least(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        gone = lambda x: len(key(x)) >= 10 and len(seen[key(x)]) >= least_docs and least(i) != min(seen[key(x)])
        kept = [x for x in lines if not gone(x)]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return Counter(out)


@pytest.mark.parametrize("least_docs", [2, 3])
def test_line_dedup(spark, least_docs):
    rows = awkward()
    out = dedup_lines(table(spark, rows), min_docs=least_docs)
    assert out.columns == ["doc_id", "text", "spans", "id", "lang", "n_lines", "n_dropped"]
    got = Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in out.collect())
    assert got == lines_by_hand(rows, least_docs)
    assert dedup_lines(table(spark, [])).count() == 0


def normal(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text or ""))


def contamination_by_hand(rows, items, width=10):
    windows = defaultdict(set)
    for item, text in items:
        w = normal(text)
        if item is not None and w:
            for i in range(max(1, len(w) - width + 1)):
                windows[tuple(w[i : i + width])].add(item)
    out = []
    for i, t in rows:
        w, hit, found = normal(t), set(), set()
        for a in range(len(w)):
            for n in {len(x) for x in windows}:
                if tuple(w[a : a + n]) in windows and a + n <= len(w):
                    hit |= set(range(a, a + n))
                    found |= windows[tuple(w[a : a + n])]
        out.append((i, len(w), len(hit), tuple(sorted(found))))
    return Counter(out)


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_decontamination(spark, block_bytes):
    """One automaton, and several blocks one after another."""
    rows = awkward()
    long = words(6000, 2)
    items = [(1, "Two, WORDS!"), (2, " ".join(long[100:125])), (3, None), (4, "..."), (None, "no id at all here no"),
             (5, "ici"), (6, "日本語のテキスト 日本語"), (2, "own line number 3 of this a line that is everywhere"), (7, " ".join(long[110:118]))]
    items = spark.createDataFrame([(*x, "clash") for x in items], "item_id long, text string, n_hit string")
    given = [(r.item_id, r.text) for r in items.collect()]
    out = find_contamination(table(spark, rows), items, block_bytes=block_bytes)
    assert "spans" in out.columns and out.columns.count("spans") == 1
    got = out.collect()
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got) == contamination_by_hand(rows, given)
    for r in got:  # the offsets lead to the hit words in the text as it was
        assert sum(len(normal(r.text[s.start : s.end])) for s in r.spans) == r.n_hit
    assert find_contamination(table(spark, []), items).count() == 0
    none = find_contamination(table(spark, rows), items.limit(0), keep=["doc_id"])
    assert none.where("n_hit > 0").count() == 0 and none.count() == len(rows)


def test_automaton_is_small():
    """Windows share no letters in memory: a window has no more nodes than words."""
    from regiolume.llm.decontam import build

    r = random.Random(5)
    text = " ".join("".join(r.choices("abcdefghij", k=12)) for _ in range(20_000)).encode()
    automaton, known = build([(1, text)], 10)
    size = automaton.get_stats()
    assert size["nodes_count"] <= 10 * 20_000 + 1 and len(known) <= 20_000
    # A block of 4 MB with as many words of 5 letters: below 500 MB.
    assert size["total_size"] / len(text) * (4 << 20) * 13 / 6 < 500e6


def test_inner_names_as_columns(spark):
    """Columns named as the inner ones of the operators stay as they are."""
    names = ["__id", "__doc", "__mark", "__text_mark", "__gone", "__lines", "__kept", "__n_lines", "__n_dropped", "__runs", "__items", "__key"]
    rows = [(1, "the same long line\nown"), (2, "the same long line\nother"), (None, None)]
    docs = spark.createDataFrame([(*x, *names) for x in rows], "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    out = dedup_lines(docs)
    assert [r.text for r in out.orderBy("doc_id").collect()] == ["", "the same long line\nown", "other"]
    assert all(r[n] == n for r in out.collect() for n in names)
    items = spark.createDataFrame([(1, "same long"), (2, "other")], "item_id long, text string")
    for block_bytes in (1 << 20, 20):
        found = find_contamination(docs, items, block_bytes=block_bytes).orderBy("doc_id").collect()
        assert [(r["items"], r.n_hit) for r in found] == [([], 0), ([1], 2), ([1, 2], 3)]
        assert all(r[n] == n for r in found for n in names)


def repeats_by_hand(rows, n=50):
    first = {}
    for i, t in rows:
        x = (t or "").encode()
        for a in range(len(x) - n + 1):
            s = x[a : a + n]
            first[s] = min(first.get(s, least(i)), least(i))
    out = []
    for i, t in rows:
        x = (t or "").encode()
        gone = bytearray(len(x))
        for a in range(len(x) - n + 1):
            if first[x[a : a + n]] < least(i):
                gone[a : a + n] = b"\1" * n
        kept = bytes(c for c, g in zip(x, gone, strict=True) if not g)
        out.append((i, len(x), sum(gone), len([s for s in bytes(gone).split(b"\0") if s]), kept))
    return Counter(out)


@pytest.mark.parametrize("chunk_bytes", [1 << 22, 9000])
def test_repeats(spark, chunk_bytes):
    rows = awkward()
    out = remove_repeats(table(spark, rows), chunk_bytes=chunk_bytes).collect()
    got = Counter((r.id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in out)
    assert got == repeats_by_hand(rows)
    assert remove_repeats(table(spark, [])).count() == 0


def sets_by_hand(text, width):
    w = re.findall(r"[^\x20\x09-\x0D]+", low(text or ""))
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def components_by_hand(rows, width, percent):
    """Id, size and component of each row; rows that share an id are documents of their own."""
    ids, docs = [least(i) for i, _ in rows], [sets_by_hand(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(rows)):
        for b in range(a + 1, len(rows)):
            if docs[a] and docs[b] and 100 * len(docs[a] & docs[b]) >= percent * len(docs[a] | docs[b]):
                x, y = sorted((find(a), find(b)), key=lambda i: (ids[i], i))
                root[y] = x
    back = lambda i: None if i == -(2**63) else i
    return Counter((back(ids[i]), len(docs[i]), back(ids[find(i)])) for i in range(len(rows)))


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (1, 50)])
def test_jaccard(spark, width, percent):
    rows = awkward()
    out = jaccard_components(table(spark, rows), width, percent)
    assert Counter(tuple(r) for r in out.collect()) == components_by_hand(rows, width, percent)
    assert jaccard_components(table(spark, [])).count() == 0


def test_jaccard_shared_ids(spark):
    """Rows of one id are documents of their own: each has its own links, none is left out, and the id links nothing."""
    base = [words(60, 70 + k, 40) for k in range(4)]
    near = lambda k: " ".join(base[k][:59] + ["other"])
    rows = [(7, " ".join(base[0])), (7, " ".join(base[1])), (7, " ".join(base[1])), (3, near(1)), (9, near(0)), (None, " ".join(base[2]))]
    rows += [(None, " ".join(base[3])), (1, near(3)), (2, near(2)), (5, None), (5, "")] + [(8, " ".join(base[0]))] * 40
    out = jaccard_components(table(spark, rows), 3, 80)
    assert Counter(tuple(r) for r in out.collect()) == components_by_hand(rows, 3, 80)


def test_jaccard_large_regions(spark, monkeypatch):
    """Regions larger than a block join by classes of size and blocks of shares."""
    from regiolume.llm import jaccard

    monkeypatch.setattr(jaccard, "SHARE", 5)
    rows = []
    for group in range(3):
        base = words(60, 50 + group, 3)
        for k in range(25):
            near, r = list(base), random.Random(group * 100 + k)
            for _ in range(r.randrange(6)):
                near[r.randrange(60)] = f"n{r.randrange(40)}"
            rows.append((group * 100 + k, " ".join(near)))
    out = jaccard_components(table(spark, rows), 2, 80)
    assert Counter(tuple(r) for r in out.collect()) == components_by_hand(rows, 2, 80)


def test_packing(spark):
    rows = awkward()
    lengths = token_lengths(table(spark, rows))
    n = Counter((r.id, r.n_tokens) for r in lengths.collect())
    assert n == Counter((i, len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) + 1) for i, t in rows)
    out = pack_documents(lengths, capacities=(64, 128, 1024), bucket_rows=20).collect()
    assert sum(r.n_tokens for r in out) == sum(k * c for (_, k), c in n.items())
    bins = defaultdict(list)
    for r in out:
        bins[r.bucket, r.bin].append(r)
    for rows_of in bins.values():
        rows_of.sort(key=lambda r: r.start)
        ends = np.cumsum([r.n_tokens for r in rows_of])
        assert [r.start for r in rows_of] == [0, *ends[:-1]]
        assert {r.capacity for r in rows_of} == {min(c for c in (64, 128, 1024) if c >= ends[-1])}
    pieces = defaultdict(Counter)
    for r in out:
        pieces[r.id][r.piece] += 1
    assert set(pieces[80]) == set(range(6)) and pieces[9][0] == 2
    assert pack_documents(token_lengths(table(spark, []))).count() == 0


def pack_by_hand(lengths, costs):
    """Best fit that looks at every open bin."""
    bins, left, out = [], sum(lengths), []
    for n in lengths:
        fits = [(cap - used, k) for k, (used, cap) in enumerate(bins) if cap - used >= n]
        if fits:
            room = min(r for r, _ in fits)
        else:
            bins.append([0, cheapest(costs, n, left)])
            fits, room = [(bins[-1][1], len(bins) - 1)], bins[-1][1]
        out.append(room - n)
        k = [k for r, k in fits if r == room][-1]
        bins[k][0] += n
        left -= n
    return out, sorted(min(c for c in costs if c >= used) for used, _ in bins)


def test_pack_is_best_fit():
    r = random.Random(5)
    costs = {16: 20.0, 32: 36.0, 64: 68.0}
    for _ in range(20):
        lengths = sorted((r.randrange(1, 65) for _ in range(60)), reverse=True)
        placed = pack(lengths, costs)
        used, final = Counter(), {}
        for (b, start, cap), n in zip(placed, lengths, strict=True):
            assert start == used[b]
            used[b] += n
            final[b] = cap
        assert sum(final.values()) == sum(pack_by_hand(lengths, costs)[1])


def test_hash_of_kept_text(spark):
    """The digest of the contract is that of the kept bytes."""
    rows = [(1, "é" * 60), (2, "é" * 60 + "z")]
    out = {r.id: bytes(r.kept) for r in remove_repeats(table(spark, rows)).collect()}
    assert hashlib.sha256(out[2]).hexdigest() == hashlib.sha256(b"z").hexdigest()


def hot_rows():
    """A phrase and a passage with other neighbours in every document, some of them alike."""
    r = random.Random(8)
    noise = lambda n: "".join(r.choice("abcdefghij ") for _ in range(n))
    rows = [(k, noise(r.randrange(20, 60)) + " all rights reserved by us " + noise(40)) for k in range(300)]
    rows += [(300 + k, noise(30) + "x" * k + " no warranty of any kind is given with this software, use it as it is" + noise(30)) for k in range(60)]
    return rows + [(400 + k, "z" * k + rows[k * 5][1][10:] + noise(9)) for k in range(40)] + [(None, rows[7][1]), rows[3], (3, noise(70))]


@pytest.mark.parametrize("hot", [1, 20, 1 << 15])
def test_hot_repeats(spark, hot):
    rows = hot_rows()
    out = remove_repeats(table(spark, rows), chunk_bytes=2000, hot=hot).collect()
    got = Counter((r.id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in out)
    assert got == repeats_by_hand(rows)


def test_hot_contexts_are_spread():
    """However many neighbours a phrase has, no bucket gets more than a share of its contexts."""
    import pyarrow as pa

    from regiolume.llm import repeats

    texts, bits, every = [t.encode() for _, t in hot_rows()[:300]], 6, []
    for c in range(0, 300, 10):
        part = texts[c : c + 10]
        every.append({"chunk": c, "ids": list(range(c, c + 10)), "marks": [0] * 10, "sizes": [len(t) for t in part], "data": b"".join(part), "copies": None})
    by_bucket = lambda out: {b: [r for r in out if r["bucket"] == b] for b in {r["bucket"] for r in out}}
    run = lambda f, rows: [r for batch in f(iter([pa.RecordBatch.from_pylist(rows)])) for r in batch.to_pylist()]
    found = [r for group in by_bucket(run(repeats._anchors(50, bits), every)).values() for r in run(repeats._shared(20), group)]
    for row in every:
        row["found"] = [{k: f[k] for k in ("bucket", "found", "hot")} for f in found if f["chunk"] == row["chunk"]]
    groups = by_bucket(run(repeats._contexts(50, bits), every))
    sizes = {b: sum(len(r["doc"]) for r in group) for b, group in groups.items()}
    assert max(n for b, n in sizes.items() if b < 1 << bits) <= 60
    strings = [n for b, n in sizes.items() if b >= 1 << bits]
    assert len(strings) == 1 << bits and max(strings) < 0.05 * sum(strings)
