"""Top-k search, sharding, token output, chat, language and the pipeline on awkward rows."""

import hashlib
import pathlib
import random
import re
import subprocess
import sys
import tracemalloc
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from regiolume.llm import chat, id_coder, language, pieces
from regiolume.llm.common import may_be_in
from regiolume.llm.packing import BATCH_ROWS, pack_documents
from regiolume.llm.sharding import shuffle_into_shards
from regiolume.llm.pieces import PieceCoder
from regiolume.llm.token_output import read_token_ids, write_token_ids
from regiolume.llm.topk import exact_top_k

DOCS = "doc_id long, text string, lang string, source string, n_chars long, shard string, slot string, id string"
FOLDER = "/root/testdata/sf0.001"


def table(spark, rows):
    """Documents with columns whose names clash with those of results and of inner steps."""
    return spark.createDataFrame([(i, t, lang, s, None if t is None else len(t), "x", "y", "z") for i, t, lang, s in rows], DOCS)


def awkward():
    r = random.Random(3)
    text = lambda n: " ".join(r.choice(["the", "of", "Zürich", "naïve", "don't", "x2", "日本", "a,b;c", "…"]) for _ in range(n))
    rows = [(k, text(r.randrange(60)), "en", f"src{k % 3}") for k in range(40)]
    rows += [(50, None, None, None), (51, "", "xx", ""), (52, " \n ", "en", "a"), (53, text(9000), "en", "a"), (None, "who knows", "en", None)]
    return rows + [rows[3], rows[3], (None, "who knows", "en", None), (7, "another text of a known id", "en", "a")]


def test_top_k(spark):
    r = np.random.default_rng(4)
    rows = [(k, [float(x) for x in r.normal(size=20) * (0.1 + k % 3)]) for k in range(260)]
    rows += [(300, None), (301, [1.0, None] + [0.0] * 18), (302, [float("nan")] * 20), (303, [float("inf")] * 20), (None, [1.0] * 20)]
    rows += [(304, []), (350, [0.5] * 7), (351, [0.25] * 7), rows[5], rows[100], (5, [9.0] * 20), (0, [3.0] * 20)]
    rows += [(400 + k, rows[100][1]) for k in range(40)]  # ties
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, rank int, score int")
    from pyspark.sql import functions as F

    given = {(i, tuple(int(np.floor(256 * x)) for x in v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)}
    want = set()
    for q in {i for i, _ in given if i % 50 == 0}:
        best = {}
        for i, v in given:
            for j, w in given:
                if i == q and j != q and len(v) == len(w):
                    best[j] = max(best.get(j, -(10**18)), sum(a * b for a, b in zip(v, w, strict=True)))
        top = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:5]
        want |= {(q, k + 1, j, s) for k, (j, s) in enumerate(top)}
    for block_rows in (4096, 37):
        got = exact_top_k(df, F.col("id") % 50 == 0, block_rows=block_rows)
        assert {tuple(x) for x in got.collect()} == want
    assert exact_top_k(df.limit(0), F.col("id") % 50 == 0).count() == 0


@pytest.mark.parametrize("bucket_bytes", [1 << 20, 700])
def test_sharding(spark, bucket_bytes):
    rows = awkward()
    out = shuffle_into_shards(table(spark, rows), shards=7, bucket_bytes=bucket_bytes)
    assert out.columns == ["doc_id", "text", "slot", "shard"]
    got = out.collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter((i, t) for i, t, *_ in rows)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[k]) for k in range(7)]
    assert sum(sizes) == len(rows) and max(sizes) - min(sizes) <= 1
    order = [r.doc_id for r in sorted(got, key=lambda r: (r.shard, r.slot))]
    assert order != sorted(order, key=lambda x: (x is not None, x or 0))
    assert shuffle_into_shards(table(spark, []), shards=3).count() == 0


def test_offsets(spark, monkeypatch):
    from regiolume.llm import sharding

    monkeypatch.setattr(sharding, "OFFSETS_AT_ONCE", 4)
    counts = spark.createDataFrame([(b, b % 5 + 1) for b in range(0, 50, 3)], "bucket long, n long")
    want, at = {}, 0
    for b in range(0, 50, 3):
        want[b], at = at, at + b % 5 + 1
    assert {r.bucket: r.offset for r in sharding._offsets(counts).collect()} == want


@pytest.mark.parametrize("block", [64, 500])
def test_id_coder(block):
    r = np.random.default_rng(6)
    for n in (1, 2, 63, 64, 65, 1000, 1290):
        for bits in (1, 9, 16, 28):
            ids = r.integers(0, 1 << bits, n)
            ids[n // 2 :] = ids[: n - n // 2]  # something to predict
            payload, lengths, checks = id_coder.encode(ids, bits, block)
            assert (id_coder.decode(payload, lengths, checks, n, bits, block) == ids).all()
    same = id_coder.encode(np.full(4096, 7), 16, 4096)[0]
    assert len(same) < 200  # predicted ids cost next to nothing
    damaged = bytes([payload[0] ^ 1]) + payload[1:]
    with pytest.raises(ValueError, match="damaged"):
        id_coder.decode(damaged, lengths, checks, n, bits, block)
    assert id_coder.encode(np.empty(0, np.int64), 4) == (b"", [], [])


def test_piece_coder_forgets(monkeypatch):
    import pyarrow as pa

    from regiolume.llm import pieces as module

    path = public_tokenizers.path("word_bpe_49k.json")
    plain, pieces = Tokenizer.from_file(path), PieceCoder(path)
    texts = [t or "" for _, t, *_ in awkward()] + ["<|endoftext|> a\tb\r\n  c\xa0d é", "\n", " x "]
    for most in (10**6, 40):  # the second forgets all the time
        monkeypatch.setattr(module, "KNOWN_PIECES", most)
        ((_, ids, n),) = pieces.encode(pa.array(texts))
        ends = np.cumsum(n)
        for t, a, b in zip(texts, ends - n, ends, strict=True):
            assert ids[a:b].tolist() == plain.encode(t, add_special_tokens=False).ids


def test_token_output(spark, monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    rows = awkward()
    got = sorted(read_token_ids(write_token_ids(table(spark, rows), path)).collect(), key=lambda r: r.start)
    assert [r.doc_id is not None and r.doc_id for r in got] == sorted((i is not None and i for i, *_ in rows), key=lambda x: -1 if x is False else x)
    at, want = 0, Counter()
    for i, t, *_ in rows:
        ids = [*plain.encode(t or "", add_special_tokens=False).ids, 1]
        want[i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    for r in got:
        assert r.start == at
        at += r.n_tokens
    assert read_token_ids(write_token_ids(table(spark, []), path)).count() == 0


def folded(events):
    """Event logs folded one after another."""
    convs = defaultdict(dict)
    for conv, seq, message, kind, role, text in sorted(set(events), key=lambda e: (e[1], e[3], e[5] or "")):
        m = convs[conv].setdefault(message, {"opened": None, "first": seq, "role": "", "text": ""})
        if kind == "open":
            m["opened"], m["role"] = seq, role or ""
        elif kind == "delta":
            m["text"] += text or ""
        elif kind == "edit":
            m["text"] = text or ""
        else:
            m["text"] = ""
            at = lambda x: (x["opened"] if x["opened"] is not None else x["first"])
            for k, other in convs[conv].items():
                if k != message and (at(other), k) > (at(m), message):
                    other["gone"] = True
    out = set()
    for conv, messages in convs.items():
        for k, m in messages.items():
            if not m.get("gone"):
                out.add((conv, k, m["opened"] if m["opened"] is not None else m["first"], m["role"], m["text"]))
    return out


def test_fold_messages(spark):
    events = [
        (1, 0, "u", "open", "user", None), (1, 1, "u", "delta", None, "Hel"), (1, 2, "u", "delta", None, "lo"), (1, 2, "u", "delta", None, "lo"),
        (1, 3, "a", "open", "assistant", None), (1, 4, "a", "delta", None, "bad"), (1, 5, "v", "open", "user", None),
        (1, 6, "v", "delta", None, "no"), (1, 7, "a", "regenerate", None, None), (1, 8, "a", "delta", None, "good "),
        (1, 9, "a", "delta", None, None), (1, 10, "u", "edit", None, "Hi"), (1, 11, "w", "open", "user", None), (1, 12, "w", "delta", None, "x#<\\"),
        (2, 1, "a", "delta", None, "no open"), (None, 1, "a", "open", "system", None), (None, 2, "a", "delta", None, "s"), (3, 4, "e", "open", None, None),
    ]
    df = spark.createDataFrame(events, "conv_id long, seq long, message string, kind string, role string, text string")
    got = {(r.conv_id, r.message, r.opened, r.role, r.text) for r in chat.fold_messages(df).collect()}
    assert got == folded(events)
    assert chat.digests(chat.format_conversations(df.limit(0))).count() == 0


def test_chat_round_trip(spark):
    nasty = ["", "\\### Assistant: </turn> ok", "a\\", "</turn>\n### user: x", "#<\\#", "é日本\n\n", ": "]
    turns = [(c, t, role, nasty[(c + t) % len(nasty)]) for c in range(8) for t, role in enumerate(["user", "assistant", "a: b\\", "assistant"])]
    turns += [(20, 0, None, None), (None, 0, "assistant", "x"), (None, None, "user", "y"), turns[0]]
    df = spark.createDataFrame([(*x, "c") for x in turns], "conv_id long, turn long, role string, text string, opened string")
    got = {r.conv_id: r for r in chat.digests(chat.format_conversations(chat.events_of(df))).collect()}
    convs = defaultdict(set)
    for c, t, role, text in turns:
        convs[c].add((-1 if t is None else t, role or "", text or ""))
    assert set(got) == set(convs)
    for c, rows in convs.items():
        rows = sorted(rows)
        loss = "".join(text for _, role, text in rows if role == "assistant")
        whole = "".join(f"{role}\n{text}\n" for _, role, text in rows)
        assert (got[c].n_turns, got[c].turns_sha256) == (len(rows), hashlib.sha256(whole.encode()).hexdigest())
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_chat_counts_every_row(spark, tmp_path):
    """Texts of NULL turns stay whole, and repeated rows each count, as in the SQL of the query."""
    import duckdb

    from regiolume.llm.oracles import CHAT
    from regiolume.llm.queries import op10_chat_formatting

    turns = [(1, 0, "user", "world hello"), (1, 1, "assistant", "abab"), (1, 1, "assistant", "abab"), (2, 3, "assistant", "x")] + [(2, 3, "assistant", "x")] * 4
    turns += [(3, None, "assistant", "world hello"), (4, None, "assistant", "abab"), (5, None, "user", "xyxy"), (5, None, "user", "xyxy")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    got = sorted(tuple(r) for r in op10_chat_formatting(spark, str(tmp_path)).collect())
    with duckdb.connect() as db:
        db.execute(f"create view conversations as from read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
        assert got == sorted(db.execute(CHAT).fetchall())
    assert [r[1] for r in got if r[0] > 0] == [3, 5, 1, 1, 2]
    # A NULL turn is before, and apart from, every turn that a table can hold.
    odd = spark.createDataFrame([(1, -1, "user", "zxzx"), (1, None, "user", "zxzx"), (1, None, "user", "b long a")], df.schema)
    pieces = chat.render(chat.fold_messages(chat.events_of(chat.number_copies(odd)))).orderBy("opened", "message").collect()
    assert sorted(r.piece for r in pieces[:2]) == ["### user: b long a</turn>\n", "### user: zxzx</turn>\n"]
    assert [r.piece for r in pieces[2:]] == ["### user: zxzx</turn>\n"]


def test_packing_bounds_batches(spark):
    """Texts on their way to the encoder are many megabytes, so few rows go at once; the session's setting stays."""

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("id"), pa.array([batch.num_rows] * batch.num_rows)], ["id", "mark", "n_tokens"])

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    rows = spark.range(5000, numPartitions=1).mapInArrow(sizes, "id long, mark long, n_tokens long")
    got = pack_documents(rows, capacities=(8192,)).collect()
    assert len(got) == 5000 and max(r.n_tokens for r in got) <= BATCH_ROWS
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_pieces_forget_before_a_million(monkeypatch):
    """A worker holds at most 800,000 pieces, and ids do not change where they are forgotten."""
    assert pieces.KNOWN_PIECES <= 800_000
    texts = pa.array([f"{i} word{i}, {i % 7} end" for i in range(900)])
    want = PieceCoder(public_tokenizers.path("word_bpe_49k.json")).lengths(texts).tolist()
    monkeypatch.setattr(pieces, "KNOWN_PIECES", 50)
    monkeypatch.setattr(pieces, "SLICE_BYTES", 256)
    assert PieceCoder(public_tokenizers.path("word_bpe_49k.json")).lengths(texts).tolist() == want


def test_pieces_keep_what_comes_again(monkeypatch):
    """Pieces that every text has are encoded once, however many rare ones make the worker forget."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = pa.array([f"usual words here | in every text rare{i} seldom{i}" for i in range(400)])
    seen, encoded = Counter(), PieceCoder._encoded
    monkeypatch.setattr(pieces, "KNOWN_PIECES", 100)
    monkeypatch.setattr(pieces, "SLICE_BYTES", 1024)
    monkeypatch.setattr(PieceCoder, "_encoded", lambda self, new: seen.update(new.to_pylist()) or encoded(self, new))
    plain, at = Tokenizer.from_file(path), 0
    for first, ids, n in PieceCoder(path).encode(texts):
        for t, a, b in zip(texts.slice(first, len(n)).to_pylist(), np.cumsum(n) - n, np.cumsum(n), strict=True):
            assert ids[a:b].tolist() == plain.encode(t, add_special_tokens=False).ids
        at += len(n)
    assert at == 400
    assert seen[" words"] == seen[" every"] == seen[" in"] == 1 and seen[" rare7"] == 1


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_are_encoded_together(name, monkeypatch):
    """One call of the tokenizer gives the ids of many pieces; a text that holds the special token itself is no exception."""
    path = public_tokenizers.path(name)
    coder, plain = PieceCoder(path), Tokenizer.from_file(path)
    some = ["a", " b", "  ", "\n", "é", "'s", " <|endoftext", "|>", "<|", "日本", "Á", "x" * 500, " | y", "\x00"] * 40
    for texts in (some, [*some, "a <|endoftext|> b"]):
        sizes, ids = coder._encoded(pa.array(texts))
        want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
        assert sizes.tolist() == [*map(len, want)] and ids.tolist() == [i for w in want for i in w]
    monkeypatch.setattr(PieceCoder, "_apart", lambda self, new: pytest.fail("one by one"))
    coder._encoded(pa.array(some))


def test_language_bounds_batches(spark, monkeypatch):
    """Texts on their way to the scores are many megabytes, so few rows go at once; the session's setting stays."""
    def scorer(names, model):
        def run(batches):
            for batch in batches:
                n = batch.num_rows
                extra = [pa.array([n] * n, pa.int64())] + [pa.array([1.0] * n)] * 4
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], *extra], [*names, "__n", "__l0", "__l1", "__p0", "__p1"])

        return run

    staged, before = [], spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    stage = language.stage
    monkeypatch.setattr(language, "_scorer", scorer)
    monkeypatch.setattr(language, "stage", lambda df, name: staged.append(stage(df, name)) or staged[-1])
    rows = spark.range(5000, numPartitions=1).withColumn("text", F.lit("some text"))
    none = F.lit(None).cast("string")
    language.identify(rows, language.Model(("en",), np.zeros((language.FEATURES + 1, 3), np.float32)), F.col("text"), none, none, none, ["id"])
    assert staged[0].agg(F.max("__n")).first()[0] <= 2048
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_top_k_scores_many_pairs_at_once(monkeypatch):
    """Pairs that the bounds leave in great number are one product of matrices, and only what reaches the threshold is ranked."""
    from regiolume.llm import topk

    r = np.random.default_rng(8)
    q, v = r.integers(-300, 300, (30, 64)), r.integers(-300, 300, (500, 64))
    ids, all_scores = np.arange(1000, 1500), q @ v.T
    least = np.sort(all_scores, axis=1)[:, -3].astype(np.float64)
    ranked, best = [], topk._best
    monkeypatch.setattr(topk, "exact_scores", lambda a, b: pytest.fail("pair by pair") if len(a) else np.empty(0, np.int64))
    monkeypatch.setattr(topk, "_best", lambda qi, *rest: ranked.append(len(qi)) or best(qi, *rest))
    qi, found, scores = topk.search_block(np.arange(30), q, least, ids, v, 3, (32,))
    assert sum(ranked) < 30 * 8
    for i in range(30):
        order = np.lexsort((ids, -all_scores[i]))[:3]
        assert found[qi == i].tolist() == ids[order].tolist() and scores[qi == i].tolist() == all_scores[i][order].tolist()


def test_packing_counts_ids(spark, tmp_path):
    """Sequences are packed by the ids of the vocabulary; a text without blanks is cut like any other."""
    from regiolume.llm.queries import op7_packing

    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = awkward() + [(300, "日本語の文章" * 3000, "ja", "a"), (301, "x9" * 9000, None, None), (302, "don't; can't!" * 40, "en", "a")]
    docs = table(spark, rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    size = lambda t: len(plain.encode(t or "", add_special_tokens=False).ids) + 1
    want = Counter()
    for i, t, *_ in rows:
        want[i] += size(t)
    for out in (op7_packing(spark, str(tmp_path)), corpus_pipeline.packing(spark, docs, str(tmp_path))):
        got, used = Counter(), Counter()
        for r in out.collect():
            got[r.doc_id] += r.n_tokens
            used[r.bucket, r.bin, r.capacity] += r.n_tokens
        assert got == want and want[300] > 4096 and want[301] > 4096
        assert all(n <= capacity for (_, _, capacity), n in used.items())


def test_language_held_out(spark):
    """Labels of rows that were not learned from, on text alone; then the weight of the other evidence."""
    from pyspark.sql import functions as F

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    learned = F.col("doc_id") % 2 == 0
    model = language.train(docs.where(learned).select(F.col("doc_id").alias("key"), "text", "lang"))
    held = docs.where(~learned)
    none = F.lit(None).cast("string")
    out = language.identify(held, model, F.col("text"), none, none, none, keep=["doc_id", "lang"]).collect()
    right = sum(r.lang == r.language for r in out)
    assert len(out) == held.count() and right >= 0.99 * len(out) and all(r.accepted for r in out)
    rows = [(k, "the and of that is " * 5, "en", None, "a.example.com") for k in range(30)]
    rows += [(100, None, "en", None, None), (101, "", "fr", "fr", "b.example.com"), (102, "12 34 !!", "en", "en", "a.example.com"), (103, "中文字符测试文本" * 9, None, None, "x"), (104, "the", "en", "en", "a.example.com")]
    df = spark.createDataFrame([(*r, "c") for r in rows], "k long, text string, d string, s string, h string, language string")
    got = {r.k: r for r in language.identify(df, model, F.col("text"), F.col("d"), F.col("s"), F.col("h"), keep=["k"]).collect()}
    assert len(got) == len(rows)
    assert all(got[k].accepted and got[k].language == "en" for k in [*range(30), 104])
    assert not any(got[k].accepted for k in (100, 101, 102, 103))
    assert language.identify(df.limit(0), model, F.col("text"), none, none, none, keep=["k"]).count() == 0


def test_language_few_labels(spark):
    """Rows without a label take nothing from the sample, every labelled language is learned, and without labels all stay."""
    from pyspark.sql import functions as F

    assert language.quotas({"a": 3, "b": 1000, "c": 90}, 200) == {"a": 3, "c": 90, "b": 107}
    words = {"en": "the house and the garden of that man", "de": "das Haus und der Garten von dem Mann", "it": "la casa e il giardino di questo uomo che parla"}
    texts = [(k, lang, " ".join(random.Random(k).choices(words[lang].split(), k=30))) for k, lang in enumerate(["en", "de", "it"] * 400)]
    rows = [(k, text, lang if k < 60 else None, None) for k, lang, text in texts]
    docs = table(spark, rows)
    model = language.train(docs.select(F.col("doc_id").alias("key"), "text", "lang"), rows=30)
    assert model.languages == ("de", "en", "it")
    none = F.lit(None).cast("string")
    out = {r.doc_id: r for r in language.identify(docs, model, F.col("text"), none, none, none, keep=["doc_id"]).collect()}
    assert all(out[k].accepted and out[k].language == lang for k, lang, _ in texts)
    upper = language.train(docs.select(F.col("doc_id").alias("key"), "text", F.upper("lang").alias("lang")))
    assert upper.languages == model.languages
    assert corpus_pipeline.language_id(spark, docs, FOLDER).count() == len(rows)
    assert corpus_pipeline.language_id(spark, docs.withColumn("lang", none), FOLDER).count() == len(rows)


def test_page_evidence(spark):
    from pyspark.sql import functions as F

    url = ["https://u:p@www.example.de:80/x", "http://example.com/fr/825?a=b", "http://example.com/fresh", "junk", None, "https://example.mx"]
    df = spark.createDataFrame([(u,) for u in url], "u string")
    got = [tuple(r) for r in df.select(language.url_host(F.col("u")), language.url_language(F.col("u"))).collect()]
    assert got == [("www.example.de", "de"), ("example.com", "fr"), ("example.com", ""), ("", ""), (None, None), ("example.mx", "es")]
    html = "<HTML class='a' lang='FR-ca'><style>p{}</style><script>var t='</p>';</script><!-- <p> --><p>Un&nbsp;deux</p>"
    page = spark.createDataFrame([(html,)], "h string")
    assert page.select(language.markup_language(F.col("h"))).first()[0] == "FR"
    assert page.select(language.markup_text(F.col("h"))).first()[0].split() == ["Un", "deux"]


def test_pipeline_stages(spark):
    """Columns, and what each stage keeps of its own input."""
    rows = awkward() + [(200 + k, f"Ein sehr langer deutscher Satz über das Leben, der niemals endet {k}\nshared line of all of these", "de", "a") for k in range(4)]
    docs = table(spark, rows)
    for name, function in corpus_pipeline.STAGES[:-1]:
        out = function(spark, docs, FOLDER)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        assert function(spark, docs.limit(0), FOLDER).count() == 0
    kept = corpus_pipeline.near_duplicates(spark, docs, FOLDER)
    from test_llm_text_operators import components_by_hand

    first = {i for i, _, c in components_by_hand([(i, t) for i, t, *_ in rows if i != 7], 5, 80) if i == c}
    assert {r.doc_id for r in kept.collect() if r.doc_id != 7} == first - {7}
    packed = corpus_pipeline.packing(spark, docs, FOLDER)
    assert packed.where("piece = 0").count() == len(rows)


def test_pipeline_decides_by_row(spark):
    """One row of each group stays, whatever ids the rows share; what line_dedup empties goes."""
    text = lambda k: " ".join(f"w{k}x{j}" for j in range(40))
    rows = [(1, text(1)), (1, text(1)), (1, text(2)), (2, text(2) + " more"), (3, text(3)), (3, text(4)), (4, text(3)), (None, text(5)), (None, text(5)), (None, text(6)), (9, text(5))]
    docs = table(spark, [(i, t, "en", "a") for i, t in rows])
    kept = corpus_pipeline.near_duplicates(spark, docs, FOLDER)
    assert kept.columns == docs.columns
    want = [(1, text(1)), (1, text(2)), (3, text(3)), (3, text(4)), (None, text(5)), (None, text(6))]
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(want)
    lines = [(1, text(1) + "\n\n" + text(2)), (2, text(2) + "\n \n" + text(1)), (3, text(3) + "\n" + text(1)), (4, ""), (5, None)]
    left = corpus_pipeline.line_dedup(spark, table(spark, [(i, t, "en", "a") for i, t in lines]), FOLDER)
    assert sorted(r.doc_id for r in left.collect()) == [1, 3, 4, 5]


def test_pipeline_keeps_inner_names(spark):
    text = lambda k: " ".join(f"w{k}x{j}" for j in range(40))
    names = ["__id", "__mark", "__key", "__runs", "__gone"]
    docs = table(spark, [(k or None, text(k % 3), "en", "a") for k in range(6)])
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, FOLDER).collect()} == {None, 1, 2}
    docs = docs.withColumns({n: F.lit(n) for n in names})
    for name, function in corpus_pipeline.STAGES[:-1]:
        out = function(spark, docs, FOLDER)
        assert out.columns == docs.columns, name
        assert out.count() and all(r[n] == n for r in out.collect() for n in names), name


def test_pipeline_moves_few_texts(spark):
    """Copies go without a shuffle of the other texts, also where Spark may broadcast nothing by itself."""
    text = lambda k: " ".join(f"w{k}x{j}" for j in range(40))
    docs = table(spark, [(None if k == 0 else k, text(k % 300), "en", "a") for k in range(310)])
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, -1)
    try:
        out = corpus_pipeline.near_duplicates(spark, docs, FOLDER)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"Exchange hashpartitioning\([^)]*key", plan)) == 2 and plan.count("bit_get") >= 2
        assert sorted(r.doc_id or 0 for r in out.collect()) == list(range(300))
    finally:
        spark.conf.set(name, before)


def test_may_be_in(spark):
    """All keys that the other table has are marked, few others, NULL and repeated ones among them."""
    keys = [*range(0, 5000, 50), -(2**63), 2**63 - 1, None]
    df = spark.createDataFrame([(k,) for k in [*range(5000), *keys]], "key long").withColumn("__bit", F.lit("x"))
    other = spark.createDataFrame([(k,) for k in [*keys, *keys]], "key long")
    out = may_be_in(df, other, "key", "here")
    assert out.columns == ["key", "__bit", "here"] and out.count() == df.count()
    marked = Counter(r.key for r in out.where("here").collect())
    assert all(marked[k] == 1 + (k is not None and 0 <= k < 5000) for k in keys)
    assert len(marked) < 2 * len(keys)
    assert may_be_in(df, other.limit(0), "key", "here").where("here").count() == 0


def test_registered(spark):
    names = list(entry.queries())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10 and "pipeline" in names


def test_id_coder_at_its_edges():
    """Least and greatest ids, the end of a frame that fills no block, and thousands of blocks at once."""
    r = np.random.default_rng(9)
    some = [np.zeros(3000, int), np.full(3000, (1 << 28) - 1), r.integers(0, 2, 3000) * ((1 << 28) - 1)]
    some += [np.repeat(r.integers(0, 1 << 28, 100), 30), r.permutation(3000), r.zipf(1.3, 3000) % (1 << 16)]
    for ids, bits, block in ((x, max(1, int(x.max()).bit_length()), b) for x in some for b in (512, 1024)):
        payload, lengths, checks = id_coder.encode(ids, bits, block)
        assert len(lengths) == -(-len(ids) // block)
        assert (id_coder.decode(payload, lengths, checks, len(ids), bits, block) == ids).all()
    ids = r.integers(0, 49_408, 8 * 5000 - 3)
    assert (id_coder.decode(*id_coder.encode(ids, 16, 8), len(ids), 16, 8) == ids).all()


def test_few_large_frames(spark, monkeypatch):
    """Some million ids of a task are one frame: each step of the coder costs about the same for few blocks as for many."""
    from regiolume.llm import token_output

    seen = []
    monkeypatch.setattr(token_output, "piece_coder", lambda path: Fixed())
    monkeypatch.setattr(token_output, "encode", lambda ids, *_: seen.append(len(ids)) or (b"", [], []))
    monkeypatch.setattr(token_output.TaskContext, "get", lambda: SimpleNamespace(partitionId=lambda: 0))
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array(["a", "b", "c"])], ["id", "text"])
    assert sum(f.num_rows for f in token_output._frames("", 1)(iter([batch] * 3))) == 1
    assert seen == [9 * 700_001]


class Fixed:
    """A tokenizer of long texts."""

    def encode(self, column):
        for i in range(len(column)):
            yield i, np.full(700_000, 5, np.int32), np.array([700_000])


def test_plain_pieces_skip_the_normalizer():
    """ASCII without capitals is encoded without the steps that change nothing in it, with the ids of the whole tokenizer."""
    path = public_tokenizers.path("word_bpe_49k.json")
    coder, plain, seen = PieceCoder(path), Tokenizer.from_file(path), []
    parts = coder._in_parts
    coder._in_parts = lambda new: seen.append((new.to_pylist(), coder.tokenizer.normalizer)) or parts(new)
    texts = [" of", " Of", "\nof", " é", " É", "é", " a\t b", "don't", "<|endoftext|>", "x", " İ", "ΣΑΣ", "  x"]
    sizes, ids = coder._encoded(pa.array(texts))
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert (sizes.tolist(), ids.tolist()) == ([*map(len, want)], [i for w in want for i in w])
    (other, whole), (short, less) = seen
    assert set(other) == {" Of", " é", " É", "é", " İ", "ΣΑΣ"} and set(short) == set(texts) - set(other)
    assert "Lowercase" in str(whole) and "Lowercase" not in str(less) and "Lowercase" in str(coder.tokenizer.normalizer)


def test_workers_give_memory_back():
    """What encoding took from Arrow's pool goes back: a worker lives through all stages, and its memory counts for each."""
    code = (
        "import sys, re, pathlib, pyarrow as pa, public_tokenizers; from regiolume.llm.pieces import PieceCoder\n"
        "mb = lambda: int(re.search(r'VmRSS:\\s+(\\d+)', pathlib.Path('/proc/self/status').read_text())[1]) / 1024\n"
        "texts = pa.array([' '.join(f'w{(i * 7 + k) % 5000}' for k in range(4000)) for i in range(300)])\n"
        "coder = PieceCoder(public_tokenizers.path('word_bpe_49k.json'))\n"
        "coder.lengths(texts); n = coder.lengths(texts); before = mb()\n"
        "pa.default_memory_pool().release_unused(); print(before - mb())\n"
    )
    top = pathlib.Path(id_coder.__file__).resolve().parents[2]
    out = subprocess.run([sys.executable, "-c", code], cwd=top, capture_output=True, text=True, check=True).stdout
    assert float(out) < 10


def test_scores_take_little_room():
    """Scores of a megabyte of text at once took some hundred bytes for each of its bytes."""
    column, model = pa.array(["abcdefgh" * 128] * 1024), np.zeros((language.FEATURES + 1, 8), np.float32)
    tracemalloc.start()
    language.text_scores(column, model)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 << 20
