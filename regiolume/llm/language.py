"""Language identification: text, declared language, address and host are fused by Bayes' rule."""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regiolume.llm.bytes_view import LOWERED, as_bytes, slices
from regiolume.llm.common import BATCH_ROWS
from regiolume.session import arrow_rows, stage

UNKNOWN = "und"
#: Labels that name no language: the class of unknown text, and the codes of ``identify`` for other and missing labels.
NO_LANGUAGE = (UNKNOWN, "other", "none", "")
#: Labels from which a model is made at most; its size grows with them.
MOST_LANGUAGES = 256
#: Country suffixes that speak for a language.
SUFFIXES = {"de": "de", "at": "de", "es": "es", "mx": "es", "fr": "fr", "uk": "en", "us": "en", "ie": "en"}
FEATURES = 1 << 16
#: Letters count as themselves (A-Z as a-z, every byte beyond ASCII too), all other bytes as one blank.
_CODES = np.array(
    [int(LOWERED[b]) if 97 <= LOWERED[b] <= 122 or b >= 128 else 0 for b in range(256)], np.uint16
)


def trigrams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For every byte the hashed number of the three bytes from there; ``FEATURES`` where the row ends before, or where
    all three are blank."""
    codes = _CODES[data]
    out = np.full(len(data), FEATURES, np.int64)
    if len(data) > 2:
        a, b, c = codes[:-2], codes[1:-1], codes[2:]
        found = (a * np.uint16(40_503) + b * np.uint16(10_007) + c * np.uint16(257)).astype(np.int64)
        out[:-2] = np.where((a | b | c) == 0, FEATURES, found)
        for back in (1, 2):
            at = offsets[1:] - back
            out[at[at >= 0]] = FEATURES
    return out


class Model(NamedTuple):
    """The languages, and log-probabilities of trigrams: a row for each feature and columns for the languages, for text of
    no known language (all features alike), and 1."""

    languages: tuple[str, ...]
    table: np.ndarray


def quotas(counts: dict[str, int], rows: int) -> dict[str, int]:
    """How many rows each language gives to a sample of ``rows``: an equal part each, and what rare ones lack goes to the others."""
    out, left = {}, rows
    for done, name in enumerate(sorted(counts, key=lambda x: (counts[x], x))):
        out[name] = min(counts[name], math.ceil(left / (len(counts) - done)))
        left -= out[name]
    return out


def train(labelled: DataFrame, languages: tuple[str, ...] | None = None, rows: int = 20_000) -> Model:
    """The model of the languages that the labels name, from about ``rows`` labelled rows (``key, text, lang``).

    Rows count that have a label, in any case of letters, and a text. Of each language those are learned from whose hashed
    key falls below its share, so the sample is spread over the table and its size does not grow; a language of few rows is
    learned from all of them. ``languages`` restricts the labels. Without any labelled row the model has no language; more
    than ``MOST_LANGUAGES`` labels are an error.
    """
    label = F.lower(F.btrim("lang"))
    given = labelled.select("key", "text", label.alias("lang")).where("text <> ''")
    given = given.where(~F.col("lang").isin(*NO_LANGUAGE) if languages is None else F.col("lang").isin(*languages))
    found = given.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MOST_LANGUAGES + 1).collect()
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} different labels: name the languages to learn")
    counts = {r["lang"]: r["n"] for r in found}
    languages = tuple(sorted(counts))
    wanted, place, share = quotas(counts, rows), F.pmod(F.xxhash64(F.lit("sample"), "key"), F.lit(1 << 40)), F.lit(0)
    for name in languages:
        share = F.when(F.col("lang") == name, F.lit((wanted[name] << 40) // counts[name])).otherwise(share)
    sample = given.where(place < share)
    counted = sample.select("text", "lang").mapInArrow(_counter(languages), "lang int, part int, counts binary")
    summed = counted.groupBy("lang", "part").applyInArrow(_adder, "lang int, part int, counts binary")
    counts = np.full((FEATURES, len(languages)), 0.5)
    with arrow_rows(labelled.sparkSession, BATCH_ROWS):
        for r in summed.toLocalIterator():
            part = np.frombuffer(r["counts"], np.int64)
            counts[r["part"] * len(part) : (r["part"] + 1) * len(part), r["lang"]] += part
    model = np.zeros((FEATURES + 1, len(languages) + 2), np.float32)  # the last row is text without letters
    model[:-1, : len(languages)] = np.log(counts / counts.sum(axis=0))
    model[:-1, -2] = -math.log(FEATURES)
    model[:-1, -1] = 1
    return Model(languages, model)


def _counter(languages: tuple[str, ...], parts: int = 16):
    place = {name: i for i, name in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(languages), FEATURES + 1), np.int64)
        for batch in batches:
            labels = np.array([place[x] for x in batch.column("lang").to_pylist()], np.int64)
            for first, data, offsets in slices(*as_bytes(batch.column("text"))):
                row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
                found = labels[first + row] * (FEATURES + 1) + trigrams(data, offsets)
                counts += np.bincount(found, minlength=counts.size).reshape(counts.shape)
        pieces = [
            (lang, part, piece.tobytes())
            for lang in range(len(languages)) if counts[lang, :-1].any()
            for part, piece in enumerate(np.split(counts[lang, :-1], parts))
        ]
        if pieces:
            columns = [pa.array(c, t) for c, t in zip(zip(*pieces, strict=True), (pa.int32(), pa.int32(), pa.binary()), strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "part", "counts"])

    return run


def _adder(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, head = None, None
    for batch in batches:
        for counts in batch.column("counts").to_pylist():
            new = np.frombuffer(counts, np.int64)
            total = new.copy() if total is None else total + new
        if batch.num_rows:
            head = batch.slice(0, 1)
    if head is not None:
        yield pa.RecordBatch.from_arrays(
            [head.column("lang"), head.column("part"), pa.array([total.tobytes()], pa.binary())], ["lang", "part", "counts"]
        )


def text_scores(column: pa.Array, model: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean log-probability by language, and the number of trigrams, of each text."""
    total = np.zeros((len(column), model.shape[1]))
    for first, data, offsets in slices(*as_bytes(column)):
        found = trigrams(data, offsets)
        filled = np.flatnonzero(np.diff(offsets))
        if len(filled):
            total[first + filled] += np.add.reduceat(model[found], offsets[:-1][filled], axis=0, dtype=np.float64)
    n = total[:, -1]
    return total[:, :-1] / np.maximum(n, 1)[:, None], n.astype(np.int64)


def _softmax(scores: np.ndarray) -> np.ndarray:
    odds = np.exp(scores - scores.max(axis=1, keepdims=True))
    return odds / odds.sum(axis=1, keepdims=True)


def _scorer(names: list[str], model):
    """Scores of the text and the probabilities they give on their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mean, n = text_scores(batch.column("__text"), model.value)
            scores = mean * (3 * np.sqrt(n))[:, None]  # trigrams overlap and repeat: evidence grows with the root
            both = np.concatenate([scores, _softmax(scores) if len(scores) else scores], axis=1)
            added = [pa.array(n), *(pa.array(np.ascontiguousarray(c)) for c in both.T)]
            kinds = [f"__{kind}{i}" for kind in "lp" for i in range(scores.shape[1])]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], *added], [*names, "__n", *kinds]
            )

    return run


def _fuser(names: list[str], known: tuple[str, ...], share: np.ndarray, smooth: float, least: float, by_label, by_suffix):
    """Scores of the text, host priors without the row itself, and the evidence of label and suffix, added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            column = lambda name: batch.column(name).to_numpy(zero_copy_only=False)
            many = lambda kind: np.stack([column(f"__{kind}{i}") for i in range(len(known))], axis=1)
            text, own, n = many("l"), many("p"), column("__n")
            prior = share[None, :]
            for kind in "dh":  # the domain is smoothed towards all rows, the host towards its domain
                others = np.maximum(many(kind) - own, 0) + smooth * prior
                prior = others / others.sum(axis=1, keepdims=True)
            label = np.stack([by_label[x] for x in batch.column("__declared").to_pylist()])
            suffix = np.stack([by_suffix[x] for x in batch.column("__suffix").to_pylist()])
            found = _softmax(text + np.log(prior) + label + suffix)
            best = found.argmax(axis=1)
            top = found[np.arange(len(best)), best]
            good = (best < len(known) - 1) & (top >= least) & (n > 0)
            results = [pa.array([known[i] for i in best]), pa.array(top), pa.array(good)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], *results], [*names, "language", "probability", "accepted"]
            )

    return run


def _evidence(ev: DataFrame, column: str, n: int, smooth: float = 1.0) -> dict[str, np.ndarray]:
    """Log P(value of the column | language) for its few values, from counts over all rows."""
    rows = ev.groupBy(column).agg(*[F.sum(f"__p{i}").alias(f"s{i}") for i in range(n)]).collect()
    counts = np.array([[r[f"s{i}"] for i in range(n)] for r in rows]).reshape(-1, n) + smooth
    logs = np.log(counts / counts.sum(axis=0))
    return {r[column]: logs[i] for i, r in enumerate(rows)}


def identify(
    rows: DataFrame,
    model: Model,
    text: Column,
    declared: Column,
    suffix: Column,
    host: Column,
    keep: list[str],
    smooth: float = 20.0,
    least: float = 0.5,
) -> DataFrame:
    """The most probable language of each row, of those of the model, from four kinds of evidence.

    * text: hashed byte trigrams against ``model`` (see ``train``), with a class ``und`` for text that none explains;
    * declared: the language the row itself names; how far to trust it is counted over all rows, against
      what the text alone says, so a label that is often wrong weighs little;
    * suffix: what the address says, weighed the same way;
    * host: the mix of languages on the same host, smoothed towards that of its domain and that towards the mix of
      all rows; a row does not count for itself.

    All counts are grouped aggregations over the whole table. Returns the columns ``keep`` with ``language``,
    ``probability`` and ``accepted``: a known language that reaches ``least``, and text with letters at all.
    NULL or empty text is not accepted; NULL declarations, suffixes and hosts are values of their own, each counted as
    such. Repeated rows each get their result; an empty table is fine.
    """
    languages = model.languages
    n, known = len(languages) + 1, (*languages, UNKNOWN)
    code = lambda c: F.coalesce(
        F.when(F.lower(c).isin(*languages), F.lower(c)).when(c.isNotNull() & (c != ""), "other"), F.lit("none")
    )
    place = F.coalesce(F.lower(host), F.lit(""))
    given = rows.select(
        *[F.col(f"`{c}`") for c in keep], code(declared).alias("__declared"), code(suffix).alias("__suffix"),
        place.alias("__host"), F.regexp_extract(place, r"([^.]+\.[^.]+)$", 1).alias("__domain"), text.alias("__text"),
    )
    names = [*keep, "__declared", "__suffix", "__host", "__domain"]
    fields = [given.schema[c] for c in names] + [T.StructField("__n", T.LongType())]
    fields += [T.StructField(f"__{kind}{i}", T.DoubleType()) for kind in "lp" for i in range(n)]
    shared = rows.sparkSession.sparkContext.broadcast(model.table)
    with arrow_rows(rows.sparkSession, BATCH_ROWS):
        ev = stage(given.mapInArrow(_scorer(names, shared), T.StructType(fields)), "language-evidence")
    sums = lambda old, new: [F.sum(f"__{old}{i}").alias(f"__{new}{i}") for i in range(n)]
    hosts = stage(ev.groupBy("__host", "__domain").agg(*sums("p", "h")), "hosts")
    domains = hosts.groupBy("__domain").agg(*sums("h", "d"))
    whole = hosts.agg(*sums("h", "s")).first()
    share = np.array([(whole[f"__s{i}"] or 0.0) + 1 for i in range(n)])
    priors = stage(hosts.join(domains, "__domain").drop("__domain"), "priors")
    fuse = _fuser(
        keep, known, share / share.sum(), smooth, least, _evidence(ev, "__declared", n), _evidence(ev, "__suffix", n)
    )
    schema = [given.schema[c] for c in keep] + [
        T.StructField("language", T.StringType()), T.StructField("probability", T.DoubleType()),
        T.StructField("accepted", T.BooleanType()),
    ]
    return ev.join(priors, "__host").mapInArrow(fuse, T.StructType(schema))


def markup_text(html: Column) -> Column:
    """The text of a page without scripts, styles, comments and tags."""
    bare = F.regexp_replace(html, r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->", " ")
    return F.regexp_replace(bare, r"<[^>]*>|&[a-zA-Z]+;", " ")


def markup_language(html: Column) -> Column:
    """The primary language the page declares, or ''."""
    return F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})", 1)


def url_host(url: Column) -> Column:
    return F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1)


def url_language(url: Column) -> Column:
    """The language that the country suffix names, or else the first folder of the path."""
    ending = F.regexp_extract(url_host(url), r"\.([a-zA-Z]{2})$", 1)
    folder = F.regexp_extract(url, r"://[^/]+/([a-zA-Z]{2})(?:[/_?#-]|$)", 1)
    by_country = F.lit(None).cast("string")
    for country, language in SUFFIXES.items():
        by_country = F.when(F.lower(ending) == country, language).otherwise(by_country)
    return F.coalesce(by_country, folder)
