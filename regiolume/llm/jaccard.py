"""Exact Jaccard join of documents on word shingles, by pivots and regions."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regiolume.llm.bytes_view import LOWERED, as_bytes, mix, slices, word_hashes, words
from regiolume.llm.common import BATCH_ROWS, LEAST_ID, id_or_least, may_be_in, release
from regiolume.llm.components import components
from regiolume.session import arrow_rows, discard, stage

#: Bits of the table that tells frequent shingles from rare ones, and the parts it is added up in.
TABLE_BITS, TABLE_PARTS = 18, 16
#: Pivot coordinates of a set: its shingles counted in so many fixed parts of all shingles, coarse and fine.
COORDINATES, FINE = 32, 64
#: Pivot documents of a region, to how many of all its pivots a document is compared, and members that are compared
#: with each other in one block.
CENTRES, CLOSEST, SHARE = 2, 2, 4096
#: Rows with the texts of a pair that a task gets at once.
PAIR_ROWS = 512
MET = "a long, b long, apart double, wanted long, met long"


def shingle_sets(column: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row and sorted distinct hashed shingles of each text that has words."""
    for first, data, offsets in slices(*as_bytes(column)):
        low = LOWERED[data]
        starts, ends, row = words(low, offsets)
        single = word_hashes(low, starts, ends)
        joined = single
        for i in range(1, width):  # hash of the words i.. of a window, from the hash of those before
            joined = mix(joined[: len(single) - i] * np.uint64(0x9E3779B97F4A7C15) + single[i:])
        counts = np.bincount(row, minlength=len(offsets) - 1)
        at = np.concatenate(([0], np.cumsum(counts)))
        for i in np.flatnonzero(counts):
            a, n = at[i], counts[i]
            if n >= width:
                yield first + int(i), np.unique(joined[a : a + n - width + 1])
            else:
                whole = np.array([n], np.uint64)
                for h in single[a : a + n]:
                    whole = mix(whole * np.uint64(31) ^ h)
                yield first + int(i), whole


def _signature(found: np.ndarray) -> tuple[int, int]:
    """128 bits of a set."""
    a = found.sum(dtype=np.uint64)
    b = mix(found * np.uint64(0xD6E8FEB86659FD93)).sum(dtype=np.uint64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))


SIGNED = "id long, n long, s1 long, s2 long, part int, counts binary"


def _sign(width: int):
    """A row for each document with its set's size and signature, and the task's counts of shingles by hash."""
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
    names = ["id", "n", "s1", "s2", "part", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << TABLE_BITS, np.int64)
        for batch in batches:
            rows = [[i, 0, 0, 0, None, None] for i in batch.column("id").to_pylist()]
            pending: list[np.ndarray] = []
            for row, found in shingle_sets(batch.column("text"), width):
                rows[row][1:4] = len(found), *_signature(found)
                pending.append(found)
                if len(pending) == 1000:
                    _count(counts, pending)
            _count(counts, pending)
            if rows:
                columns = zip(zip(*rows, strict=True), types, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names)
        if counts.any():
            rows = [(None, None, None, None, i, c.tobytes()) for i, c in enumerate(np.split(counts, TABLE_PARTS))]
            columns = zip(zip(*rows, strict=True), types, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names)

    return run


def _count(counts: np.ndarray, pending: list[np.ndarray]) -> None:
    if pending:
        places = (np.concatenate(pending) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        counts += np.bincount(places, minlength=len(counts))
        pending.clear()


def _add_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, total = None, None
    for batch in batches:
        for p, c in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            new = np.frombuffer(c, np.int64)
            part, total = p, new.copy() if total is None else total + new
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([total.tobytes()])], ["part", "counts"])


def _frequency_classes(signed: DataFrame) -> np.ndarray:
    """Per hash range 0 if its shingles are no more frequent than usual, else the logarithm of how much more."""
    summed = signed.where("part is not null").select("part", "counts").groupBy("part").applyInArrow(
        _add_parts, "part int, counts binary"
    )
    counts = np.zeros(1 << TABLE_BITS, np.int64)
    size = len(counts) // TABLE_PARTS
    for r in summed.toLocalIterator():
        counts[r["part"] * size : (r["part"] + 1) * size] = np.frombuffer(r["counts"], np.int64)
    return np.log2(np.maximum(1, counts / max(1.0, counts.mean()))).astype(np.uint8)


def wanted_meetings(n):
    """In how many regions a document of ``n`` shingles has to meet a linked one of its size or more.

    With so many regions beyond the first floor(n * (1 - t)) ones, two linked sets have this many of theirs in common; long
    texts, which meet by chance here and there, are told apart by it.
    """
    return 1 + n // 100


def _place(width: int, percent: int, classes):
    """The regions of each document, and its pivot coordinates."""
    names = ["id", "s1", "n", "regions", "coordinates", "fine"]
    types = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_pylist()
            rows = []
            for row, found in shingle_sets(batch.column("text"), width):
                n = len(found)
                order = np.lexsort((found, classes.value[(found >> np.uint64(64 - TABLE_BITS)).astype(np.int64)]))
                near = found[order[: n - -(-percent * n // 100) + int(wanted_meetings(n))]].view(np.int64)
                parts = np.bincount((found % np.uint64(FINE)).astype(np.int64), minlength=FINE)
                coarse = parts.reshape(-1, COORDINATES).sum(axis=0).astype(np.int32)
                fine = np.minimum(parts, 255).astype(np.uint8).tobytes()
                rows.append((ids[row], _signature(found)[0], n, near, coarse, fine))
            if rows:
                columns = zip(zip(*rows, strict=True), types, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names)

    return run


def _wanted_texts(width: int):
    """The texts whose sets are compared, compressed: a text takes a third of the room of its hashed shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for batch in batches:
            reps, marks = batch.column("rep").to_pylist(), batch.column("mark").to_pylist()
            texts = batch.column("text").cast(pa.binary())
            rows = []
            for row, found in shingle_sets(batch.column("text"), width):
                if _signature(found)[0] == marks[row]:
                    text = texts[row].as_py()
                    rows.append((reps[row], len(text), codec.compress(text, asbytes=True)))
            if rows:
                types = (pa.int64(), pa.int64(), pa.binary())
                columns = zip(zip(*rows, strict=True), types, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], ["rep", "raw", "packed"])

    return run


#: Pairs that a task holds at once.
_AT_ONCE = 1 << 16
_MEMBER = ("rep", "n", "root", "share", "visits", "fine")
_BLOCK = ("token", "cell", "one", "two")


def _near_pairs(percent: int, rows: dict[str, np.ndarray], left: np.ndarray, right: np.ndarray, large: np.ndarray) -> np.ndarray:
    """Of pairs of rows those of different components whose sizes and coordinates differ by no more than a link's sets can."""
    n, root, visits = rows["n"], rows["root"], rows["visits"]
    good = (root[left] != root[right]) & ~(visits[left] & visits[right]) & (rows["rep"][left] != rows["rep"][right])
    good &= (100 * n[left] >= percent * n[right]) & (100 * n[right] >= percent * n[left])
    left, right = left[good], right[good]
    most = (n[left] + n[right]) * (100 - percent)
    # Pivots are parts of all shingles: the difference of the counts in them is at most that of the sets.
    for parts in ("coarse", "fine"):
        apart = np.abs(rows[parts][left] - rows[parts][right]).sum(axis=1, dtype=np.int64)
        good = apart * (100 + percent) <= most
        left, right, most, apart = left[good], right[good], most[good], apart[good]
    x, y = rows["rep"][left], rows["rep"][right]
    wanted = wanted_meetings(np.minimum(n[left], n[right]))
    met = np.where(large[left], wanted, 1)
    share = (1000 * apart // np.maximum(1, n[left] + n[right])).astype(np.int64)
    return np.stack([np.minimum(x, y), np.maximum(x, y), share, wanted, met], axis=1)


def _within(percent: int):
    """Near pairs of the members of each block; rows come sorted by block, and a block has few."""

    def pairs(block: np.ndarray, rows: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        end = np.searchsorted(block, block, side="right")
        first = np.arange(1, len(block) + 1)
        size, total, at = end - first, np.concatenate(([0], np.cumsum(end - first))), 0
        large = rows["large"]
        while at < len(size):
            to = max(at + 1, int(np.searchsorted(total, total[at] + _AT_ONCE, side="right")) - 1)
            left = np.repeat(np.arange(at, to), size[at:to])
            right = first[left] + np.arange(len(left)) - (total[left] - total[at])
            # In a block of two shares only pairs across them are meant; the others have a block of their own.
            meant = rows["same"][left] | (rows["share"][left] != rows["share"][right])
            found = _near_pairs(percent, rows, left[meant], right[meant], large)
            if len(found):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found[:, 0]), pa.array(found[:, 1]), pa.array(found[:, 2] / 1000), pa.array(found[:, 3]), pa.array(found[:, 4])],
                    ["a", "b", "apart", "wanted", "met"],
                )
            at = to

    def unpack(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        rows = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("rep", "n", "root", "share", "visits")}
        fine = np.frombuffer(b"".join(batch.column("fine").to_pylist()), np.uint8).reshape(-1, FINE).astype(np.int16)
        rows |= {"fine": fine, "coarse": fine.reshape(len(fine), -1, COORDINATES).sum(axis=1, dtype=np.int16)}
        one, two = batch.column("one").to_numpy(), batch.column("two").to_numpy()
        return rows | {"same": one == two, "large": batch.column("cell").to_numpy() >= 0}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, held = np.empty((0, len(_BLOCK)), np.int64), None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = unpack(batch)
            held = new if held is None else {c: np.concatenate([v, new[c]]) for c, v in held.items()}
            keys = np.concatenate([keys, np.stack([batch.column(c).to_numpy() for c in _BLOCK], axis=1)])
            block = np.cumsum(np.concatenate(([0], (keys[1:] != keys[:-1]).any(axis=1))))
            cut = int(np.searchsorted(block, block[-1], side="left"))  # the last block may go on
            yield from pairs(block[:cut], {c: v[:cut] for c, v in held.items()})
            keys, held = keys[cut:], {c: v[cut:] for c, v in held.items()}
        if held is not None:
            yield from pairs(np.zeros(len(keys), np.int64), held)

    return run


#: Bytes of text whose sets a task builds at once; one pair, if its texts are longer.
_COMPARED = 4 << 20


def _linked(width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")

        def sets(part: pa.RecordBatch, side: str) -> list[np.ndarray]:
            packed = zip(part.column(f"p{side}").to_pylist(), part.column(f"r{side}").to_pylist(), strict=True)
            texts = pa.array([codec.decompress(p, n, asbytes=True) for p, n in packed], pa.binary())
            return [found for _, found in shingle_sets(texts, width)]

        for batch in batches:
            size = batch.column("ra").to_numpy() + batch.column("rb").to_numpy()
            total, at = np.concatenate(([0], np.cumsum(size))), 0
            while at < batch.num_rows:
                to = max(at + 1, int(np.searchsorted(total, total[at] + _COMPARED, side="right")) - 1)
                part, good, at = batch.slice(at, to - at), [], to
                for a, b in zip(sets(part, "a"), sets(part, "b"), strict=True):
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    good.append(100 * both >= percent * (len(a) + len(b) - both))
                yield part.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


class _Join:
    """What the steps share: the texts of the representatives, members of regions, and the links found so far."""

    def __init__(
        self, texts: DataFrame, marks: DataFrame, repeated: bool, placed: DataFrame, members: DataFrame, width: int, percent: int
    ):
        self.texts, self.marks, self.repeated, self.placed, self.members = texts, marks, repeated, placed, members
        self.width, self.percent = width, percent
        self.links = None
        self.roots = None

    def verify(self, pairs: DataFrame) -> None:
        """Compare the sets of pairs, and bring links and components up to date."""
        spark = pairs.sparkSession
        pairs = stage(pairs.select("a", "b"), "pairs")
        ends = pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
        wanted = stage(ends.join(self.marks, "rep"), "wanted")
        # Few texts are compared; most of the others stay where they are read.
        texts = may_be_in(self.texts, wanted, "id", "wanted").where("wanted").join(wanted, "id").select("rep", "mark", "text")
        packed = texts.mapInArrow(_wanted_texts(self.width), "rep long, raw long, packed binary")
        packed = stage(packed.dropDuplicates(["rep"]) if self.repeated else packed, "compared")
        side = lambda x: packed.select(
            F.col("rep").alias(x), F.col("raw").alias(f"r{x}"), F.col("packed").alias(f"p{x}")
        )
        met = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ra", "rb", "pa", "pb")
        found = met.mapInArrow(_linked(self.width, self.percent), "a long, b long")
        # A component needs no more of the old links than each node's one to its root.
        old = self.roots.select(F.col("node").alias("a"), F.col("root").alias("b")) if self.roots is not None else None
        with arrow_rows(spark, PAIR_ROWS):  # a pair brings two whole texts
            links = stage(found if old is None else found.unionByName(old), "links")
        roots = stage(components(links), "roots")
        discard(pairs, wanted, packed, links, *([self.roots] if self.roots is not None else []))
        self.roots = roots
        release(spark)

    def stars(self) -> DataFrame:
        """Each document with the closest of its regions' pivots, where they are near.

        Pivots are the members that meet most others in all their regions: in a group of near copies the text that they are
        copies of. The closest are those that a document meets most often.
        """
        scores = self.members.groupBy("rep").agg(F.sum("size").alias("score"))
        order = Window.partitionBy("token").orderBy(F.desc("score"), "rep")
        chosen = self.members.join(scores, "rep").withColumn("k", F.row_number().over(order)).where(F.col("k") <= CENTRES)
        chosen = stage(chosen.select("token", F.col("rep").alias("c"), F.col("n").alias("cn")), "centres")
        met = self.members.join(chosen, "token").where("rep <> c")
        alike = 100 * F.least("n", "cn") >= self.percent * F.greatest("n", "cn")
        met = met.where(alike).groupBy("rep", "c").agg(F.count(F.lit(1)).alias("met"))
        order = Window.partitionBy("rep").orderBy(F.desc("met"), "c")
        met = met.withColumn("k", F.row_number().over(order)).where(F.col("k") <= CLOSEST)
        pairs = stage(met.select(F.least("rep", "c").alias("a"), F.greatest("rep", "c").alias("b")).distinct(), "stars")
        side = lambda x: self.placed.select(F.col("rep").alias(x), F.col("n").alias(f"n{x}"), F.col("coordinates").alias(f"c{x}"))
        apart = F.aggregate(F.zip_with("ca", "cb", lambda x, y: F.abs(x - y)), F.lit(0), lambda s, d: s + d)
        pairs = pairs.join(side("a"), "a").join(side("b"), "b")
        return pairs.where(apart * (100 + self.percent) <= (F.col("na") + F.col("nb")) * (100 - self.percent)).select("a", "b")

    def blocks(self) -> DataFrame | None:
        """The members of regions that have several components, dealt to blocks; none where all regions have one."""
        found = self.members.join(self.roots.withColumnRenamed("node", "rep"), "rep", "left")
        found = found.select("token", "rep", "n", "size", F.coalesce("root", "rep").alias("root"))
        several = found.groupBy("token").agg(F.min("root").alias("x"), F.max("root").alias("y"))
        several = stage(several.where("x < y").select("token"), "several")
        if several.isEmpty():
            discard(several)
            return None
        live = stage(found.join(several, "token"), "live")
        discard(several)
        zero = F.lit(0).cast("long")
        small = live.where(F.col("size") <= SHARE).select(
            "token", F.lit(-1).cast("long").alias("cell"), zero.alias("one"), zero.alias("two"),
            "rep", "n", "root", zero.alias("share"), F.lit(False).alias("visits"),
        )
        # The empty set as pivot: sizes of a link differ by one class at most. Smaller sets visit the class above theirs.
        step = math.log(100 / self.percent) * (1 + 1e-9) if self.percent < 100 else 1e-9
        own = F.floor(F.log(F.col("n").cast("double")) / step) if self.percent < 100 else F.col("n")
        cells = F.explode(F.array(
            F.struct(own.alias("cell"), F.lit(False).alias("visits")), F.struct((own + 1).alias("cell"), F.lit(True).alias("visits"))
        )).alias("at")
        large = live.where(F.col("size") > SHARE).select("token", "rep", "n", "root", cells).select("token", "rep", "n", "root", "at.*")
        sizes = large.groupBy("token", "cell").agg(F.ceil(F.count(F.lit(1)) / SHARE).alias("shares"), F.min("visits").alias("only"))
        large = large.join(stage(sizes.where("not only").drop("only"), "cells"), ["token", "cell"])
        large = large.withColumn("share", F.pmod(F.xxhash64("rep"), F.col("shares")))
        other = F.explode(F.sequence(zero, F.col("shares") - 1)).alias("other")
        large = large.select("*", other).select(
            "token", "cell", F.least("share", "other").alias("one"), F.greatest("share", "other").alias("two"),
            "rep", "n", "root", "share", "visits",
        )
        return small.unionByName(large).join(self.placed.select("rep", "fine"), "rep").select(*_BLOCK, *_MEMBER)

    def near(self) -> DataFrame | None:
        """All near pairs of different components; none where all regions have one."""
        blocks = self.blocks()
        if blocks is None:
            return None
        dealt = blocks.repartition(*_BLOCK).sortWithinPartitions(*_BLOCK)
        pairs = dealt.mapInArrow(_within(self.percent), MET).groupBy("a", "b").agg(
            F.min("apart").alias("apart"), F.max("wanted").alias("wanted"), F.sum("met").alias("met")
        )
        # Linked sets that meet less often in small regions share a large one, where meeting once is enough.
        return stage(pairs.where("met >= wanted").select("a", "b", "apart"), "near")

    def apart(self, pairs: DataFrame) -> DataFrame:
        """Those of the pairs that are still in different components, with these."""
        root = lambda x: self.roots.select(F.col("node").alias(x), F.col("root").alias(f"r{x}"))
        met = pairs.join(root("a"), "a", "left").join(root("b"), "b", "left")
        met = met.select("a", "b", "apart", F.coalesce("ra", "a").alias("ra"), F.coalesce("rb", "b").alias("rb"))
        return met.where("ra <> rb")


def jaccard_components(
    docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Documents linked by Jaccard similarity of at least ``percent`` of 100, and their connected components.

    A document's set holds its distinct shingles of ``width`` words (runs without blanks, A-Z in lower case); with fewer
    words the whole sequence is the one shingle; without words the set is empty and linked with nothing. Returns one row for
    each row: ``id, n_shingles, component_id``, the smallest id within reach of links.

    The join is exact and ends after three comparisons, whatever the data. Documents with equal sets are one class, compared
    once.

    * Regions. This step is a prefix filter: a document comes to a region for each of its first floor(n * (1 - t)) + m shingles, in
      one order of all shingles (rare ones first, by hashed counts over all documents). Two linked documents meet in at
      least m regions, m being ``wanted_meetings``. As a metric join, the pivots are the sets of one shingle and the window
      is what a set within the wanted distance can miss.
    * Pivot documents. Every region takes the documents closest to its mean as pivots, and each document is compared with
      the closest pivots of all its regions. Groups of copies become components by that, and regions of one component are done.
    * Windows. In the other regions pairs of different components are dropped by the triangle inequality on the size of
      the symmetric difference, with the empty set (sizes) and with the parts of fixed partitions of all shingles
      (counts in them) as pivots. Regions of more than ``SHARE`` members join again by classes of size: a document
      visits the class next to its own. What is then still larger is dealt to blocks.
    * What is left is compared, first the closest pair of each two components, then, for the components that are still apart, all.

    Every row is a document of its own, also where rows share an id: each has the size and the component of its own text.
    A NULL id counts as the smallest id and comes back NULL. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    texts = docs.select(id_or_least(id_col).alias("id"), F.col(f"`{text_col}`").alias("text"))
    with arrow_rows(spark, BATCH_ROWS):
        signed = stage(texts.mapInArrow(_sign(width), SIGNED), "signatures")
    given = signed.where("part is null").select("id", "s1", "s2", "n")
    classes = given.where("n > 0").groupBy("s1", "s2", "n").agg(F.min("id").alias("first"))
    classes = stage(classes.withColumn("rep", F.monotonically_increasing_id()), "classes")
    repeated = not given.where("n > 0").groupBy("id", "s1").count().where("count > 1").isEmpty()
    shared = spark.sparkContext.broadcast(_frequency_classes(signed))
    schema = "id long, s1 long, n long, regions array<long>, coordinates array<int>, fine binary"
    placed = texts.mapInArrow(_place(width, percent, shared), schema)
    marks = classes.select("rep", F.col("first").alias("id"), F.col("s1").alias("mark"))
    placed = placed.join(marks.withColumnRenamed("mark", "s1"), ["id", "s1"])
    placed = placed.select("rep", "n", "regions", "coordinates", "fine")
    with arrow_rows(spark, BATCH_ROWS):
        placed = stage(placed.dropDuplicates(["rep"]) if repeated else placed, "placed")
    release(spark)

    members = placed.select("rep", "n", F.explode("regions").alias("token"))
    regions = members.groupBy("token").agg(F.count(F.lit(1)).alias("size"))  # a class has a shingle once
    regions = stage(regions.where("size > 1"), "regions")
    members = stage(members.join(regions, "token").select("token", "rep", "n", "size"), "members")
    discard(regions)
    release(spark)

    join = _Join(texts, marks, repeated, placed, members, width, percent)
    join.verify(join.stars())
    pairs = join.near()
    if pairs is not None:
        closest = join.apart(pairs).groupBy(F.least("ra", "rb"), F.greatest("ra", "rb")).agg(F.min(F.struct("apart", "a", "b")).alias("p"))
        closest = stage(closest.select("p.a", "p.b"), "closest")
        join.verify(closest)
        join.verify(join.apart(pairs.join(closest, ["a", "b"], "left_anti")).select("a", "b"))
        discard(pairs, closest)

    reach = classes.join(join.roots.withColumnRenamed("node", "rep"), "rep", "left")
    reach = stage(reach.select("s1", "s2", "n", "first", F.coalesce("root", "rep").alias("root")), "reach")
    least = reach.groupBy("root").agg(F.min("first").alias("component"))
    reach = stage(reach.join(least, "root").select("s1", "s2", "n", "component"), "components")
    discard(placed, members, classes, join.roots)
    out = given.join(reach, ["s1", "s2", "n"], "left")
    known = lambda c: F.nullif(c, F.lit(LEAST_ID))
    return out.select(
        known(F.col("id")).alias("id"), F.col("n").alias("n_shingles"),
        known(F.coalesce("component", "id")).alias("component_id"),
    )
