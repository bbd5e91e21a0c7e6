"""Cubes of mergeable states and deliveries read by layout, against plain Python."""

import itertools
import random
from collections import defaultdict

import pytest
from conftest import rows

from regiolume.operators import cube
from regiolume.sources import Layout, read_layout

SETS = {"all": (), "a": ("a",), "ab": ("a", "b"), "b": ("b",)}


def cube_by_hand(data):
    out = set()
    for name, keys in SETS.items():
        groups = defaultdict(list)
        for a, b, v in data:
            groups[tuple(x if k in keys else None for k, x in (("a", a), ("b", b)))].append(v)
        for (a, b), values in groups.items():
            some = [v for v in values if v is not None]
            out.add((name, a, b, len(values), len(some), sum(some) if some else None, min(some, default=None), max(some, default=None)))
    return out


def test_a_merge_of_parts_is_the_whole(spark):
    r = random.Random(1)
    data = [(r.choice(["x", "y", None]), r.choice([1, 2, None]), r.choice([None, 1, 5, -7, 100])) for _ in range(300)]
    kind = "a string, b int, v long"
    made = lambda some: cube.build_cube(spark.createDataFrame(some, kind), SETS, "v")
    assert {tuple(x) for x in made(data).collect()} == cube_by_hand(data)
    for cut in (0, 1, 120, 300):
        parts = [p for p in (data[:cut], data[cut:]) if p]
        assert {tuple(x) for x in cube.merge_cubes(*map(made, parts)).collect()} == cube_by_hand(data)
    whole = made(data)
    got = cube.look_up(whole, "ab", ["b"], {"a": None}).select("b", cube.strict_total().alias("t"), cube.mean().alias("m")).collect()
    for b, t, m in got:
        values = [v for x, y, v in data if x is None and y == b]
        some = [v for v in values if v is not None]
        assert t == (sum(some) if len(some) == len(values) else None) and m == pytest.approx(sum(some) / len(some))


def write(path, body, encoding="utf-8"):
    path.write_bytes(body.encode(encoding))
    return str(path)


def test_every_line_is_a_row_or_rejected(spark, tmp_path):
    body = '﻿Extra,ID,Price,Name\nx,1,2.5,"a, ""b"""\ny,,3,c\nz,2,abc,d\nw,3\nv,4,5,e,more\nu, 5 ,,\n'
    layout = Layout({"id": "int", "price": "double", "name": "string"}, keys=("id",))
    good, bad = read_layout(spark, write(tmp_path / "a.csv", body), layout)
    assert rows(good) == [(1, 2.5, 'a, "b"'), (5, None, None)]
    assert sorted((x.reason, x.line.split(",")[0]) for x in bad.collect()) == [("cells", "v"), ("cells", "w"), ("key id", "y"), ("type price", "z")]
    assert all(x.file.endswith("a.csv") for x in bad.collect())


@pytest.mark.parametrize("encoding", ["ISO-8859-1", "UTF-8"])
def test_headerless_layout(spark, tmp_path, encoding):
    lines = [f"{k}|Zürich {k}|{'' if k % 3 == 0 else k * 1.5}|x" for k in range(30)] + ["short|line"]
    layout = Layout({"price": "double", "place": "string", "k": "string"}, "|", encoding, order=("k", "place", "price", "unused"), keys=("k", "price"))
    good, bad = read_layout(spark, write(tmp_path / "b.txt", "\n".join(lines) + "\n", encoding), layout)
    want = sorted((k * 1.5, f"Zürich {k}", str(k)) for k in range(30) if k % 3)
    assert rows(good) == want
    reasons = sorted(x.reason for x in bad.collect())
    assert reasons == ["cells"] + ["key price"] * 10 and good.count() + len(reasons) == len(lines)


def test_layouts_differ_only_in_form(spark, tmp_path):
    layouts = [Layout({"k": "int"}, sep, order=order, keys=("k",)) for sep, order in itertools.product(",\t|", [(), ("a", "k")])]
    for i, layout in enumerate(layouts):
        head = "" if layout.order else f"A{layout.sep}K\n"
        path = write(tmp_path / f"{i}.txt", head + "".join(f"v{layout.sep}{k}\n" for k in range(5)))
        good, bad = read_layout(spark, path, layout)
        assert rows(good) == [(k,) for k in range(5)] and bad.count() == 0
