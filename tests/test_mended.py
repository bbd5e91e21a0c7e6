"""Rules that clean stand-ins do not reach: labels already there, quotes, NaN, odd years, several files."""

import math
import os
import pathlib
import statistics
import subprocess
import sys

import pyspark
import pytest
from conftest import rows

from regiolume import session, sources
from regiolume.catalog import ENTRIES
from regiolume.functions.text import title_case
from regiolume.operators.filters import drop_any_null
from regiolume.operators.joins import lookup
from regiolume.operators.quantile import exact_quantile
from regiolume.operators.topk import order_by_measure, slice_rows
from regiolume.operators.totals import add_region, add_region_levels, merge_buckets
from regiolume.plans import congestion, forecast, tax


def test_derived_rows_stand_beside_labels(spark):
    df = spark.createDataFrame([("A", 1, 1.0), ("B", 1, 2.0), ("Region", 1, 10.0)], "area string, level int, n double")
    got = add_region(df, "area", [], ["n"])
    assert rows(got.filter("area = 'Region'"), "n") == [(10.0,), (13.0,)]
    levels = add_region_levels(df, "level", "area", [], ["n"], {1: "Region"})
    assert rows(levels.filter("area = 'Region'"), "n") == [(10.0,), (13.0,)]
    merged = merge_buckets(df, "area", [], ["n"], {"Region": ["A", "B"]})
    assert rows(merged.filter("area = 'Region'"), "n") == [(3.0,), (10.0,)]


def test_quotes_in_every_reader(spark, tmp_path):
    value = 'say "hi", ok'
    line = '"say ""hi"", ok"'
    for folder, text in (("plain", f"k,v\n1,{line}\n"), ("bare", f"1,{line}\n"), ("titled", f"T\nk,v\n1,{line}\n"), ("y2020", f"k,v\n1,{line}\n")):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "a.csv").write_text(text)
    at = lambda x: str(tmp_path / x)
    assert rows(sources.read_csv(spark, at("plain"), "k int, v string"), "v") == [(value,)]
    assert rows(sources.read_named(spark, at("plain"), {"v": "string"}), "v") == [(value,)]
    assert rows(sources.read_delimited(spark, at("bare"), ["k", "v"], ","), "v") == [(value,)]
    assert rows(sources.read_below_titles(spark, at("titled"), 1), "v") == [(value,)]
    assert rows(sources.read_tagged(spark, at("y2020"), "k int, v string", "year", r"y(\d{4})"), "v", "year") == [(value, "2020")]


def test_named_reader_refuses_another_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("A,B\n1,2\n")
    (tmp_path / "b.csv").write_text("B,A\n3,4\n")
    with pytest.raises(Exception, match="(?i)header"):
        sources.read_named(spark, str(tmp_path), {"a": "int", "b": "int"}).collect()


@pytest.mark.parametrize("values", [
    [float("nan"), 1.0, 2.0], [i * 1e-9 for i in range(3000)], [500_000 + i / 40 for i in range(4000)], [-5.0, -5.0, 0.0, 7.5], [3.0],
])
def test_quantile(spark, values):
    df = spark.createDataFrame([("g", v) for v in values], "k string, v double")
    filled = [v for v in values if not math.isnan(v)]
    got = exact_quantile(df, ["k"], "v").first()
    assert got["median"] == pytest.approx(statistics.median(filled), rel=1e-12)


def test_tax_files_of_any_year(spark):
    data = [("f1", 1, "Auburn 2", " ", None), ("f1", 2, "2014 Quarter 4", "Sales", 1.0), ("f1", 3, "2030 Quarter 1", "Sales", 2.0),
            ("f2", 1, "Kent", " ", None), ("f2", 2, "2022 Quarter 2", "Sales", 3.0)]
    df = spark.createDataFrame(data, "file string, pos int, Year string, `Tax.Type` string, `Total.Taxable` double")
    got = tax.quarterly_sales(df)
    assert {(r.geography, str(r.quarter), r.total) for r in got.collect()} == {
        ("Auburn 2", "2014-10-01", 1.0), ("Auburn 2", "2030-01-01", 2.0), ("Kent", "2022-04-01", 3.0)}
    with pytest.raises(ValueError, match="occurs"):
        tax.quarterly_sales(df.drop("file"))


def test_forecast_heads(spark):
    heads = ["1996.1", "1996.2", "1996.2999999999999", "1996.4000000000001", "1997.0999999999999", "1997.7"]
    df = spark.createDataFrame([("Employment (thous.)", "n", *[1.0] * len(heads))], ["Metric", "Note", *heads])
    got = [str(r.quarter) for r in forecast.forecast(df).orderBy("quarter").collect()]
    assert got == ["None", "1996-01-01", "1996-04-01", "1996-07-01", "1996-10-01", "1997-01-01"]


def test_hour_without_ratios_has_zero(spark):
    df = spark.createDataFrame([(2020, 2.0, 1.0, None, 0.4), (2020, 1.0, 1.0, None, None)],
                               "year int, miles double, thrulanes double, `5am_ratio` double, `6am_ratio` double")
    got = {r.hour: (r.congested_miles, r.share) for r in congestion.heavy_share_by_hour(df).collect()}
    assert got == {5: (0.0, 0.0), 6: (2.0, 2 / 3)}


def test_small_rules(spark):
    df = spark.createDataFrame([("african-american women", 1.0), ("a - b", float("nan")), (None, 2.0)], "t string, v double")
    assert rows(df.select(title_case("t").alias("t")), "t") == [(None,), ("A - B",), ("African-American Women",)]
    assert rows(drop_any_null(df), "v") == [(1.0,)]
    assert rows(lookup(df, {}, "t", "found", "none"), "found") == [("none",)] * 3
    assert [r.v for r in order_by_measure(df.na.drop(), "v", "t").collect()] == [1.0]


def test_open_slice(spark):
    df = spark.createDataFrame([(f, p) for f in ("a", None) for p in range(0, 40, 2)], "file string, pos int")
    got = rows(slice_rows(df, 4, None), "file", "pos")
    assert got == sorted(((f, p) for f in (None, "a") for p in range(6, 40, 2)), key=lambda r: (r[0] is not None, r))


SHARED = """
import pathlib, sys
sys.path.insert(0, {repo!r})
from regiolume import session
from regiolume.catalog import ENTRIES
spark = session.local_session("shared", 2, **{{"spark.checkpoint.dir": "file://{folder}"}})
assert session.stage(spark.range(5), "numbers").count() == 5
staged = lambda: [f.name for f in pathlib.Path({folder!r}).iterdir() if f.name.startswith(("numbers-", "side-"))]
assert len(staged()) == 1
assert ENTRIES["left_join_nullsafe"].run(spark, "/root/testdata/sf0.001").count() > 0
session.clear_scratch(spark)
assert not staged()
"""


def test_shared_scratch_folder(tmp_path):
    """The setting is fixed when a session starts, so it takes a session of its own."""
    folder = tmp_path / "shared"
    folder.mkdir()
    code = SHARED.format(repo=str(pathlib.Path(__file__).resolve().parents[1]), folder=str(folder))
    env = {k: v for k, v in os.environ.items() if not k.startswith(("PYSPARK_GATEWAY", "SPARK_"))}
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, env=env)
    assert done.returncode == 0, done.stderr[-2000:]


def test_cluster_needs_a_folder_with_scheme():
    class Conf:
        def __init__(self, root):
            self.root = root

        def get(self, _, default):
            return self.root or default

    class Session:
        def __init__(self, root):
            self.conf = Conf(root)
            self.sparkContext = type("C", (), {"master": "spark://host:7077", "applicationId": "app"})

    for root in (None, "/tmp/somewhere"):
        with pytest.raises(RuntimeError, match="scheme"):
            session.scratch_folder(Session(root), "x")
    assert session.scratch_folder(Session("hdfs://name/dir"), "x").startswith("hdfs://name/dir/x-")


CLUSTER = """
import pathlib, sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
from regiolume import session
from regiolume.catalog import ENTRIES
settings = {{"spark.ui.enabled": "false", "spark.driver.host": "127.0.0.1", "spark.sql.shuffle.partitions": "2", "spark.executor.memory": "900m",
    "spark.local.dir": "{folder}/local", "spark.sql.warehouse.dir": "{folder}/warehouse"}}
settings |= {{"spark.checkpoint.dir": "{folder}/named"}} if {named!r} == "named" else {{}}
spark = SparkSession.builder.master("local-cluster[2,1,1200]").config(map=settings).getOrCreate()
if {named!r} == "set":
    spark.sparkContext.setCheckpointDir("{folder}/set")
assert ENTRIES["left_join_nullsafe"].run(spark, "/root/testdata/sf0.001").count() > 0
assert ENTRIES["src_csv"].run(spark, "/root/testdata/sf0.001").count() == spark.read.parquet("/root/testdata/sf0.001/orders.parquet").count()
top = pathlib.Path({folder!r}, {named!r})
found = sorted(f.name.split("-")[0] for f in top.rglob("*") if f.name.startswith(("side-", "csv-")))
session.clear_scratch(spark)
spark.stop()
assert found == ["csv", "side"], found
"""


@pytest.mark.parametrize("named", ["named", "set", "warehouse"])
def test_cluster_on_one_machine(tmp_path, named):
    """With a folder without a scheme, with one that the program sets, and with none, where the warehouse serves."""
    code = CLUSTER.format(repo=str(pathlib.Path(__file__).resolve().parents[1]), folder=str(tmp_path), named=named)
    (tmp_path / "conf").mkdir()  # no defaults of this machine
    env = {k: v for k, v in os.environ.items() if not k.startswith(("PYSPARK_GATEWAY", "SPARK_"))} | {"SPARK_CONF_DIR": str(tmp_path / "conf")}
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, env=env)
    assert done.returncode == 0, done.stderr[-2000:]


def test_cluster_folder_that_all_share(spark, tmp_path):
    """Without a scheme or of ``file:`` it is taken once a table of many tasks comes back whole; one that can't be written is not."""

    class As:
        def __init__(self, real, **own):
            self.__dict__ |= own | {"real": real}

        def __getattr__(self, name):
            return getattr(self.real, name)

    def at(settings):
        conf = type("F", (), {"get": lambda self, name, default: settings.get(name, default)})()
        return session.scratch_folder(As(spark, conf=conf, sparkContext=As(spark.sparkContext, master="spark://host:7077")), "x")

    assert at({"spark.checkpoint.dir": f"{tmp_path}"}).startswith(f"{tmp_path}/x-")
    assert at({"spark.checkpoint.dir": f"file://{tmp_path}"}).startswith(f"file://{tmp_path}/x-")
    assert not list(tmp_path.iterdir())
    (tmp_path / "file").touch()
    with pytest.raises(RuntimeError, match="scheme"):
        at({"spark.checkpoint.dir": f"{tmp_path}/file/below"})


JOINED = """
import pathlib, sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
from regiolume import session
from regiolume.catalog import ENTRIES
settings = {{"spark.ui.enabled": "false", "spark.driver.host": "127.0.0.1", "spark.sql.shuffle.partitions": "2", "spark.executor.memory": "900m",
    "spark.local.dir": "{folder}/local", "spark.sql.warehouse.dir": "{folder}/warehouse"}}
settings |= {{"spark.checkpoint.dir": "{named}"}} if {named!r} else {{}}
spark = SparkSession.builder.master("local-cluster[2,1,1200]").config(map=settings).getOrCreate()
spark.sparkContext.master = "spark://127.0.0.1:7077"
try:
    assert ENTRIES["left_join_nullsafe"].run(spark, "/root/testdata/sf0.001").count() > 0
    assert session.stage(spark.range(0, 50, 1, 10), "numbers").count() == 50
    print("whole")
except RuntimeError as e:
    print(e)
spark.stop()
"""


@pytest.mark.parametrize("named, said", [("{}/named", "whole"), ("", "whole"), ("/proc/self/cwd/kept", "set spark.checkpoint.dir to a folder, with its scheme")])
def test_cluster_of_its_own(tmp_path, named, said):
    """A folder that all executors see, without a scheme, or the warehouse; a folder that each process has for itself is refused."""
    for folder in ("conf", "home/work", "cwd"):
        (tmp_path / folder).mkdir(parents=True)
    for p in pathlib.Path(pyspark.__file__).parent.iterdir():  # executors work in Spark's home, which may be read-only
        if p.name not in ("conf", "work"):
            (tmp_path / "home" / p.name).symlink_to(p)
    code = JOINED.format(repo=str(pathlib.Path(__file__).resolve().parents[1]), folder=str(tmp_path), named=named.format(tmp_path))
    env = {k: v for k, v in os.environ.items() if not k.startswith(("PYSPARK_GATEWAY", "SPARK_"))}
    env |= {"SPARK_CONF_DIR": str(tmp_path / "conf"), "SPARK_HOME": str(tmp_path / "home")}
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, env=env, cwd=tmp_path / "cwd")
    assert done.returncode == 0 and done.stdout.strip().startswith(said), (done.stdout[-500:], done.stderr[-2000:])


def test_warehouse_of_a_cluster():
    """A warehouse that all machines reach serves; one on a machine's own disk does not."""

    def at(warehouse):
        context = type("C", (), {"master": "spark://host:7077", "applicationId": "app", "getCheckpointDir": lambda self: None})()
        conf = type("F", (), {"get": lambda self, name, default: {"spark.sql.warehouse.dir": warehouse}.get(name, default)})()
        return session.scratch_folder(type("S", (), {"conf": conf, "sparkContext": context})(), "x")

    assert at("hdfs://name/tables/").startswith("hdfs://name/tables/scratch/x-")
    with pytest.raises(RuntimeError, match="scheme"):
        at("file:/home/tables")


def test_one_scan_for_the_share_by_hour(spark):
    plan = ENTRIES["threshold_share_by_hour"].run(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    unique = ENTRIES["unique_transactions"].run(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in unique


def test_discard_deletes_what_was_staged(spark):
    import pathlib

    from regiolume.session import _STAGED, discard, stage

    kept, gone = stage(spark.range(5), "kept"), stage(spark.range(7), "gone")
    folders = _STAGED[spark.sparkContext.applicationId][-2:]
    discard(gone, spark.range(3))
    discard(gone)
    assert [pathlib.Path(f).exists() for f in folders] == [True, False] and kept.count() == 5
