import pathlib

import pytest
from conftest import rows
from pyspark.sql import functions as F

from regiolume import schema, session, sources
from regiolume.operators.topk import slice_rows
from regiolume.plans import claims, residential


def put(path, body, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(body.encode(encoding))
    return str(path)


def test_csv_with_mark_and_quoted_commas(spark, tmp_path):
    path = put(tmp_path / "a.csv", '﻿year,make,share\n2019,"Ford, Inc",1.98e-4\n2020,KIA,\n')
    got = sources.read_csv(spark, path, "year INT, make STRING, share DOUBLE")
    assert rows(got) == [(2019, "Ford, Inc", 1.98e-4), (2020, "KIA", None)]


def test_delimited_encodings_and_leading_zeros(spark, tmp_path):
    pipe = put(tmp_path / "p.txt", "0012|José|5\n0013|x|\n", "latin-1")
    assert rows(sources.read_delimited(spark, pipe, ["k", "n", "v"], "|", "ISO-8859-1")) == [("0012", "José", "5"), ("0013", "x", None)]
    tab = put(tmp_path / "t.txt", "code\tname\n01\tŁódź\n", "utf-16-le")
    assert rows(sources.read_delimited(spark, tab, "code STRING, name STRING", "\t", "UTF-16LE", header=True)) == [("01", "Łódź")]


def test_year_from_the_file_name(spark, tmp_path):
    paths = [put(tmp_path / f"May_{y}_speed.csv", f"a\n{y % 10}\n") for y in (2019, 2020)]
    got = sources.read_tagged(spark, paths, "a INT", "year", r"May_(\d{4})", "int")
    assert rows(got) == [(0, 2020), (9, 2019)]


def test_header_below_titles(spark, tmp_path):
    path = put(tmp_path / "tab.csv", 'Title, with comma\n\nmore\n"Line",County Name,,2020\n1,King,x,5\n\n2,"Pierce, WA",y,6\n')
    got = sources.read_below_titles(spark, path, skip=3)
    assert got.columns == ["file", "pos", "Line", "County.Name", "X3", "2020"]
    assert rows(got, "pos", "`County.Name`", "`2020`") == [(1, "King", "5"), (3, "Pierce, WA", "6")]
    assert rows(slice_rows(got, 2, 2), "Line") == [("2",)]
    typed = sources.read_below_titles(spark, path, 3, "line INT, county STRING, x STRING, n INT")
    assert rows(typed, "line", "n") == [(1, 5), (2, 6)]
    with pytest.raises(ValueError):
        sources.read_below_titles(spark, path, skip=99)


def test_line_numbers_hold_across_file_splits(spark, tmp_path):
    lines = [f"line {i}" for i in range(5000)]
    put(tmp_path / "many" / "a.txt", "\n".join(lines) + "\n")
    put(tmp_path / "many" / "b.txt", "\r\n".join(lines[:10]) + "\r\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = sources.numbered_lines(spark, str(tmp_path / "many"))
        assert got.select("line").distinct().count() == 5000
        wrong = got.filter(F.col("line") != F.concat(F.lit("line "), F.col("pos")))
        assert got.count() == 5010 and wrong.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_tabs_with_different_columns(spark, tmp_path):
    a = put(tmp_path / "King.csv", "title\nIndustry,Week 1\nx,5\n")
    b = put(tmp_path / "Kitsap.csv", "title\nIndustry,Week 1,Week 2\ny,6,7\n")
    got = sources.read_tabs(spark, {"King": a, "Kitsap": b}, 1, "county")
    assert rows(got, "county", "Industry", "`Week.1`", "`Week.2`") == [("King", "x", "5", None), ("Kitsap", "y", "6", "7")]


REPORT = """Weekly claims
 page 1
   1/5/2019   10,000   500   5.3   9,500   1/4/2020   12,000   -70   -0.6  11,000
  1/12/2019    9,000  -1,000  -10.0  9,400   1/11/2020
footer 1 2 3
"""


def test_text_report(spark, tmp_path):
    lines = sources.numbered_lines(spark, put(tmp_path / "r.txt", REPORT))
    got = claims.weekly_claims(lines, 2, 3)
    shown = [(str(r.date), str(r.day), r.variable, r.value, r.year) for r in got.collect()]
    assert ("2019-01-05", "2020-01-04", "Initial Claims", 10000.0, 2019) in shown
    assert ("2020-01-04", "2020-01-04", "4 Week Average", 11000.0, 2020) in shown
    assert ("2019-01-12", "2020-01-11", "Weekly Change", -1000.0, 2019) in shown
    assert not any(r[0] == "2020-01-11" for r in shown)  # the week has no numbers yet
    assert len(shown) == 9


def test_renames(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["A", "B", "C"])
    assert sources.rename_by_position(df, ["x", "y"]).columns == ["x", "y", "C"]
    assert sources.lower_names(df).columns == ["a", "b", "c"]


def test_sinks_refuse_to_overwrite(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b")], "k INT, v STRING")
    folders = sources.write_report({"one": df, "two": df}, str(tmp_path / "book"), fmt="csv")
    assert rows(sources.read_csv(spark, folders["two"], "k INT, v STRING")) == [(1, "a,b")]
    sources.write_csv(df, str(tmp_path / "out"))
    with pytest.raises(Exception, match="(?i)exist"):
        sources.write_csv(df, str(tmp_path / "out"))


def test_tables_read_only_the_columns_asked_for(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.createDataFrame([(1, "x", "shape")], ["k", "name", "geometry"]).write.parquet(path)
    assert sources.read_table(spark, path, ["k", "name"]).columns == ["k", "name"]
    assert rows(sources.inline_lookup(spark, {"a": 1, "b": 2})) == [("a", 1), ("b", 2)]


def test_assessor_extract_from_file_to_regional_schema(spark, tmp_path):
    sales = put(tmp_path / "s.csv", 'ExciseTaxNbr,Major,Minor,DocumentDate,SalePrice,BuyerName,PropertyType,PrincipalUse,Note\n'
                                    '1,"000001 ","0010",01/05/2020,350000,"PEÑA, A",3,6,x\n2,000002,0010,01/05/2020,0,B,3,6,x\n', "latin-1")
    condos = put(tmp_path / "c.csv", "Major,Minor,UnitType\n000001,0010,1\n")
    complexes = put(tmp_path / "x.csv", "Major,ConstrClass\n000009,1\n")
    got = residential.king_sales(
        sources.read_named(spark, sales, schema.KING_SALES, encoding="ISO-8859-1"),
        sources.read_named(spark, condos, schema.KING_CONDO_UNITS),
        sources.read_named(spark, complexes, schema.KING_CONDO_COMPLEXES),
    )
    assert rows(got) == [("000001-0010", 1, 2020, 350_000.0, 8, 5, "king")]


def test_headerless_extract(spark, tmp_path):
    line = ["e", "1", "0100", "01/05/2020", "350000", "d", "g", "BUYER", "1", "1", "", "", ""]
    path = put(tmp_path / "sale.txt", "|".join(line) + "\n")
    got = sources.read_delimited(spark, path, schema.PIERCE_SALES_COLUMNS, "|", "ISO-8859-1")
    assert rows(got, "parcel_number", "sale_price", "grantee") == [("0100", "350000", "BUYER")]
    assert len(schema.PIERCE_IMPROVEMENT_COLUMNS) == 25


def _put(folder, files):
    folder.mkdir()
    for name, body in files.items():
        (folder / name).write_text(body, encoding="utf-8")
    return str(folder)


def test_numbers_do_not_depend_on_splits(spark, tmp_path):
    bodies = {f"f{k}.txt": "\n".join(f"file {k} line {i}" for i in range(k * 40)) + "\n" for k in range(1, 5)}
    folder = _put(tmp_path / "lines", bodies)
    want = {(f"file {k} line {i}", i) for k in range(1, 5) for i in range(k * 40)}
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("37b", "100b", "1k", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            lines = sources.numbered_lines(spark, folder)
            assert {(x.line, x.pos) for x in lines.collect()} == want
        spark.conf.set("spark.sql.files.maxPartitionBytes", "100b")  # cut in another way than when counted
        with pytest.raises(Exception, match="other splits"):
            lines.filter("pos >= 0").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", keep)


def test_numbering_copies_no_text(spark, tmp_path):
    folder = _put(tmp_path / "big", {"a.txt": "".join(f"{i:>200}\n" for i in range(5000))})
    known = set(session._STAGED.get(spark.sparkContext.applicationId, []))
    assert sources.numbered_lines(spark, folder).count() == 5000
    new = set(session._STAGED[spark.sparkContext.applicationId]) - known
    assert new and sum(f.stat().st_size for x in new for f in pathlib.Path(x).rglob("*.parquet")) < 20_000


def test_headers_that_differ(spark, tmp_path):
    folder = _put(tmp_path / "headed", {
        "one.csv": 'title\n﻿Id,"Full, Name",Amount\n1,"a, ""b""",10\n,,\n2,x,oops\n',
        "two.csv": "title\namount,ID\n30,3\n",
        "three.csv": "title,,\nFULL  NAME,Id,id,\nignored,4,5,6\n",
        "four.csv": "title only\n",
    })
    got = sources.read_headed(spark, folder, {"id": "int", "Full,.Name": "string", "amount": "double"}, skip=1, tag="from",
                              tag_value=F.regexp_extract("file", r"(\w+)\.csv", 1))
    want = {("one", 1, 1, 'a, "b"', 10.0), ("one", 3, 2, "x", None), ("two", 1, 3, None, 30.0), ("three", 1, 4, None, None)}
    assert {tuple(x) for x in got.select("from", "pos", "id", "`Full,.Name`", "amount").collect()} == want
    every = sources.read_headed(spark, folder, skip=1)
    assert sorted(c.lower() for c in every.columns) == sorted(["file", "pos", "id", "full,.name", "amount", "full.name", "x4"])
    assert sources.read_headed(spark, _put(tmp_path / "none", {"a.csv": "x\n"}), {"a": "int"}, skip=3).count() == 0


def test_tabs_take_one_scan_whatever_their_number(spark, tmp_path):
    jobs = []
    for n in (2, 9):
        tabs = {}
        for k in range(n):
            head = "Id,Value" if k % 2 else "Value,Id"
            body = f"{k},v" if k % 2 else f"v,{k}"
            tabs[f"tab {k}"] = _put(tmp_path / f"{n}-{k} with blank", {"a.csv": f"title\n{head}\n{body}\n"})
        spark.sparkContext.setJobGroup(f"tabs-{n}", "")
        got = sources.read_tabs(spark, tabs, 1, "tab").collect()
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"tabs-{n}")))
        assert {(x.tab, x.Id, x.Value) for x in got} == {(f"tab {k}", str(k), "v") for k in range(n)}
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1]


def test_a_broken_report_leaves_the_one_before(spark, tmp_path):
    root = str(tmp_path / "book")
    df = spark.createDataFrame([(1, 'say "a", b')], "k INT, v STRING")
    with pytest.raises(FileNotFoundError):
        sources.read_report(spark, root)
    sources.write_report({"one": df, "two": df}, root, fmt="csv")
    broken = df.select(F.raise_error(F.lit("broken")).cast("int").alias("k"))
    with pytest.raises(Exception, match="broken"):
        sources.write_report({"one": df.limit(0), "two": broken}, root)
    held = sources.read_report(spark, root)
    assert list(held) == ["one", "two"] and all(rows(x) == [(1, 'say "a", b')] for x in held.values())
    sources.write_report({"one": df.limit(0)}, root)
    assert list(sources.read_report(spark, root)) == ["one"] and sources.read_report(spark, root)["one"].count() == 0
    assert list(sources.read_report(spark, root, 1)) == ["one", "two"]
    with pytest.raises(FileNotFoundError):
        sources.read_report(spark, root, 7)
