"""Every catalogue query next to its SQL, and the shape of its plan."""

import ast
import pathlib
import re
import sys

import duckdb
import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry
from regiolume.catalog import ENTRIES
from tools.check import verdict_of

FOLDER = "/root/testdata/sf0.001"
QUERIES = {name: e.run for name, e in ENTRIES.items()}
SQL = entry.oracle_sql()

# The fill of a file without series puts one row per block of the file into one task.
BLOCK_ROWS_IN_ONE_TASK = {"job_sales_tax", "job_sales_tax_region", "job_sales_tax_city"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in pathlib.Path(FOLDER).glob("*.parquet"):
        c.execute(f"create view {f.stem} as select * from '{f}'")
    return c


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    """Same rows as the SQL; no cross join, no nested loop, no window over a whole table, no Python."""
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert bad not in plan
    if name not in BLOCK_ROWS_IN_ONE_TASK:
        assert not re.search(r"Sort [^\n]*\n[^\n]*Exchange SinglePartition", plan)
    verdict = verdict_of(df, con, SQL[name])
    assert verdict.startswith("ok"), verdict


def test_entry(spark):
    assert entry.entry(spark).count() > 0


#: Guards and openers that end in an error or a file system, covered by tests alone.
NOT_IN_QUERIES = {"assert_fan_out", "assert_unique", "clear_scratch", "local_session"}


def test_every_public_function_is_reached():
    """From the catalogue's modules every public function of the library can be reached by name."""
    top = pathlib.Path(entry.__file__).parent / "regiolume"
    uses, public, seeds = {}, {}, set()

    def names_in(node):
        return {x.id for x in ast.walk(node) if isinstance(x, ast.Name)} | {x.attr for x in ast.walk(node) if isinstance(x, ast.Attribute)}

    for package in ("functions", "sources", "operators", "plans", "catalog"):
        for path in (top / package).glob("*.py"):
            tree = ast.parse(path.read_text())
            if package == "catalog":
                seeds |= names_in(tree)
                continue
            for node in tree.body:
                if isinstance(node, (ast.FunctionDef, ast.ClassDef)):
                    uses.setdefault(node.name, set()).update(names_in(node))
                    if not node.name.startswith("_"):
                        public[node.name] = path.name
                elif isinstance(node, ast.Assign):
                    for target in node.targets:
                        uses.setdefault(getattr(target, "id", ""), set()).update(names_in(node))
    reached, todo = set(), list(seeds)
    while todo:
        name = todo.pop()
        if name not in reached:
            reached.add(name)
            todo += uses.get(name, ())
    assert {name: file for name, file in public.items() if name not in reached and name not in NOT_IN_QUERIES} == {}
