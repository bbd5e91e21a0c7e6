"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
import weakref
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the plans rely on; sizes of shuffles are left to adaptive execution.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Building long plans is faster when the call site of every column is not recorded.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(app: str, cores: int | str = 8, **extra: str) -> SparkSession:
    """Session for tests and the benchmark; on a cluster the submit command makes the session."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = SETTINGS | {
        "spark.sql.shuffle.partitions": str(cores),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
    }
    for key, value in (settings | extra).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_LOCAL_ROOTS: dict[str, str] = {}
_STAGED: dict[str, list[str]] = {}
_TRIED: dict[tuple[str, str], set[str]] = {}
_FOLDERS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def _shared_root(spark: SparkSession) -> str | None:
    """The folder the cluster names in ``spark.checkpoint.dir``; without one the folder the program has set for checkpoints,
    and then the warehouse, which the executors write their tables to."""
    root, warehouse = (spark.conf.get(f"spark.{x}.dir", None) for x in ("checkpoint", "sql.warehouse"))
    if root or not warehouse:
        return root
    return spark.sparkContext.getCheckpointDir() or f"{warehouse.rstrip('/')}/scratch"


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _try_out(spark: SparkSession, root: str) -> None:
    """An error, unless the driver and the executors find each other's files in a folder: a table of a row from each of many
    tasks has to come back whole. It is tried once, and again when machines have joined."""
    context = spark.sparkContext
    hosts = {x.host() for x in context._jsc.sc().statusTracker().getExecutorInfos()}
    if hosts <= _TRIED.get((context.applicationId, root), set()):
        return
    folder, n = f"{root.rstrip('/')}/shared-{uuid.uuid4().hex}", 4 * max(context.defaultParallelism, len(hosts))
    try:
        spark.range(0, n, 1, n).write.parquet(folder)
        missing = n - spark.read.schema("id long").parquet(folder).count()
    finally:
        _delete(spark, folder)
    if missing:
        raise FileNotFoundError(f"{missing} of {n} tasks wrote to another folder {root} than the driver's")
    _TRIED[context.applicationId, root] = hosts


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under the one that driver and executors share.

    Only a session whose tasks run in this one process may fall back to the machine's own temporary folder. On a cluster of
    several machines, a folder without a scheme or of ``file:`` can be a mount that all have or each machine's own disk: it is
    tried out.
    """
    master = spark.sparkContext.master
    if re.fullmatch(r"local(\[.*\])?", master):
        root = spark.conf.get("spark.checkpoint.dir", None)
    else:
        root = _shared_root(spark)
        try:
            if not root:
                raise FileNotFoundError("no folder is named")
            if not master.startswith("local-cluster[") and not re.match(r"(?!file:)[A-Za-z][A-Za-z0-9+.-]*:/", root):
                _try_out(spark, root)
        except Exception as e:
            raise RuntimeError("set spark.checkpoint.dir to a folder, with its scheme, that all executors can reach") from e
    if not root:
        app = spark.sparkContext.applicationId
        if app not in _LOCAL_ROOTS:
            _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="regiolume-")
        root = _LOCAL_ROOTS[app]
    folder = f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    _STAGED.setdefault(spark.sparkContext.applicationId, []).append(folder)
    return folder


def clear_scratch(spark: SparkSession) -> None:
    """Delete the tables that this application has staged, when none of its results is read any more."""
    for folder in _STAGED.pop(spark.sparkContext.applicationId, []):
        _delete(spark, folder)


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """A table written to the shared folder and read back: it runs once, survives the loss of
    executors, and Spark knows its size when it plans what comes after."""
    folder = scratch_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    out = df.sparkSession.read.schema(df.schema).parquet(folder)
    _FOLDERS[out] = folder
    return out


def discard(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more: what was made of them must be staged itself by then."""
    for df in tables:
        folder = _FOLDERS.pop(df, None)
        if folder is not None:
            _delete(df.sparkSession, folder)
            _STAGED[df.sparkSession.sparkContext.applicationId].remove(folder)


@contextmanager
def arrow_rows(spark: SparkSession, most: int) -> Iterator[None]:
    """Within it, at most so many rows go to a Python worker at once: for rows that are large themselves."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, most)
    try:
        yield
    finally:
        spark.conf.set(name, before)
