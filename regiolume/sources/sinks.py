"""Sinks. All write a folder per table and leave the number of files to the plan's partitions; a report of several tables
appears as a whole."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from regiolume.sources.delimited import QUOTED


def write_csv(df: DataFrame, path: str, **options: str) -> None:
    df.write.mode("errorifexists").option("header", True).options(**QUOTED | options).csv(path)


def _file_system(spark: SparkSession, root: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _manifests(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the reports that are complete, ascending."""
    jvm_path, files = spark.sparkContext._jvm.org.apache.hadoop.fs.Path, _file_system(spark, root)
    if not files.exists(jvm_path(root)):
        return []
    names = [x.getPath().getName() for x in files.listStatus(jvm_path(root))]
    return sorted(int(m[1]) for name in names if (m := re.fullmatch(r"manifest-(\d+)\.json", name)))


def write_report(tables: Mapping[str, DataFrame], root: str, fmt: str = "parquet") -> dict[str, str]:
    """Write several named tables under one root as one report that appears whole; returns the folders.

    Tables are written aside, into a folder of this run. Only when all are there a manifest that names them takes the next number,
    by one rename. Readers follow the highest number, so a run that breaks leaves the report before it as it was, and a
    later run does not touch what others are reading.
    """
    if not tables:
        raise ValueError("a report needs a table")
    spark, root = next(iter(tables.values())).sparkSession, root.rstrip("/")
    version = f"version-{uuid.uuid4().hex}"
    for name, df in tables.items():
        df.write.mode("errorifexists").option("header", True).options(**QUOTED).format(fmt).save(f"{root}/{version}/{name}")
    held = {name: {"folder": f"{version}/{name}", "schema": df.schema.jsonValue()} for name, df in tables.items()}
    jvm_path, files = spark.sparkContext._jvm.org.apache.hadoop.fs.Path, _file_system(spark, root)
    aside = jvm_path(f"{root}/{version}/manifest.json")
    out = files.create(aside, False)
    out.write(bytearray(json.dumps({"format": fmt, "tables": held}).encode()))
    out.close()
    number = max(_manifests(spark, root), default=0) + 1
    while files.exists(jvm_path(f"{root}/manifest-{number}.json")) or not files.rename(aside, jvm_path(f"{root}/manifest-{number}.json")):
        if not files.exists(aside):
            raise RuntimeError(f"the manifest of {version} is gone")
        number += 1
    return {name: f"{root}/{x['folder']}" for name, x in held.items()}


def read_report(spark: SparkSession, root: str, number: int | None = None) -> dict[str, DataFrame]:
    """The tables of the newest complete report under a root, or of an earlier one by its number (from 1)."""
    root, numbers = root.rstrip("/"), _manifests(spark, root)
    if not numbers or number is not None and number not in numbers:
        raise FileNotFoundError(f"no report {'' if number is None else f'number {number} '}under {root}")
    path = f"{root}/manifest-{numbers[-1] if number is None else number}.json"
    manifest = json.loads(spark.read.text(path, wholetext=True).first()[0])
    reader = spark.read.format(manifest["format"]).option("header", True).options(**QUOTED)
    return {
        name: reader.schema(StructType.fromJson(x["schema"])).load(f"{root}/{x['folder']}")
        for name, x in manifest["tables"].items()
    }
