"""Published result tables (A7): a run's tables become visible all at once.

Every table of a run is written under a folder of that run which no other
run touches; the manifest, written last, names the run's tables with their
rows and columns.  Readers go by the newest manifest alone, so a run that
failed half way, or is still writing, is never seen.
"""
from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .io import path_exists, write_table

_MANIFEST = "run string, published_us bigint, tables array<struct<name: string, path: string, n: bigint, columns: array<string>>>"


def publish(spark: SparkSession, root: str, tables: dict[str, DataFrame]) -> str:
    """Write ``tables`` as one run below ``root`` and make it the current one; returns the run's name."""
    root, run = root.rstrip("/"), uuid.uuid4().hex
    said = []
    for name, df in tables.items():
        path = f"{root}/runs/{run}/{name}"
        write_table(df, path, mode="errorifexists")
        said.append((name, path, spark.read.parquet(path).count(), df.columns))
    row = [(run, time.time_ns() // 1000, said)]
    spark.createDataFrame(row, _MANIFEST).coalesce(1).write.mode("append").json(f"{root}/manifests")
    return run


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """The current run's tables: run, name, path, n, columns; empty before the first publication."""
    path = f"{root.rstrip('/')}/manifests"
    if not path_exists(spark, path):
        return spark.createDataFrame([], "run string, name string, path string, n bigint, columns array<string>")
    # one small row per run; equal times go by name
    got = spark.read.schema(_MANIFEST).json(path)
    last = got.agg(F.max(F.struct("published_us", "run", "tables")).alias("m"))
    return last.select("m.run", F.inline("m.tables"))


def published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the current run, checked against its manifest."""
    r = manifest(spark, root).where(F.col("name") == name).first()
    if r is None:
        raise ValueError(f"no published table {name!r} below {root}")
    df = spark.read.parquet(r["path"])
    if df.columns != r["columns"]:
        raise ValueError(f"table {name!r} of run {r['run']} has other columns than its manifest")
    return df
