"""Sources and sinks."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType, TimestampNTZType)

from ..operators.schema import name_positional

# Fixed values of the reference pipeline: raw and processed column layouts.
RAW_SCHEMA = StructType([StructField("ID", LongType())] + [
    StructField(c, DoubleType()) for c in ["revolutions", "humidity", "vibration", "x1", "x2", "x3", "x4", "x5"]])

PROCESSED_COLUMNS = ["timestamp", "temperature", "speed", "acceleration", "humidity", "vibration",
                     "revolutions", "signal_strength", "energy", "motor_cycles",
                     "Fault_900", "Fault_925", "Fault_950", "Fault_975", "Fault_Combo2of3_TUNED"]
PROCESSED_SCHEMA = StructType(
    [StructField("timestamp", TimestampNTZType())]
    + [StructField(c, DoubleType()) for c in PROCESSED_COLUMNS[1:10]]
    + [StructField(c, IntegerType()) for c in PROCESSED_COLUMNS[10:]])

METRICS_SCHEMA = StructType([StructField("model", StringType()), StructField("tag", StringType())] + [
    StructField(c, DoubleType()) for c in ["accuracy", "precision_macro", "recall_macro", "f1_macro",
                                           "recall_fault", "auc_roc", "avg_precision"]])


def read_telemetry(spark: SparkSession, path: str, schema: StructType | None = None,
                   fmt: str = "csv") -> DataFrame:
    """A1: header CSV (or Parquet) with an explicit schema -- no inference pass."""
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        r = r.option("header", True).option("mode", "PERMISSIVE")
    return r.load(path)


def read_raw_positional(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """A2: exactly 9 columns, named by position."""
    r = spark.read.format(fmt)
    if fmt == "csv":
        r = r.option("header", True).option("inferSchema", False)
    df = r.load(path)
    df = name_positional(df)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW_SCHEMA.fields])


def write_table(df: DataFrame, path: str, cols=None, fmt: str = "parquet", mode: str = "overwrite",
                partition_by=None) -> None:
    """Write in a fixed column order."""
    out = df.select(*cols) if cols else df
    w = out.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def shuffled(df: DataFrame, row_id: str = "row_id", seed: int = 42) -> DataFrame:
    """A4: a reproducible random permutation of all rows (a distributed
    sort on a hash key; the multiset is unchanged)."""
    return df.orderBy(F.xxhash64(F.col(row_id), F.lit(seed)), F.col(row_id))


def write_shuffled(df: DataFrame, path: str, row_id: str = "row_id", seed: int = 42, fmt="parquet") -> None:
    write_table(shuffled(df, row_id, seed), path, fmt=fmt)


def metadata_frame(spark: SparkSession, thresholds: dict, features, split: str, time_col,
                   event_gap_minutes, leakage_guard: bool) -> DataFrame:
    """A5: one-row run metadata (map of thresholds, feature list, ...)."""
    schema = ("thresholds map<string,double>, features_used array<string>, split string, "
              "time_col string, event_gap_minutes double, leakage_guard boolean")
    return spark.createDataFrame([({k: float(v) for k, v in thresholds.items()}, list(features), split,
                                   time_col, None if event_gap_minutes is None else float(event_gap_minutes),
                                   bool(leakage_guard))], schema)


def write_metadata(meta: DataFrame, path: str) -> None:
    meta.coalesce(1).write.mode("overwrite").json(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def read_metrics(spark: SparkSession, path: str, fmt: str = "csv"):
    """A metrics table, or None when missing."""
    if not path_exists(spark, path):
        return None
    return read_telemetry(spark, path, METRICS_SCHEMA, fmt)


def read_metrics_tagged(spark: SparkSession, paths: dict, fmt: str = "csv"):
    """Union of the metrics tables that exist, tagged by name."""
    parts = []
    for tag, p in paths.items():
        m = read_metrics(spark, p, fmt)
        if m is not None:
            parts.append(m.withColumn("tag", F.lit(tag)))
    if not parts:
        return spark.createDataFrame([], METRICS_SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
