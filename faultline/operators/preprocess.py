"""The raw-to-processed pipeline as one composition (A2 -> B3 -> D1 -> B9 ->
C2 -> C6 applied -> A3): semantic columns in, the processed layout out."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.order import RN, SEG, fill_forward_backward
from ..session import scratch_path
from ..sources.io import PROCESSED_COLUMNS, PROCESSED_SCHEMA
from . import labels as L


def processed_table(df: DataFrame, ts: str = "ts", row_id: str = "row_id", target: float = L.TUNE_TARGET,
                    keep=(), strategy: str = "auto") -> DataFrame:
    """``df``: semantic sensor columns, a time and a row id.  Acceleration is
    the difference of speed in time order (0 where either side is missing),
    gaps are filled forward then backward, the vibration ladder and the
    2-of-3 rule tuned to ``target`` are added, and columns come in the
    processed order (after those of ``keep``)."""
    sensors = [c for c in PROCESSED_COLUMNS[1:10] if c != "acceleration"]
    d = df.select(*keep, row_id, ts, *[F.col(c).cast("double").alias(c) for c in sensors]) \
        if row_id not in keep else df.select(*keep, ts, *[F.col(c).cast("double").alias(c) for c in sensors])
    # one scan in time order gives the difference of the readings as they came and the filled ones; stored by
    # columns, since the thresholds below read one column each, some ten times
    d = fill_forward_backward(d.withColumn("_raw", F.col("speed")), [], [ts, row_id], sensors, strategy, prev=["_raw"])
    d = d.withColumn("acceleration", F.coalesce(F.col("_raw") - F.col("prev__raw"), F.lit(0.0)))
    path = scratch_path(d.sparkSession, f"faultline-filled-{uuid.uuid4().hex[:12]}")
    d = d.drop(SEG, RN, "_raw", "prev__raw")
    d.write.parquet(path)
    d = d.sparkSession.read.schema(d.schema).parquet(path)
    d = L.threshold_ladder(d, "vibration")
    d = L.apply_autotune(d, L.autotune(d, target=target).first())
    names = [F.col(ts).alias("timestamp") if c == "timestamp" else F.col(c).cast(PROCESSED_SCHEMA[c].dataType).alias(c)
             for c in PROCESSED_COLUMNS]
    return d.select(*keep, *names)
