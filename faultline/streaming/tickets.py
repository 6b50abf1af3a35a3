"""Structured Streaming forms of labelling (K1) and gap-merge tickets (K2).

* K1: a file stream labelled with thresholds frozen from batch data (the
  thresholds are literals in the plan, so the stream is stateless).
* K2: fault rows -> ``groupBy(asset, session_window(ts, gap))`` with a
  watermark, append mode: a ticket is emitted once the watermark passes
  its end, i.e. when it can no longer grow.  The asset key is mandatory
  (a streaming session window needs a grouping key besides the window).
  ``session_window`` ends at last event + gap, so the ticket's end is
  reported as ``max(ts)``; equal gaps merge, as in the batch E6.

Both run with ``trigger(availableNow=True)``: all data present at start is
processed in micro-batches, then the query stops -- the batch-equivalent
way to run a stream, restartable from its checkpoint after a failure.
"""
from __future__ import annotations

import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import cmp, flag
from ..session import scratch_path

_starting = threading.Lock()


def write_stream_source(df: DataFrame, path: str, ts: str = "ts", chunks: int = 4) -> None:
    """Write ``df`` as ``chunks`` time-ordered batches of files, one write
    after the other, so a file stream sees them in time order.  Rows without
    a time go with the first batch."""
    edges = df.select(F.percentile_approx(F.col(ts).cast("timestamp"),
                                          [i / chunks for i in range(1, chunks)], 10000).alias("e")).first()["e"]
    if edges is None:           # no row has a time
        chunks = 1
    lo = None
    for i in range(chunks):
        hi = edges[i] if i < chunks - 1 else None
        t = F.col(ts).cast("timestamp")
        part = df if lo is None else df.where(t > F.lit(lo))
        if hi is not None:
            part = part.where((t <= F.lit(hi)) | t.isNull()) if lo is None else part.where(t <= F.lit(hi))
        part.write.mode("append").parquet(path)
        lo = hi


def read_stream(spark: SparkSession, path: str, schema, max_files_per_trigger: int | None = None) -> DataFrame:
    """File stream.  Without ``max_files_per_trigger`` a trigger takes all
    files that are there, so files that cover the same time never end up on
    two sides of a watermark; with it, the tickets' ``watermark`` must be at
    least the time that files of different triggers overlap."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def label_stream(stream: DataFrame, cols, thresholds: dict, k: int = 1, op: str = ">",
                 label: str = "label_fault") -> DataFrame:
    """K1: the k-of-n rule with frozen thresholds."""
    terms = [flag(cmp(c, op, F.lit(thresholds[c]))) for c in cols]
    return stream.withColumn(label, (sum(terms[1:], terms[0]) >= k).cast("int"))


def ticket_stream(labelled: DataFrame, gap_sec: float, ts: str = "ts", key: str = "asset",
                  label: str = "label_fault", watermark: str = "0 seconds") -> DataFrame:
    """K2: streaming gap-merge tickets per key (append mode).  ``watermark``
    is the lateness allowed between triggers: rows older than the latest
    time of earlier triggers less this are dropped by the stream."""
    t = F.col(ts).cast("timestamp")
    s = (labelled.withColumn("_t", t).withWatermark("_t", watermark)
                 .where(F.col(label) == 1)
                 .groupBy(key, F.session_window("_t", f"{round(gap_sec * 1_000_000)} microseconds").alias("sw"))
                 .agg(F.min("_t").alias("start"), F.max("_t").alias("end"), F.count(F.lit(1)).alias("n_rows")))
    return s.select(key, F.col("start").cast("timestamp_ntz").alias("start"),
                    F.col("end").cast("timestamp_ntz").alias("end"), "n_rows")


def run_available_now(stream: DataFrame, spark: SparkSession, name: str, mode: str = "append",
                      state_partitions: int | None = None) -> DataFrame:
    """Run to completion into a fresh Parquet sink under the shared
    checkpoint folder and return the sink as a batch DataFrame.

    A streaming query fixes its number of state partitions when it first
    starts (from ``spark.sql.shuffle.partitions``); it is set for this query
    to ``state_partitions`` (default: the cluster's parallelism).  Sessions
    are merged where their rows are read, before the exchange: of a hot asset
    each reading task sends its partial sessions, not its rows, and the
    asset's one state partition merges these and keeps only what is still
    open.  The session's own values are restored afterwards."""
    run = uuid.uuid4().hex[:12]
    out = scratch_path(spark, f"faultline-stream-{name}-{run}")
    mine = {"spark.sql.shuffle.partitions": str(state_partitions or spark.sparkContext.defaultParallelism),
            "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true"}
    with _starting:             # the settings belong to one start at a time
        old = {k: spark.conf.get(k) for k in mine}
        for k, v in mine.items():
            spark.conf.set(k, v)
        try:
            q = (stream.writeStream.format("parquet").outputMode(mode)
                       .option("checkpointLocation", out + "-ckpt").option("path", out)
                       .trigger(availableNow=True).start())
        finally:
            for k, v in old.items():
                spark.conf.set(k, v)
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)
