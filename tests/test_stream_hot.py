"""Streaming tickets of a hot asset: partial sessions, not rows, reach its state partition."""
import uuid

from pyspark.sql import functions as F

from faultline import streaming as K
from faultline.session import scratch_path


def test_hot_asset_sends_partial_sessions(spark):
    # asset 0 has a third of 9,000 rows, one fault a minute with a pause of two hours after every 500th
    n = 9000
    d = spark.range(0, n, 1, 6).withColumn("asset", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40 + 1)) \
        .withColumn("i", F.floor(F.col("id") / 3))
    d = d.withColumn("ts", F.timestamp_seconds(F.col("i") * 60 + F.floor(F.col("i") / 500) * 7200).cast("timestamp_ntz")) \
        .withColumn("label_fault", F.lit(1)).select("id", "asset", "ts", "label_fault")
    path = scratch_path(spark, f"hot-{uuid.uuid4().hex[:8]}")
    d.write.parquet(path)
    stream = K.ticket_stream(K.read_stream(spark, path, d.schema), 3600.0)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    got = {(r["asset"], r["start"]): r["n_rows"] for r in K.run_available_now(stream, spark, "hot").collect()}
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    hot = sorted((s, n) for (a, s), n in got.items() if a == 0)
    assert [n for _, n in hot] == [500] * (n // 1500 - 1)       # the last session is still open
    key = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"
    plans = {}
    for v in ("true", "false"):
        spark.conf.set(key, v)
        q = stream.writeStream.format("memory").queryName(f"hot_{v}").outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination()
        plans[v] = q._jsq.explainInternal(False)
    spark.conf.set(key, "false")
    assert plans["true"].count("MergingSessions") > plans["false"].count("MergingSessions")
