"""The processed table reads its time order once, also across segment borders."""
import pytest
from pyspark.sql import functions as F

from faultline.plans import order as O


@pytest.mark.parametrize("strategy", ["ranged", "window"])
def test_fill_gives_the_previous_raw_value(spark, strategy):
    rows = [(i, i // 3, None if i % 4 == 1 else float(i * i % 17)) for i in range(120)]
    df = spark.createDataFrame(rows, "row_id int, t int, v double").withColumn("raw", F.col("v")).repartition(4)
    got = O.fill_forward_backward(df, [], ["t", "row_id"], ["v"], strategy, prev=["raw"]).orderBy("row_id").collect()
    assert [r["prev_raw"] for r in got] == [None] + [v for _, _, v in rows[:-1]]
    assert all(r["v"] is not None for r in got) and "_carry" not in got[0]


def test_processed_table_scans_once(spark, monkeypatch):
    from faultline.operators import preprocess as P
    calls, real = [], O.pin
    monkeypatch.setattr(O, "pin", lambda d: calls.append(1) or real(d))
    cols = ["speed", "humidity", "vibration", "revolutions", "energy", "temperature", "signal_strength", "motor_cycles"]
    df = spark.createDataFrame([(f"r{i:03d}", i, *[None if i % 9 == k else float(i * (k + 1) % 13) for k in range(8)])
                                for i in range(90)], "row_id string, s int, " + ", ".join(f"{c} double" for c in cols))
    out = P.processed_table(df.select("row_id", F.timestamp_seconds("s").alias("ts"), *cols), keep=["row_id"])
    got = out.orderBy("row_id").collect()
    speed = [None if i % 9 == 0 else float(i % 13) for i in range(90)]
    step = [0.0 if i == 0 or None in (speed[i], speed[i - 1]) else speed[i] - speed[i - 1] for i in range(90)]
    assert [r["acceleration"] for r in got] == pytest.approx(step) and len(calls) == 1
