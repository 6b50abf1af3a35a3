"""Labelling and time-profile operators on literal frames."""
from datetime import datetime

from faultline.operators import labels as L
from faultline.operators import series as D


def test_class_balance_zero_fill_and_ladder_counts(spark):
    df = spark.createDataFrame([(0, 1), (0, 0), (0, 1)], "y int, Fault_900 int")
    cb = {(r["label"], r["value"]): (r["count"], r["share"]) for r in L.class_balance(df, ["y", "Fault_900"]).collect()}
    assert cb[("y", 1)] == (0, 0.0) and cb[("y", 0)] == (3, 1.0)
    assert cb[("Fault_900", 1)][0] == 2
    lc = L.ladder_counts(df).collect()                      # only the ladder columns present
    assert [(r["label"], r["count"]) for r in lc] == [("Fault_900", 2)]
    assert abs(lc[0]["pct"] - 200 / 3) < 1e-9


def test_k_of_n_ge_and_gt(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, 0.0), (None, 5.0)], "a double, b double")
    thr = {"a": 2.0, "b": 2.0}
    gt = [r["label_fault"] for r in L.k_of_n(df, ["a", "b"], k=1, op=">", thresholds=thr).collect()]
    ge = [r["label_fault"] for r in L.k_of_n(df, ["a", "b"], k=2, op=">=", thresholds=thr).collect()]
    assert gt == [0, 0, 1, 1] and ge == [0, 1, 0, 0]          # NULL never passes


def test_hour_zero_fill_and_regimes(spark):
    rows = [(datetime(2024, 1, 1, 8), 1),        # Monday rush
            (datetime(2024, 1, 1, 12), 0),       # Monday midday
            (datetime(2024, 1, 1, 23), 1),       # Monday quiet
            (datetime(2024, 1, 6, 8), 1)]        # Saturday
    df = spark.createDataFrame(rows, "ts timestamp_ntz, y int")
    h = {r["hour"]: r["faults"] for r in D.faults_by_hour(df, "y").collect()}
    assert len(h) == 24 and h[8] == 2 and h[23] == 1 and h[0] == 0
    reg = {r["regime"]: (r["n_rows"], r["fault_rate"]) for r in D.traffic_regime(df, "y").collect()}
    assert reg == {"rush": (1, 1.0), "midday": (1, 0.0), "quiet": (1, 1.0), "weekend": (1, 1.0)}
    daily = D.faults_daily(df, "y").orderBy("day").collect()
    assert len(daily) == 6 and [r["faults"] for r in daily] == [2, 0, 0, 0, 0, 1]


def test_rate_of_rows_of_one_time(spark):
    rows = [(1, 0, 5.0), (2, 1, 6.0), (3, 1, 8.0), (4, 1, 3.0), (5, 1, 3.0), (6, 3, 4.0), (7, None, 9.0)]
    df = spark.createDataFrame(rows, "row_id int, s int, v double").selectExpr(
        "row_id", "timestamp_seconds(s) AS ts", "v")
    got = [r["rate"] for r in D.first_difference(df, "v", "rate", per_second=True).orderBy("row_id").collect()]
    inf = float("inf")
    assert got[:4] == [0.0, 1.0, inf, -inf] and got[4] != got[4] and got[5:] == [0.5, 0.0]
