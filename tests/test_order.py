"""Segmented (ranged) scans equal the plain window on data with a hot key."""
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from faultline.plans import order as O


def _frame(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    t0 = datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        asset = 0 if rnd.random() < 0.34 else rnd.randint(1, 20)       # one hot asset
        ts = None if rnd.random() < 0.01 else t0 + timedelta(seconds=rnd.randint(0, 20000))
        v = None if rnd.random() < 0.2 else rnd.random()
        rows.append((i, asset, ts, 1 if rnd.random() < 0.3 else 0, v))
    return spark.createDataFrame(rows, "row_id long, asset long, ts timestamp_ntz, y int, v double")


def _rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


@pytest.mark.parametrize("keys", [[], ["asset"]])
def test_islands_ranged_equals_window(spark, keys):
    df = _frame(spark)
    a = O.islands(df, keys, "ts", "row_id", "y", 120e6, strategy="ranged", )
    b = O.islands(df, keys, "ts", "row_id", "y", 120e6, strategy="window")
    assert _rows(a, ["row_id", "_event_no", "_is_start"]) == _rows(b, ["row_id", "_event_no", "_is_start"])


@pytest.mark.parametrize("keys", [[], ["asset"]])
def test_carry_fill_position_equal(spark, keys):
    df = _frame(spark)
    order = ["ts", "row_id"]
    for fn, cols in ((lambda s: O.carry_prev(df, keys, order, ["v"], s), ["row_id", "prev_v"]),
                     (lambda s: O.fill_forward_backward(df, keys, order, ["v"], s), ["row_id", "v"]),
                     (lambda s: O.position(df, keys, order, s), ["row_id", "_pos", "_n"]),
                     (lambda s: O.running_sums(df.fillna(0.0, ["v"]), keys, order, ["y"], s), ["row_id", "cum_y", "tot_y"])):
        assert _rows(fn("ranged"), cols) == _rows(fn("window"), cols)


def test_segments_split_hot_key(spark):
    df = _frame(spark)
    seg = O.segment(df, ["asset"], ["ts", "row_id"])
    per = seg.where(F.col("asset") == 0).select(O.SEG).distinct().count()
    assert per > 1          # the hot asset is spread over several tasks


def test_auto_strategy_detects_hot_key(spark):
    df = _frame(spark)
    assert O.choose_strategy(df, ["asset"]) == "ranged"          # asset 0 holds a third of the rows
    assert O.choose_strategy(df, []) == "ranged"                 # a global order is never one task
    even = df.withColumn("asset", F.col("row_id") % 500)
    assert O.choose_strategy(even, ["asset"]) == "window"


@pytest.mark.parametrize("keys", [[], ["asset"]])
def test_rolling_means_ranged_equal_window(spark, keys):
    from faultline.operators import series as D
    df = _frame(spark).where(F.col("ts").isNotNull())
    # unique time stamps so the range-window and prefix forms agree on ties
    df = df.withColumn("ts", F.timestamp_add("MICROSECOND", F.col("row_id"), F.col("ts")))
    for fn, kw in ((D.rolling_row_mean, {"n": 5}), (D.rolling_time_mean, {"window_s": 300.0, "fill": False})):
        a = fn(df, ["v"], keys=keys, strategy="ranged", **kw)
        b = fn(df, ["v"], keys=keys, strategy="window", **kw)
        ra = {r["row_id"]: r["v"] for r in a.select("row_id", "v").collect()}
        rb = {r["row_id"]: r["v"] for r in b.select("row_id", "v").collect()}
        assert ra.keys() == rb.keys()
        for k in ra:
            assert (ra[k] is None and rb[k] is None) or abs(ra[k] - rb[k]) < 1e-9, (fn.__name__, k, ra[k], rb[k])
