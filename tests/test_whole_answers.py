"""Answers that must not depend on plans, file layouts, ties, NULLs or sizes."""
import math
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from faultline import streaming as K
from faultline.operators import labels as L
from faultline.operators import metrics as J
from faultline.operators import models as M
from faultline.operators import series as D
from faultline.operators import splits as G
from faultline.plans import quantile as Q
from faultline.session import scratch_path

T0 = datetime(2024, 1, 1)


def tied_rows(n=600):
    r = random.Random(3)
    rows = []
    for i in range(n):
        asset = None if r.random() < .1 else 1 if r.random() < .5 else r.randint(2, 6)
        ts = None if r.random() < .05 else T0 + timedelta(seconds=30 * r.randint(0, 60))
        rows.append((i if i % 50 else 7, asset, ts, None if r.random() < .2 else float(r.randint(0, 9))))
    return rows


def brute_rolling(rows, width):
    key = lambda r: (r[2] is None, r[2] or T0, r[0])
    out = []
    for asset in {r[1] for r in rows}:
        mine = sorted((r for r in rows if r[1] == asset), key=key)
        for i, r in enumerate(mine):
            seen = [r] if r[2] is None else [x for x in mine[:i + 1] if x[2] and x[2] > r[2] - timedelta(seconds=width)]
            vals = [x[3] for x in seen if x[3] is not None]
            out.append((r[0], r[1], r[2], sum(vals) / len(vals) if vals else None))
    return out


@pytest.mark.parametrize("partitions", ["8", "200"])
def test_rolling_mean_has_one_meaning(spark, partitions):
    rows = [r for r in tied_rows() if r[0] != 7]
    df = spark.createDataFrame(rows, "row_id long, asset long, ts timestamp_ntz, v double")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = {s: {(r[0], r[1]): r["v"] for r in D.rolling_time_mean(df, ["v"], 300.0, keys=["asset"], fill=False,
                                                                     strategy=s).collect()}
               for s in ("window", "ranged", "auto")}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    want = {(i, a): v for i, a, _, v in brute_rolling(rows, 300)}
    for s in got:
        assert got[s].keys() == want.keys()
        for k, v in want.items():
            assert got[s][k] == (None if v is None else pytest.approx(v)), (s, k)


@pytest.mark.parametrize("strategy", ["window", "ranged"])
def test_rolling_mean_keeps_every_row(spark, strategy):
    rows = tied_rows()
    df = spark.createDataFrame(rows, "row_id long, asset long, ts timestamp_ntz, v double")
    assert D.rolling_time_mean(df, ["v"], 300.0, keys=["asset"], strategy=strategy).count() == len(rows)


def test_quantiles_of_awkward_columns(spark, monkeypatch):
    r = random.Random(1)
    wide = [math.inf, -math.inf] + [10.0 ** r.uniform(-300, 300) * r.choice([1, -1]) for _ in range(4000)] + [5.0] * 3000
    df = spark.createDataFrame([(x,) for x in wide] + [(None,)], "x double").repartition(4)
    rounds, real = [], Q._narrow_once
    monkeypatch.setattr(Q, "_narrow_once", lambda *a: rounds.append(1) or real(*a))
    s = np.sort(np.array(wide))
    got = Q.order_statistics(df, "x", [0, 1, 3000, 3600, 5000, len(s) - 1], small=20, accuracy=200)
    assert got == {k: s[k] for k in got} and len(rounds) <= 6


def test_duplicate_split_keys(spark):
    df = spark.createDataFrame([(i // 2, i % 4 // 2) for i in range(1000)], "row_id long, y int")
    assert G.sample_n(df, 100).count() == 100
    with pytest.raises(ValueError, match="row_id"):
        G.sample_n(df, 101)
    with pytest.raises(ValueError, match="row_id"):
        G.balanced_subsample(df, "y", cap=202)


@pytest.mark.parametrize("files", [1, 4, 8])
def test_tickets_with_many_files_per_chunk(spark, files):
    from faultline.plans.catalog import QUERIES, load_all
    from faultline.sources import tele_ev
    load_all()
    t = tele_ev(spark, "/root/testdata/sf0.01").select("row_id", "ts", "asset", "vibration")
    path = scratch_path(spark, f"t-stream-{files}-{random.random()}")
    K.write_stream_source(t.repartition(files), path)
    lab = K.label_stream(K.read_stream(spark, path, t.schema), ["vibration"], L.quantile_thresholds(t, ["vibration"], 0.95))
    assert K.run_available_now(K.ticket_stream(lab, 3600.0), spark, "t").count() == 494


def test_stream_keeps_rows_without_a_time(spark):
    rows = [(i, None if i % 10 == 0 else T0 + timedelta(seconds=i), 1, float(i)) for i in range(500)]
    df = spark.createDataFrame(rows, "row_id long, ts timestamp_ntz, asset long, v double")
    for part in (df, df.withColumn("ts", F.lit(None).cast("timestamp_ntz"))):
        path = scratch_path(spark, f"t-null-{random.random()}")
        K.write_stream_source(part, path)
        out = K.run_available_now(K.label_stream(K.read_stream(spark, path, df.schema), ["v"], {"v": 400.0}), spark, "t")
        assert out.count() == 500 and out.where("label_fault = 1").count() == 99
    t = spark.createDataFrame([(1, T0 + timedelta(milliseconds=700 * k), 1) for k in (0, 1, 3, 9)],
                              "row_id long, ts timestamp_ntz, asset long").withColumn("label_fault", F.lit(1))
    path = scratch_path(spark, f"t-gap-{random.random()}")
    K.write_stream_source(t, path, chunks=1)
    got = K.run_available_now(K.ticket_stream(K.read_stream(spark, path, t.schema), 0.8), spark, "t").collect()
    assert sorted(r["n_rows"] for r in got) == [1, 2]        # the last ticket stays open


def test_auc_of_billions(spark, monkeypatch):
    n = 3_500_000_000
    p = spark.createDataFrame([(0.9, 2 * n, n // 2, 2 * n, n // 2, 3 * n, 2 * n), (0.1, n, 2 * n - n // 2, 3 * n, 2 * n, 3 * n, 2 * n)],
                              "threshold double, pos long, neg long, cum_pos long, cum_neg long, tot_pos long, tot_neg long")
    monkeypatch.setattr(J, "score_points", lambda *a, **k: p)
    r = J.auc_ap(None).first()
    assert r["auc_roc"] == pytest.approx((0.25 * 1 + 0.75 * 2.5) / 3) and 0 < r["avg_precision"] < 1


def test_weights_come_from_the_fitted_rows(spark, monkeypatch):
    rows = [(i, float(i % 7), int(i % 10 == 0 if i < 100 else i % 2)) for i in range(200)]
    df = spark.createDataFrame(rows, "row_id long, x double, label_fault int")
    seen, real = [], M.class_weights
    monkeypatch.setattr(M, "class_weights", lambda d, y, out="weight", counts=None: seen.append(
        {r[0]: r[1] for r in real(d, y, "w", counts).groupBy(y).agg(F.first("w")).collect()}) or real(d, y, out, counts))
    M.fit(df.where("row_id < 100"), ["x"], kind="lr", max_iter=2)
    assert seen == [{1: 5.0, 0: pytest.approx(100 / 180)}]


def test_permuted_copies_keep_all_values(spark):
    rows = [(i, float(i), None if i == 3 else float(i * 10), i % 2) for i in range(50)]
    df = spark.createDataFrame(rows, "row_id long, a double, b double, y int")
    c = M._permuted_copies(df, ["a", "b"], 2, 42, "row_id", "y").collect()
    for k in range(4):
        mine = [r for r in c if r["copy"] == k]
        name, other = ("a", "b") if k < 2 else ("b", "a")
        low = lambda v: (v is None, v or 0)
        assert sorted((r[name] for r in mine), key=low) == sorted((r[1 if name == "a" else 2] for r in rows), key=low)
        assert all(r[other] == rows[r["row_id"]][1 if other == "a" else 2] for r in mine)
        assert sum(r[name] == rows[r["row_id"]][1 if name == "a" else 2] for r in mine) == 0
