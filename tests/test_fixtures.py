"""Literal frames of FIXTURES.md section 3."""
import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from faultline.functions import nan_to_null
from faultline.operators import clean as C
from faultline.operators import compare as FC
from faultline.operators import events as E
from faultline.operators import linalg as H
from faultline.operators import metrics as J
from faultline.operators import schema as S
from faultline.operators import series as D
from faultline.plans.quantile import quantiles

T0 = datetime(2024, 1, 1)


def _ts_frame(spark, secs, ys, vs=None):
    rows = [(i, T0 + timedelta(seconds=s), y, None if vs is None else vs[i]) for i, (s, y) in enumerate(zip(secs, ys))]
    return spark.createDataFrame(rows, "row_id long, ts timestamp_ntz, label_fault int, v double")


@pytest.mark.parametrize("strategy", ["ranged", "window"])
def test_gaps(spark, strategy):
    df = _ts_frame(spark, [0, 60, 121], [1, 1, 1])
    assert E.fault_events(df, gap_sec=60.0, strategy=strategy).count() == 2
    t = E.gap_merge(df, gap_sec=60.0, strategy=strategy).orderBy("start").collect()
    assert [r["n_rows"] for r in t] == [2, 1]            # an equal gap merges


@pytest.mark.parametrize("strategy", ["ranged", "window"])
def test_broken_run(spark, strategy):
    df = _ts_frame(spark, [0, 10, 20], [1, 0, 1])
    assert E.fault_events(df, gap_sec=60.0, strategy=strategy).count() == 2   # a normal row closes
    assert E.gap_merge(df, gap_sec=60.0, strategy=strategy).count() == 1     # normal rows ignored


def test_event_ids_minus_one(spark):
    df = _ts_frame(spark, [0, 10, 20, 1000], [1, 0, 1, 1])
    ids = {r["row_id"]: r["event_id"] for r in E.event_ids(df, gap_min=5.0).collect()}
    assert ids == {0: 0, 1: -1, 2: 1, 3: 2}


def test_open_window(spark):
    df = _ts_frame(spark, [0, 300, 301], [0, 0, 0], [1.0, 3.0, 5.0]).withColumn("asset", F.lit(1))
    out = D.rolling_time_mean(df, ["v"], 300.0, keys=["asset"]).orderBy("ts").collect()
    assert [r["v"] for r in out] == [1.0, 3.0, 4.0]        # left-open: (t - 5 min, t]


def test_nan_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "v double")
    out = df.select(nan_to_null("v").alias("v"))
    assert [r["v"] for r in out.collect()] == [None, 1.0, None]
    assert quantiles(out, ["v"], [0.5])[("v", 0.5)] == 1.0


def test_sil(spark):
    rows = [(0.0, 0), (1.0, 0), (2.0, 0), (10.0, 1), (11.0, 1), (13.0, 1)]
    df = spark.createDataFrame(rows, "x double, y int")
    assert abs(H.silhouette_sq(df, ["x"], "y", min_count=0) - 0.968726) < 1e-6
    assert H.silhouette_sq(df, ["x"], "y", min_count=10) is None


def test_scores_auc_ap(spark):
    rows = list(zip([0.9, 0.8, 0.7, 0.6, 0.5], [1, 0, 1, 0, 1]))
    df = spark.createDataFrame(rows, "score double, y int")
    r = J.auc_ap(df).first()
    assert abs(r["auc_roc"] - 0.5) < 1e-12
    assert abs(r["avg_precision"] - 0.755556) < 1e-6


def test_one_class(spark):
    df = spark.createDataFrame([(0, 0, 0.2), (0, 1, 0.7)], "y int, yhat int, score double")
    r = J.auc_ap(df).first()
    assert r["auc_roc"] is None and r["avg_precision"] is None
    cm = J.confusion_matrix(df).collect()
    assert len(cm) == 4 and sum(x["count"] for x in cm) == 2


# Model metrics published by the reference (processed and
# original schema), and its published deltas.
METRICS_PROC = [("rf", 0.9996865410043303, 1.0), ("mlp", 0.9981139238914798, 0.9999995524806),
                ("lr", 0.9797726299325875, 1.0), ("svm", 0.9783217565213651, 1.0)]
METRICS_ORIG = [("rf", 1.0, 1.0), ("mlp", 0.9909576433863763, 0.9999831500752047),
                ("svm", 0.967126134211309, 0.9999092584136562), ("lr", 0.8488458611774444, 0.9950699016577116)]
DELTAS = {"rf": (-0.00031345899566970203, 0.0), "mlp": (0.007156280505103529, 1.640240539535487e-05),
          "lr": (0.13092676875514309, 0.004930098342288414), "svm": (0.011195622310056108, 9.074158634381213e-05)}


def test_metrics_delta_golden(spark):
    schema = "model string, f1_macro double, auc_roc double"
    tagged = [(*r, t) for t, rows in (("proc", METRICS_PROC), ("orig", METRICS_ORIG)) for r in rows]
    alone = [("only-one-tag", 0.5, 0.5, "proc")]
    d = FC.delta_of(FC.tag_pair(spark.createDataFrame(tagged + alone, schema + ", tag string"), "orig", "proc"))
    got = {r["model"]: (r["delta_f1"], r["delta_auc"]) for r in d.collect()}
    assert set(got) == set(DELTAS)
    for m, (df1, dauc) in DELTAS.items():
        assert abs(got[m][0] - df1) < 1e-12 and abs(got[m][1] - dauc) < 1e-12


def test_raw9(spark):
    rows = [(1, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0)] * 3
    df = spark.createDataFrame(rows)
    named = S.semantic_rename(S.name_positional(df))
    assert named.columns == ["ID", "revolutions", "humidity", "vibration", "temperature", "speed",
                             "signal_strength", "energy", "motor_cycles"]
    with pytest.raises(ValueError):
        S.name_positional(df.drop(df.columns[-1]))


def test_aliases():
    cols = ["Speed", "VIBRATION_raw", "x5"]
    assert S.resolve_column(cols, S.ROLE_ALIASES["speed"]) == "Speed"
    assert S.resolve_column(cols, S.ROLE_ALIASES["vibration"]) == "VIBRATION_raw"
    assert S.resolve_column(cols, S.ROLE_ALIASES["vibration"], substring=False) is None
    assert S.resolve_column(cols, S.ROLE_ALIASES["energy"]) == "x5"
    assert S.resolve_column(cols, S.ROLE_ALIASES["revolutions"]) is None
    assert S.resolve_column(["speed", "SPEED"], ["Speed"]) == "SPEED"      # case clash: last wins
    with pytest.raises(ValueError, match="revolutions"):
        S.require_roles({"speed": "Speed", "revolutions": None}, ["speed", "revolutions"])


def test_first_difference_and_ffill(spark):
    df = _ts_frame(spark, [0, 10, 30, 40], [0, 0, 0, 0], [None, 2.0, None, 5.0])
    f = C.ffill_bfill(df, ["v"]).orderBy("ts").collect()
    assert [r["v"] for r in f] == [2.0, 2.0, 2.0, 5.0]
    d = D.first_difference(df.fillna(0.0, ["v"]), "v", "acc", per_second=True).orderBy("ts").collect()
    assert [r["acc"] for r in d] == [0.0, 0.2, -0.1, 0.5]


def test_write_sorted_files_are_globally_ordered(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq
    from faultline.sources import tele_ev
    from conftest import SF
    t = tele_ev(spark, SF).select("row_id", "ts")
    C.write_sorted(t.repartition(4), str(tmp_path / "sorted"))
    files = sorted(glob.glob(str(tmp_path / "sorted" / "part-*.parquet")))
    prev_max = None
    total = 0
    for f in files:
        tab = pq.read_table(f).to_pandas()
        if len(tab) == 0:
            continue
        keys = list(zip(tab["ts"], tab["row_id"]))
        assert keys == sorted(keys)                        # sorted inside the file
        if prev_max is not None:
            assert keys[0] > prev_max                      # ranges never overlap
        prev_max = keys[-1]
        total += len(tab)
    assert total == t.count()
