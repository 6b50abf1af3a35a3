"""Cleaning operators on small literal frames."""
import numpy as np
import pytest

from faultline.operators import clean as C
from faultline.operators import schema as S


def test_coerce_and_parse(spark):
    df = spark.createDataFrame([("1.5", "2024-01-01 00:00:01"), ("x", "not a time"), ("NaN", None)], "a string, t string")
    c = C.coerce_numeric(df, ["a"]).collect()
    assert [r["a"] for r in c] == [1.5, None, None]                      # bad -> NULL, NaN -> NULL
    p = C.parse_ts(df, "t")
    assert p.count() == 1 and str(p.first()["t"]) == "2024-01-01 00:00:01"
    assert C.parse_ts(df, "t", drop_null=False).count() == 3


def test_median_impute_exact(spark):
    vals = [3.0, None, 1.0, 10.0, None, 4.0]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    med = float(np.median([v for v in vals if v is not None]))
    out = [r["v"] for r in C.median_impute(df, ["v"]).collect()]
    assert out == [3.0, med, 1.0, 10.0, med, 4.0]
    prof = {r["column"]: (r["nulls_before"], r["nulls_after"])
            for r in C.null_profile(df, C.median_impute(df, ["v"]), ["v"]).collect()}
    assert prof == {"v": (2, 0)}


def test_pick_label_and_features(spark):
    df = spark.createDataFrame([(1, 0.5, 1, 1, "x")], "asset long, vibration double, label_fault int, FAULT_900 int, s string")
    assert S.numeric_features(df) == ["asset", "vibration"]
    assert S.leakage_guard(["asset", "vibration"], ["vibration"]) == ["asset"]
    with pytest.raises(ValueError, match="none of the label columns"):
        S.pick_label(df)
    shape = C.shape_profile(df, "label_fault").first()
    assert (shape["n_rows"], shape["n_cols"], shape["n_positive"]) == (1, 5, 1)
