"""Fits on whole folds: no query draws its training rows, and passes of our own give Spark's models."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from faultline.operators import models as M
from faultline.plans.catalog import QUERIES, load_all


class Stop(Exception):
    pass


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("tables"))
    i = F.col("id")
    spark.range(0, 30_000, 1, 2).select(
        i.alias("l_orderkey"), F.lit(1).alias("l_linenumber"), (i % 101).alias("l_partkey"), (i % 53).alias("l_suppkey"),
        F.timestamp_seconds(1_600_000_000 + i * 600).alias("l_shipdate"), (i * 7 % 51).cast("double").alias("l_quantity"),
        (i * 31 % 9973).cast("double").alias("l_extendedprice"), (i * 3 % 11 / 100).alias("l_discount"),
        (i * 5 % 9 / 100).alias("l_tax")).write.parquet(at + "/lineitem.parquet")
    load_all()
    return at


@pytest.mark.parametrize("name", ["grid_search_svm", "grid_search_mlp", "model_checks", "stress_diagnostics", "robustness_suite"])
def test_fits_read_whole_folds(spark, tables, monkeypatch, name):
    seen = []

    def fit(train, *a, **k):
        seen.append(train.count())
        raise Stop

    monkeypatch.setattr(M, "fit", fit)
    with pytest.raises(Stop):
        QUERIES[name](spark, tables).collect()
    spark.catalog.clearCache()
    assert seen and min(seen) > 20_500      # 70 % of the rows; were 20,000, 5,000 or 4,000 of them


@pytest.fixture(scope="module")
def rows(spark):
    r = np.random.default_rng(7).normal(size=(1500, 3))
    y = (r[:, 0] + r[:, 1] * r[:, 2] + 0.3 * r[:, 2] > 0.8).astype(int)
    d = spark.createDataFrame([(*map(float, a), int(b)) for a, b in zip(r, y, strict=True)], "a double, b double, c double, y int")
    d = d.repartition(3).cache()
    d.count()
    yield d
    d.unpersist()


def test_networks_in_passes_are_sparks(rows, monkeypatch):
    grid = [("mlp", {"hidden": (6,)}), ("mlp", {"hidden": (5, 4)})]
    want = M.fit_settings(rows, "abc", grid, "y", max_iter=12)
    monkeypatch.setattr(M, "FEW_ROWS", 0)
    got = M.fit_settings(rows, "abc", grid, "y", max_iter=12)
    for a, b in zip(want, got, strict=True):
        assert np.abs(a.stages[-1].weights.toArray() - b.stages[-1].weights.toArray()).max() < 1e-6
    assert M.score_rows(got[0], rows).where("p_fault between 0 and 1").count() == 1500


def test_values_that_are_not_finite_are_refused(rows, monkeypatch):
    monkeypatch.setattr(M, "FEW_ROWS", 0)
    bad = rows.withColumn("b", F.when(F.col("a") < 0, F.col("b")))
    for kind, params in (("mlp", {"hidden": (4,)}), ("svm", {"C": 1.0})):
        with pytest.raises(Exception, match="NULL, NaN or infinite"):
            M.fit(bad, "abc", "y", kind, params, max_iter=2)


def test_kernel_machines_in_passes_are_sparks(spark, rows, monkeypatch, tmp_path):
    grid = [("svm", {"C": c, "gamma": g}) for c, g in ((1.0, "scale"), (0.5, 0.1))]
    kw = dict(max_iter=1, rff_components=12, weighted=False)        # unequal classes: the start has a clear slope
    want = M.fit_settings(rows, "abc", grid, "y", **kw)
    long = M.fit_settings(rows, "abc", grid, "y", **kw | {"max_iter": 25})
    monkeypatch.setattr(M, "FEW_ROWS", 0)
    got = M.fit_settings(rows, "abc", grid, "y", **kw)
    for a, b in zip(want, got, strict=True):
        assert np.abs(a.stages[3].coefficients.toArray() - b.stages[3].coefficients.toArray()).max() < 1e-9
        assert abs(a.stages[5].intercept - b.stages[5].intercept) < 1e-4
    again = M.fit_settings(rows, "abc", grid, "y", **kw | {"max_iter": 25})
    scores = [M.rate_settings(m, rows, "y") for m in (long, again)]
    assert np.abs(np.subtract(*scores)).max() < 0.02
    M.save_model(again[1], str(tmp_path / "svm"))
    a, b = (M.score_rows(m, rows, ["a"]).orderBy("a").collect() for m in (again[1], M.load_model(str(tmp_path / "svm"))))
    assert a == b


def test_suite_of_many_rows_takes_its_splits_in_turn(spark, rows, monkeypatch):
    most = []
    monkeypatch.setattr(M, "FEW_ROWS", 10)
    monkeypatch.setattr(M, "GRIDS", {"lr": [{"C": 1.0}], "svm": [{"C": 1.0, "gamma": "scale"}], "mlp": [{"hidden": (4,)}], "rf": [{"maxDepth": 3}]})
    d = rows.withColumn("row_id", F.monotonically_increasing_id())
    fold = F.when(F.col("row_id") % 4 == 0, "val").when(F.col("row_id") % 4 == 1, "test").otherwise("train")
    one, two = d.withColumn("fold", fold), d.where("a < 1").withColumn("fold", fold)
    real = M._suite
    monkeypatch.setattr(M, "_suite", lambda s, g, *a, **k: most.append(sorted(g)) or real(s, g, *a, **k))
    got = M.regime_suite({"one": (one, ["a", "b", "c"]), "guard": (one, ["a", "b"]), "two": (two, ["a", "c"])}, label="y",
                         max_iter=5, num_trees=3, rff_components=8)
    assert most == [["guard", "one"], ["two"]]
    assert [(r["tag"], r["model"]) for r in got] == [(t, k) for t in ("one", "guard", "two") for k in M.GRIDS]
    assert all(0 <= r["f1_macro"] <= 1 and r["n_test"] > 300 for r in got)
