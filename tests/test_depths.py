"""Forests of several depth limits (I7) are rated from one fit, as if each had been fitted."""
from pyspark.sql import functions as F

from faultline.operators import models as M


def test_cut_forests_rate_as_fitted_ones(spark, monkeypatch):
    u = [F.rand(s) for s in range(3)]
    rows = spark.range(0, 3000, 1, 3).select(*[x.alias(c) for x, c in zip(u, "abc", strict=True)]).withColumn(
        "y", ((F.col("a") + F.col("b") * F.col("c") + F.rand(9) * 0.6) > 1.1).cast("int"))
    rows = rows.withColumn("a", F.when((F.col("b") > 0.9) & (F.col("c") > 0.8), None).otherwise(F.col("a"))).cache()
    rows.count()
    train, val = rows.where("c < 0.7"), rows.where("c >= 0.6")
    grid, kw = [{"maxDepth": d} for d in (None, 2, 5, 9)], dict(num_trees=7)
    for scorer in ("f1_macro", "avg_precision"):
        want = M.rate_settings([M.fit(train, "abc", "y", "rf", g, **kw) for g in grid], val, "y", scorer)
        deep = M.fit(train, "abc", "y", "rf", grid[0], **kw)
        got = M.rate_depths(deep, val, [M.SPARK_MAX_DEPTH, 2, 5, 9], "y", scorer)
        assert len(set(want)) == 4 and all(abs(a - b) < 1e-9 for a, b in zip(got, want, strict=True))
    fits, real = [], M.fit
    monkeypatch.setattr(M, "fit", lambda *a, **k: fits.append(a[4]) or real(*a, **k))
    _, setting, _ = M.grid_search(train, val.dropna(), "abc", "rf", grid, "y", **kw)
    assert fits[0] == {"maxDepth": M.SPARK_MAX_DEPTH} and fits[1] == setting and len(fits) == 2     # were five
    rows.unpersist()
