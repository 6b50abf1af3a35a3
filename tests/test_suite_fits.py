"""Fits of the regime suite (J8): rows read once, regimes side by side."""
import threading

from pyspark.sql import functions as F

from faultline.operators import models as M

LIMIT = "spark.sql.codegen.hugeMethodLimit"


def rows_of(spark, n=300):
    return spark.range(0, n, 1, 1).select(F.concat(F.lit("r"), "id").alias("row_id"), (F.col("id") % 10).cast("double").alias("a"),
                                          (F.col("id") % 7).cast("double").alias("b"), (F.col("id") % 10 > 6).cast("int").alias("y"),
                                          F.when(F.col("id") % 4 == 0, "val").when(F.col("id") % 4 == 1, "test").otherwise("train").alias("fold"))


def test_svm_computes_the_features_of_few_rows_once(spark):
    seen, before = spark.sparkContext.accumulator(0), spark.conf.get(LIMIT)
    rows = rows_of(spark)
    stats = M.fit_stats(rows, ["a", "b"], "y")

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    try:
        m = M.fit(rows.mapInArrow(count, rows.schema), ["a", "b"], "y", "svm", {"C": 1.0}, stats=stats, max_iter=10, rff_components=20)
        assert seen.value == 300
        assert spark.conf.get(LIMIT) == "8000"      # longer methods are interpreted
        assert M.score_rows(m, rows).where("p_fault between 0 and 1 and yhat in (0, 1)").count() == 300
    finally:
        spark.conf.set(LIMIT, before)


def test_regimes_are_drawn_side_by_side(spark, monkeypatch):
    meet, draw = threading.Barrier(2), M.fit_sample

    def fit_sample(*a, **k):
        meet.wait(60)           # a second regime must be at work
        return draw(*a, **k)

    monkeypatch.setattr(M, "fit_sample", fit_sample)
    monkeypatch.setattr(M, "GRIDS", {"lr": [{"C": 1.0}]})
    rows = rows_of(spark)
    got = M.regime_suite({"one": (rows, ["a", "b"]), "two": (rows.where("a < 9"), ["a"])}, label="y", fit_rows=100, max_iter=5)
    assert {(r["tag"], r["model"], r["n_test"]) for r in got} == {("one", "lr", 75), ("two", "lr", 60)}
