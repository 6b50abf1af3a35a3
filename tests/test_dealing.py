"""Rows are dealt to folds by their md5 alone, in methods that HotSpot compiles; sketches are shared."""
from pyspark.sql import functions as F

from faultline.operators import splits as G
from faultline.plans import quantile as Q


def test_folds_are_dealt_by_the_md5(spark):
    df = spark.range(0, 3000, 1, 4).select(F.col("id").cast("string").alias("row_id"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    sp = G.split_stratified(df, "y")
    for d in (sp, sp.where("fold = 'train'").select("row_id")):
        assert "conv(" not in d._jdf.queryExecution().executedPlan().toString()     # was read up to four times a row
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    fold = {r["row_id"]: r["fold"] for r in sp.collect()}
    h = F.md5(F.concat("row_id", F.lit("-42")))
    for y, (a, b) in {0: (1890, 2295), 1: (210, 255)}.items():
        line = [r["row_id"] for r in df.where(F.col("y") == y).orderBy(h, "row_id").collect()]
        assert [fold[i] for i in line] == ["train"] * a + ["val"] * (b - a) + ["test"] * (len(line) - b)


def test_one_sketch_per_interval(spark, monkeypatch):
    seen, real = [], F.percentile_approx
    monkeypatch.setattr(F, "percentile_approx", lambda *a: seen.append(a[1]) or real(*a))
    df = spark.range(1001).select((F.col("id") * 1.5).alias("x"))
    got = Q.quantiles(df, ["x"], [0.25, 0.9505], small=10, accuracy=100)
    assert abs(got["x", 0.25] - 375.0) < 1e-9 and abs(got["x", 0.9505] - 1425.75) < 1e-9
    assert len(seen[0]) == 6        # two values for each of three ranks of one interval: one sketch, was three
