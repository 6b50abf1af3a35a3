"""Published tables, node tables, one-pass partial dependence, thinned ROC curves, fits side by side."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from faultline.operators import metrics as J
from faultline.operators import models as M
from faultline.sources.io import write_table
from faultline.sources.publish import manifest, publish, published


@pytest.fixture(scope="module")
def rows(spark):
    r = random.Random(5)
    data = []
    for i in range(600):
        a, b, c = r.gauss(0, 1), r.gauss(5, 2), r.choice([0.0, 1.0, 2.0])
        data.append((i, a, b, c, int(a + 0.3 * b + r.gauss(0, .5) > 2)))
    return spark.createDataFrame(data, "row_id long, a double, b double, c double, y int").cache()


def test_half_a_run_is_never_seen(spark, tmp_path):
    root = str(tmp_path / "out")
    one = spark.range(3).withColumnRenamed("id", "v")
    assert manifest(spark, root).count() == 0
    with pytest.raises(ValueError, match="no published table"):
        published(spark, root, "metrics")
    publish(spark, root, {"metrics": one, "report": one})
    # a run that wrote its tables but no manifest
    write_table(spark.range(99), root + "/runs/broken/metrics")
    assert published(spark, root, "metrics").count() == 3
    publish(spark, root, {"metrics": spark.range(5).withColumnRenamed("id", "v")})
    assert published(spark, root, "metrics").count() == 5 and manifest(spark, root).count() == 1
    with pytest.raises(ValueError):
        published(spark, root, "report")


def test_partial_dependence_in_one_pass_equals_copies(rows):
    for kind, params in (("rf", {"maxDepth": 6}), ("tree", {"maxDepth": 4})):
        m = M.fit(rows, ["a", "b", "c"], "y", kind, params, num_trees=7)
        for feature in ("a", "c"):
            got = {r["grid_value"]: r["mean_p_fault"] for r in M.partial_dependence(m, rows, feature).collect()}
            rep = rows.select("*", F.explode(F.array(*[F.lit(v) for v in got])).alias("g")).withColumn(feature, F.col("g"))
            want = M.score_rows(m, rep, keep=["g"]).groupBy("g").agg(F.avg("p_fault").alias("p")).collect()
            assert len(want) == len(got) and all(abs(got[r["g"]] - r["p"]) < 1e-9 for r in want)


def test_rules_of_a_deep_tree_match_the_model(rows):
    m = M.fit(rows, ["a", "b", "c"], "y", "tree", {"maxDepth": 5})
    rules = M.tree_rules(m, ["a", "b", "c"])
    assert len(rules) == m.stages[-1].numNodes // 2 + 1
    met = [F.expr(r).cast("int") for r, _ in rules]
    said = sum((x * p for x, (_, p) in zip(met, rules, strict=True)), F.lit(0))
    s = m.transform(rows).select(sum(met, F.lit(0)).alias("n"), (said == F.col("prediction")).alias("ok"))
    assert s.where("n <> 1 or not ok").count() == 0


def test_rules_of_a_tree_without_a_split(spark):
    d = spark.createDataFrame([(i, 1.0, 0) for i in range(10)], "row_id long, a double, y int")
    assert M.tree_rules(M.fit(d, ["a"], "y", "tree", weighted=False), ["a"]) == [("", 0)]


def test_thinned_curve_keeps_the_area(spark):
    r = random.Random(2)
    data = [(k, r.choice([0, 1]), r.randint(0, 40) / 40) for k in "ab" for _ in range(300)]
    data += [("c", 1, 0.5), ("d", 1, 0.9), ("d", 0, 0.1)] + [("e", int(i < 50), i / 100) for i in range(100)]
    d = spark.createDataFrame(data, "k string, y int, score double")
    full = J.roc_curve(d, keys=["k"]).toPandas()
    thin = J.roc_curve_thin(d, keys=["k"]).toPandas()
    assert len(thin) < len(full) and len(thin[thin.k == "e"]) == 3

    def area(t):
        t = t.sort_values("threshold", ascending=False)
        x, y = np.append(0, t.fpr.fillna(0)), np.append(0, t.tpr.fillna(0))
        return float(((x[1:] - x[:-1]) * (y[1:] + y[:-1]) / 2).sum())
    for k in "abde":
        assert abs(area(full[full.k == k]) - area(thin[thin.k == k])) < 1e-12


def test_calls_side_by_side_keep_order_group_and_errors(spark):
    sc = spark.sparkContext
    sc.setLocalProperty("faultline.test", "mine")
    got = M.side_by_side(spark, [lambda i=i: (i, spark.range(i).count(), sc.getLocalProperty("faultline.test"))
                                 for i in range(20)], width=4)
    assert got == [(i, i, "mine") for i in range(20)]
    with pytest.raises(ZeroDivisionError):
        M.side_by_side(spark, [lambda: 1, lambda: 1 // 0])
    sc.setLocalProperty("faultline.test", None)
