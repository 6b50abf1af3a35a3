"""Queries whose answer SQL can find because the data hold a planted rule:
I6, I7, I10, I11, I12, H8 and A8 over all model kinds, and the published
tables (A7)."""
from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import linalg as H
from ..operators import models as M
from ..operators import series as D
from ..operators import splits as G
from ..session import scratch_path
from ..sources import tele
from ..sources.io import PROCESSED_COLUMNS, read_telemetry, write_shuffled, write_table
from ..sources.publish import publish, published
from . import q_eval as E
from . import q_models as Q
from .catalog import ORACLE, TELE_SQL, finish, register
from .q_checks import PAIR, TEST_SQL

# x decides the label but for every tenth row; z and w say nothing about it
COLS = ["x", "z", "w"]
PLANT_SQL = f"""{TELE_SQL},
planted AS (SELECT row_id, CAST(vibration % 8 AS DOUBLE) AS x, CAST(asset % 5 AS DOUBLE) AS z,
  CAST(revolutions % 6 AS DOUBLE) AS w, CASE WHEN CAST(right(row_id, 9) AS BIGINT) % 10 = 0
       THEN CAST(vibration % 8 < 5 AS INTEGER) ELSE CAST(vibration % 8 >= 5 AS INTEGER) END AS label_fault FROM tele)"""
# the best cut of a one-split tree: half-way between neighbouring values, by the fall of the Gini impurity
STUMP_SQL = f"""{PLANT_SQL},
long AS (SELECT 'x' AS f, x AS v, label_fault AS y FROM planted UNION ALL SELECT 'z', z, label_fault FROM planted
         UNION ALL SELECT 'w', w, label_fault FROM planted),
val AS (SELECT f, v, count(*) AS n, sum(y) AS p FROM long GROUP BY ALL),
cum AS (SELECT f, v, lead(v) OVER o AS nv, sum(n) OVER o AS n, sum(p) OVER o AS p,
               sum(n) OVER (PARTITION BY f) AS tn, sum(p) OVER (PARTITION BY f) AS tp FROM val
        WINDOW o AS (PARTITION BY f ORDER BY v)),
gain AS (SELECT f, (v + nv) / 2 AS cut, n, p, tn, tp,
                n * 2 * (CAST(p AS DOUBLE) / n) * (1 - CAST(p AS DOUBLE) / n)
                + (tn - n) * 2 * (CAST(tp - p AS DOUBLE) / (tn - n)) * (1 - CAST(tp - p AS DOUBLE) / (tn - n)) AS left_over
         FROM cum WHERE nv IS NOT NULL),
stump AS (SELECT * FROM gain ORDER BY left_over, f LIMIT 1)"""


def planted(spark, sf_dir) -> DataFrame:
    r = F.expr("right(row_id, 9)").cast("bigint")
    x = F.col("vibration") % 8
    return tele(spark, sf_dir).select(
        "row_id", x.cast("double").alias("x"), (F.col("asset") % 5).cast("double").alias("z"),
        (F.col("revolutions") % 6).cast("double").alias("w"),
        F.when(r % 10 == 0, (x < 5).cast("int")).otherwise((x >= 5).cast("int")).alias("label_fault"))


def _stump(spark, sf_dir):
    d = planted(spark, sf_dir)
    return d, M.fit(d, COLS, "label_fault", "tree", {"maxDepth": 1}, weighted=False)


@register("tree_rules_planted", f"""
WITH {STUMP_SQL}
SELECT f || ' <= ' || CAST(cut AS VARCHAR) AS rule, CAST(2 * p > n AS INTEGER) AS prediction FROM stump
UNION ALL SELECT f || ' > ' || CAST(cut AS VARCHAR), CAST(2 * (tp - p) > tn - n AS INTEGER) FROM stump""")
def q_tree_rules_planted(spark, sf_dir):
    """The rules of a one-split tree from its stored nodes; SQL finds the same split."""
    _, m = _stump(spark, sf_dir)
    return M.tree_rule_table(m.stages[-1], COLS).select("rule", "prediction")


@register("pdp_planted", f"""
WITH {STUMP_SQL}, b AS (SELECT quantile_cont(x, 0.01) AS lo, quantile_cont(x, 0.99) AS hi FROM planted)
SELECT round(lo + (hi - lo) * i / 19.0, 6) AS grid_value,
       round(CASE WHEN lo + (hi - lo) * i / 19.0 <= cut THEN CAST(p AS DOUBLE) / n ELSE CAST(tp - p AS DOUBLE) / (tn - n) END, 6)
       AS mean_p_fault FROM b, stump, range(0, 20) r(i)""")
def q_pdp_planted(spark, sf_dir):
    """Partial dependence of a one-split tree is the share of faults on either side of its cut."""
    d, m = _stump(spark, sf_dir)
    return finish(M.partial_dependence(m, d, "x"))


@register("importance_planted", f"""
WITH {STUMP_SQL} SELECT f AS feature, round(CAST(1.0 AS DOUBLE), 6) AS importance FROM stump""")
def q_importance_planted(spark, sf_dir):
    """All impurity that a one-split tree removes falls to the feature that SQL cuts."""
    _, m = _stump(spark, sf_dir)
    rows = [r for r in M.impurity_importance(m, COLS) if r[1] > 0]
    return finish(spark.createDataFrame(rows, "feature string, importance double"))


@register("select_topk_planted", f"""
WITH {STUMP_SQL} SELECT CAST(1 AS INTEGER) AS rank, f AS feature FROM stump""")
def q_select_topk_planted(spark, sf_dir):
    """The planted feature ranks first by permutation importance."""
    top = M.select_topk(planted(spark, sf_dir), COLS, "label_fault", k=1, repeats=2)
    return spark.createDataFrame([(i + 1, f) for i, f in enumerate(top)], "rank int, feature string")


_XOR = "CASE WHEN (x >= 4) = (z >= 2) THEN 1 ELSE 0 END"


@register("grid_search_planted", f"""
WITH {PLANT_SQL},
q AS (SELECT row_id, {_XOR} AS y FROM planted),
best AS (SELECT max(greatest(hit, n - hit)) / CAST(any_value(n) AS DOUBLE) AS one_split FROM (
  SELECT c, sum(CASE WHEN (v <= c) = (y = 1) THEN 1 ELSE 0 END) AS hit, count(*) AS n FROM (
    SELECT 'x' AS f, x AS v, y FROM planted JOIN q USING (row_id) UNION ALL SELECT 'z', z, y FROM planted JOIN q USING (row_id))
  , (VALUES (0.5), (1.5), (2.5), (3.5), (4.5), (5.5), (6.5)) k(c) GROUP BY f, c)),
k AS (SELECT count(*) AS n FROM q)
SELECT CASE WHEN one_split < 1 THEN 4 ELSE 1 END AS best_depth, round(CAST(1.0 AS DOUBLE), 6) AS val_f1, k.n AS n_rows FROM best, k""")
def q_grid_search_planted(spark, sf_dir):
    """Where no single split suffices (an exclusive or) the search must choose the deep tree, which is never wrong."""
    d = planted(spark, sf_dir).withColumn("label_fault", F.expr(_XOR))
    s = G.split_stratified(d, "label_fault").cache()
    tr, va, _ = Q._folds(s)
    _, setting, score = M.grid_search(tr, va, ["x", "z"], "tree", grid=[{"maxDepth": 1}, {"maxDepth": 4}], weighted=False)
    n = s.count()
    s.unpersist()
    return finish(spark.createDataFrame([(setting["maxDepth"], float(score), n)], "best_depth int, val_f1 double, n_rows bigint"))


@register("variant_pair", f"""
WITH {TELE_SQL},
d AS (SELECT row_id, vibration, humidity, avg(vibration) OVER w AS dv FROM tele
      WINDOW w AS (PARTITION BY asset ORDER BY epoch_us(ts), row_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
r AS (SELECT abs(corr(vibration, humidity)) AS a, abs(corr(dv, humidity)) AS b FROM d)
SELECT 'baseline' AS variant, round((1 + a) / 2, 6) AS pc1_var, round((1 - a) / 2, 6) AS pc2_var FROM r
UNION ALL SELECT 'denoised', round((1 + b) / 2, 6), round((1 - b) / 2, 6) FROM r""")
def q_variant_pair(spark, sf_dir):
    """H8 on two features: variance ratios before and after a trailing mean over the whole past are (1 +- |corr|) / 2."""
    t = tele(spark, sf_dir).select("row_id", "ts", "asset", *PAIR)
    den = D.rolling_time_mean(t, ["vibration"], 1e9, keys=["asset"])
    rows = [(tag, *map(float, H.pca(f, PAIR)[0])) for tag, f in (("baseline", t), ("denoised", den))]
    return finish(spark.createDataFrame(rows, "variant string, pc1_var double, pc2_var double"))


@register("score_rows_kinds", f"""
WITH {TEST_SQL}
SELECT row_id, m AS model, true AS reloaded_equal FROM test, (VALUES ('lr'), ('svm'), ('rf'), ('mlp')) v(m)""")
def q_score_rows_kinds(spark, sf_dir):
    """Models saved per kind and tag, reloaded, and every test row scored alike by both."""
    df = Q.prepared(spark, sf_dir).cache()
    tr, _, te = Q._folds(df)
    part = M.fit_sample(tr, "label_fault", 2000).cache()
    settings = [("lr", {"C": 1.0}), ("svm", {"C": 1.0, "gamma": "scale"}), ("rf", {"maxDepth": 6}), ("mlp", {"hidden": (8,)})]
    models = M.fit_settings(part, Q.FEATS, settings, num_trees=5, max_iter=10, rff_components=10)
    root = scratch_path(spark, f"faultline-models-{uuid.uuid4().hex[:12]}")
    out = []
    for (kind, _), m in zip(settings, models, strict=True):
        M.save_model(m, f"{root}/{kind}-processed")
        a = M.score_rows(m, te, keep=["row_id"])
        b = M.score_rows(M.load_model(f"{root}/{kind}-processed"), te, keep=["row_id"])
        b = b.select("row_id", F.col("yhat").alias("y2"), F.col("p_fault").alias("p2"))
        out.append(a.join(b, "row_id").select("row_id", F.lit(kind).alias("model"),
                                              ((F.col("yhat") == F.col("y2")) & (F.col("p_fault") == F.col("p2"))).alias("reloaded_equal")))
    got = reduce(DataFrame.unionByName, out).checkpoint()
    part.unpersist()
    df.unpersist()
    return got


_PUBLISHED = {"metrics": ["asset", "model"], "report": ["model", "metric"], "importance": ["feature"], "loadings": ["feature"]}


@register("published_results", f"""
WITH m AS ({ORACLE['binary_metrics']}), r AS ({ORACLE['classification_report']}),
i AS ({ORACLE['importance_planted']}), l AS ({ORACLE['pca_loadings_pair']})
SELECT 'metrics' AS table_name, CAST(asset AS VARCHAR) || '/' || model AS item, 'f1_macro' AS name, round(f1_macro, 6) AS value FROM m
UNION ALL SELECT 'report', model || '/' || metric, 'Fault', round("Fault", 6) FROM r
UNION ALL SELECT 'importance', feature, 'importance', round(importance, 6) FROM i
UNION ALL SELECT 'loadings', feature, 'pc1_abs', round(pc1_abs, 6) FROM l""")
def q_published_results(spark, sf_dir):
    """Metrics, report, importance and loadings published as one run and read back by its manifest."""
    from . import q_checks as C
    root = scratch_path(spark, f"faultline-results-{uuid.uuid4().hex[:12]}")
    publish(spark, root, {"metrics": E.q_binary_metrics(spark, sf_dir), "report": E.q_classification_report(spark, sf_dir),
                          "importance": q_importance_planted(spark, sf_dir), "loadings": C.q_pca_loadings_pair(spark, sf_dir)})
    value = {"metrics": "f1_macro", "report": "Fault", "importance": "importance", "loadings": "pc1_abs"}
    parts = [published(spark, root, t).select(F.lit(t).alias("table_name"), F.concat_ws("/", *keys).alias("item"),
                                              F.lit(value[t]).alias("name"), F.col(value[t]).alias("value"))
             for t, keys in _PUBLISHED.items()]
    return finish(reduce(DataFrame.unionByName, parts))


@register("processed_written", ORACLE["processed_table"])
def q_processed_written(spark, sf_dir):
    """A3, A4: the processed table written in its column order and as a shuffled copy; the copy's rows."""
    from .q_processed import q_processed_table
    t = q_processed_table(spark, sf_dir)
    root = scratch_path(spark, f"faultline-processed-{uuid.uuid4().hex[:12]}")
    write_table(t, f"{root}/ordered", ["row_id", *PROCESSED_COLUMNS])
    back = spark.read.parquet(f"{root}/ordered")
    write_shuffled(back, f"{root}/shuffled")
    return read_telemetry(spark, f"{root}/shuffled", back.schema, "parquet").select(*t.columns)
