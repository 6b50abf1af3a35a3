"""Oracle-backed forms of the queries whose digits SQL can't produce.

Closed forms where two features make one (H3-H5), exact row sets, grids,
rates and fold sizes where the model is not involved, and invariants as
booleans where it is.  Each runs the same operators as its counterpart in
``q_models`` / ``q_linalg`` on the same whole tables."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import linalg as H
from ..operators import metrics as J
from ..operators import models as M
from ..operators import splits as G
from ..operators import labels as L
from ..operators import series as D
from ..session import scratch_path
from ..sources import tele
from .catalog import ORACLE, TELE_SQL, finish, islands_sql, register
from . import q_models as Q
from .q_splits import LAB_SQL

FEATS, RULE4, FAST = Q.FEATS, Q.RULE4, Q.FAST
PAIR = ["vibration", "humidity"]
FOLD_SQL = f"folds AS ({ORACLE['split_stratified']})"
TEST_SQL = f"{FOLD_SQL}, test AS (SELECT * FROM folds WHERE fold = 'test')"
PAIR_SQL = f"""{TELE_SQL},
st AS (SELECT corr(vibration, humidity) AS r, avg(vibration) AS mv, stddev_pop(vibration) AS sv,
              avg(humidity) AS mh, stddev_pop(humidity) AS sh FROM tele)"""


# ------------------------------------------------------------ H3-H5 on two features
@register("pca_scree_pair", f"""
WITH {PAIR_SQL}
SELECT CAST(1 AS INTEGER) AS component, round((1 + abs(r)) / 2, 6) AS ratio, round((1 + abs(r)) / 2, 6) AS cumulative FROM st
UNION ALL SELECT 2, round((1 - abs(r)) / 2, 6), round(CAST(1.0 AS DOUBLE), 6) FROM st""")
def q_pca_scree_pair(spark, sf_dir):
    """H3: ratios (1 +- |corr|) / 2."""
    return finish(H.pca_scree(tele(spark, sf_dir), PAIR))


@register("pca_loadings_pair", f"""
WITH {PAIR_SQL}
SELECT f AS feature, round(sqrt(CAST(0.5 AS DOUBLE)), 6) AS pc1_abs, round(sqrt(CAST(0.5 AS DOUBLE)), 6) AS pc2_abs
FROM st, (VALUES ('humidity'), ('vibration')) v(f)""")
def q_pca_loadings_pair(spark, sf_dir):
    """H4: all loadings have modulus sqrt(1/2)."""
    d = H.pca_loadings(tele(spark, sf_dir), PAIR)
    return finish(d.select("feature", F.abs("PC1_loading").alias("pc1_abs"), F.abs("PC2_loading").alias("pc2_abs")))


@register("pca_project_pair", f"""
WITH {PAIR_SQL},
z AS (SELECT row_id, r, (vibration - mv) / sv AS a, (humidity - mh) / sh AS b FROM tele, st)
SELECT row_id, round(abs(CASE WHEN r > 0 THEN a + b ELSE a - b END) * sqrt(CAST(0.5 AS DOUBLE)) * 1000, 0) AS pc1_abs_milli,
       round(abs(CASE WHEN r > 0 THEN a - b ELSE a + b END) * sqrt(CAST(0.5 AS DOUBLE)) * 1000, 0) AS pc2_abs_milli FROM z""")
def q_pca_project_pair(spark, sf_dir):
    """H5: |z1 +- z2| / sqrt(2), in thousandths."""
    p = H.pca_project(tele(spark, sf_dir), PAIR, keep=["row_id"])
    return p.select("row_id", *[F.round(F.abs(f"PC{i}") * 1000, 0).alias(f"pc{i}_abs_milli") for i in (1, 2)])


# ------------------------------------------------------------ models on the fixed folds
@register("model_checks", f"""
WITH {TEST_SQL}
SELECT m AS model, count(*) AS n_test, CAST(sum(label_fault) AS BIGINT) AS n_faults, true AS better_than_chance,
       true AS probabilities_ok, true AS classes_ok
FROM test, (VALUES ('lr'), ('svm'), ('rf'), ('mlp')) v(m) GROUP BY m""")
def q_model_checks(spark, sf_dir):
    """On the whole test fold AUC above 0.75, P(fault) in [0, 1], classes 0/1."""
    df = Q.fit_columns(Q.prepared(spark, sf_dir)).cache()
    tr, _, te = Q._folds(df)
    stats, rows = M.fit_stats(tr, FEATS, "label_fault"), []
    for kind, p in (("lr", {"C": 1.0}), ("svm", {"C": 1.0, "gamma": "scale"}), ("rf", {"maxDepth": 12}),
                    ("mlp", {"hidden": (64, 32)})):
        s = M.score_rows(M.fit(tr, FEATS, "label_fault", kind, p, stats=stats, **FAST), te, keep=["label_fault"]).cache()
        auc = J.auc_ap(s, "label_fault", "p_fault").first()["auc_roc"]
        r = s.agg(F.count("*"), F.sum("label_fault").cast("long"), F.min(F.col("p_fault").between(0, 1)),
                  F.min(F.col("yhat").isin(0, 1))).first()
        s.unpersist()
        rows.append((kind, r[0], r[1], auc is not None and auc > 0.75, bool(r[2]), bool(r[3])))
    df.unpersist()
    return spark.createDataFrame(rows, "model string, n_test bigint, n_faults bigint, better_than_chance boolean, "
                                       "probabilities_ok boolean, classes_ok boolean")


@register("score_rows_keys", f"""
WITH {TEST_SQL} SELECT row_id, label_fault, true AS in_range, true AS class_ok, true AS reloaded_equal FROM test""")
def q_score_rows_keys(spark, sf_dir):
    """I8 + A8: every test row once, and the same score from the reloaded model."""
    whole = Q.prepared(spark, sf_dir)
    df, te = Q.fit_columns(whole).cache(), Q._folds(whole)[2]
    m = M.fit(Q._folds(df)[0], FEATS, "label_fault", "rf", {"maxDepth": 8}, **FAST)
    df.unpersist()      # the fit read it many times, the result reads its rows once
    path = scratch_path(spark, f"faultline-model-{uuid.uuid4().hex[:12]}")
    M.save_model(m, path)
    a = M.score_rows(m, te, keep=["row_id", "label_fault", *FEATS])
    b = M.load_model(path).transform(a.select("row_id", "label_fault", "yhat", "p_fault", *FEATS))
    from pyspark.ml.functions import vector_to_array
    return b.select("row_id", "label_fault", F.col("p_fault").between(0, 1).alias("in_range"),
                    F.col("yhat").isin(0, 1).alias("class_ok"),
                    (vector_to_array("probability")[1] == F.col("p_fault")).alias("reloaded_equal"))


@register("tree_rules_checks", f"""
WITH {FOLD_SQL} SELECT count(*) AS n_rows, true AS one_rule_each, true AS same_as_model, true AS at_most_8 FROM folds""")
def q_tree_rules_checks(spark, sf_dir):
    """Every row meets exactly one rule, with the tree's own prediction."""
    df = Q.prepared(spark, sf_dir).cache()
    tr, _, _ = Q._folds(df)
    m = M.fit(tr, FEATS, "label_fault", "tree", {"maxDepth": 3})
    df.unpersist()
    rules = M.tree_rules(m, FEATS)
    met = [F.expr(r).cast("int") if r else F.lit(1) for r, _ in rules]
    said = sum((x * F.lit(p) for x, (_, p) in zip(met, rules)), F.lit(0))
    s = m.transform(df).select(sum(met, F.lit(0)).alias("n"), (said == F.col("prediction")).alias("same"))
    return s.agg(F.count("*").alias("n_rows"), F.min(F.col("n") == 1).alias("one_rule_each"),
                 F.min("same").alias("same_as_model"), F.lit(len(rules) <= 8).alias("at_most_8"))


@register("grid_search_checks", """
SELECT m AS model, CAST(n AS BIGINT) AS n_settings, true AS in_grid, true AS is_best
FROM (VALUES ('lr', 4), ('svm', 9), ('rf', 4), ('mlp', 3)) v(m, n)""")
def q_grid_search_checks(spark, sf_dir):
    """The chosen setting is of the grid and no other rates higher (AP as the scorer)."""
    df = Q.prepared(spark, sf_dir).select("row_id", *FEATS, "label_fault", "fold").cache()
    tr, va, _ = Q._folds(df)
    part = M.fit_sample(tr, "label_fault", 4000).cache()
    both = part.unionByName(va).cache()     # every search fits its choice on these rows
    kw = dict(num_trees=5, max_iter=15, rff_components=20)

    def search(kind, grid):
        _, setting, score = M.grid_search(part, va, FEATS, kind, scorer="avg_precision", **kw)
        again = M.rate_settings([M.fit(part, FEATS, "label_fault", kind, setting, **kw)], va, scorer="avg_precision")
        return kind, len(grid), setting in grid, abs(again[0] - score) < 0.05 and 0 <= score <= 1

    rows = M.side_by_side(spark, [lambda k=k, g=g: search(k, g) for k, g in M.GRIDS.items()])
    for d in (both, part, df):
        d.unpersist()
    return spark.createDataFrame(rows, "model string, n_settings bigint, in_grid boolean, is_best boolean")


@register("permutation_checks", f"""
WITH {TEST_SQL}
SELECT f AS feature, count(*) AS n_rows, true AS same_values, true AS others_untouched
FROM test, (VALUES {", ".join(f"('{f}')" for f in FEATS)}) v(f) GROUP BY f""")
def q_permutation_checks(spark, sf_dir):
    """A permuted column holds the values of the original, all others are as they were."""
    te = Q._folds(Q.prepared(spark, sf_dir))[2].select("row_id", *FEATS, "label_fault")
    c = M._permuted_copies(te, FEATS, 1, 42, "row_id", "label_fault")
    sums = lambda d, keys: d.groupBy(*keys).agg(F.count("*").alias("n"), *[
        F.bit_xor(F.xxhash64(f)).alias(f"v_{f}") for f in FEATS], *[
        F.bit_xor(F.xxhash64("row_id", f)).alias(f"k_{f}") for f in FEATS])
    got = sums(c, ["fj"])
    base = sums(te, []).select(*[F.col(x).alias(f"b_{x}") for x in got.columns if x != "fj"])
    b = base.first().asDict()
    name = F.array(*[F.lit(f) for f in FEATS])[F.col("fj")]
    same = F.lit(True)
    rest = F.lit(True)
    for i, f in enumerate(FEATS):
        same = same & ((F.col("fj") != i) | (F.col(f"v_{f}") == F.lit(b[f"b_v_{f}"])))
        rest = rest & ((F.col("fj") == i) | (F.col(f"k_{f}") == F.lit(b[f"b_k_{f}"])))
    return got.select(name.alias("feature"), F.col("n").alias("n_rows"), same.alias("same_values"),
                      rest.alias("others_untouched"))


@register("importance_checks", f"""
SELECT f AS feature, true AS nonnegative, true AS sums_to_one
FROM (VALUES {", ".join(f"('{f}')" for f in FEATS)}) v(f)""")
def q_importance_checks(spark, sf_dir):
    """I10."""
    tr, _, _ = Q._folds(Q.prepared(spark, sf_dir))
    imp = M.impurity_importance(M.fit(tr, FEATS, "label_fault", "rf", {"maxDepth": 12}, **FAST), FEATS)
    whole = abs(sum(v for _, v in imp) - 1) < 1e-9
    return spark.createDataFrame([(f, v >= 0, whole) for f, v in imp],
                                 "feature string, nonnegative boolean, sums_to_one boolean")


@register("select_topk_checks", """
SELECT CAST(i AS INTEGER) AS rank, true AS is_feature, true AS new FROM range(1, 5) r(i)""")
def q_select_topk_checks(spark, sf_dir):
    """Four different features."""
    t = L.k_of_n(tele(spark, sf_dir), RULE4).select("row_id", *FEATS, "label_fault")
    top = M.select_topk(t, FEATS, "label_fault", k=4, repeats=1)
    return spark.createDataFrame([(i + 1, f in FEATS, f not in top[:i]) for i, f in enumerate(top)],
                                 "rank int, is_feature boolean, new boolean")


@register("pdp_grid", f"""
WITH {TELE_SQL}, {TEST_SQL},
b AS (SELECT quantile_cont(vibration, 0.01) AS lo, quantile_cont(vibration, 0.99) AS hi
      FROM tele JOIN test USING (row_id))
SELECT round(lo + (hi - lo) * i / 19.0, 6) AS grid_value, true AS in_range FROM b, range(0, 20) r(i)""")
def q_pdp_grid(spark, sf_dir):
    """20 points from P1 to P99 of the test fold; means in [0, 1]."""
    df = Q.sample_columns(Q.prepared(spark, sf_dir)).cache()
    tr, _, te = Q._folds(df)
    with M.cached(M.fit_sample(tr, "label_fault", 5000)) as part:
        m = M.fit(part, FEATS, "label_fault", "rf", {"maxDepth": 8}, **FAST)
    out = M.partial_dependence(m, te, "vibration").toPandas()
    df.unpersist()
    return finish(spark.createDataFrame(out).select("grid_value", F.col("mean_p_fault").between(0, 1).alias("in_range")))


_F5 = ", ".join(f"(CAST({f} AS DOUBLE))" for f in L.STRESS_FACTORS)


@register("stress_rates", f"""
WITH {TELE_SQL},
q4 AS (SELECT quantile_cont(vibration, 0.95) AS v, quantile_cont(speed, 0.95) AS s,
              quantile_cont(energy, 0.95) AS e, quantile_cont(revolutions, 0.95) AS r FROM tele)
SELECT f AS factor, round(avg(CASE WHEN CAST(coalesce(vibration > v * f, false) AS INTEGER)
       + CAST(coalesce(speed > s * f, false) AS INTEGER) + CAST(coalesce(energy > e * f, false) AS INTEGER)
       + CAST(coalesce(revolutions > r * f, false) AS INTEGER) >= 2 THEN 1.0 ELSE 0.0 END), 6) AS fault_rate,
       true AS recall_ok, true AS silhouette_ok
FROM tele, q4, (VALUES {_F5}) w(f) GROUP BY f""")
def q_stress_rates(spark, sf_dir):
    """The rate over all rows is exact, recall and silhouette are in their ranges."""
    s = Q.q_stress_diagnostics(spark, sf_dir)
    ok = lambda c, lo: F.coalesce(F.col(c).between(lo, 1), F.lit(True))
    return s.select("factor", "fault_rate", ok("rf_fault_recall", 0).alias("recall_ok"),
                    ok("silhouette_sq_pc12", -1).alias("silhouette_ok"))


@register("variant_checks", """
SELECT v AS variant, CAST(n AS INTEGER) AS n_features, true AS ratios_ok, true AS silhouette_ok
FROM (VALUES ('baseline', 5), ('denoised', 5), ('selected', 4), ('denoise+select', 4)) w(v, n)""")
def q_variant_checks(spark, sf_dir):
    """H8: the four variants with their feature counts; ratios fall and sum to at most 1."""
    v = Q.q_variant_separation(spark, sf_dir)
    return v.select("variant", F.size(F.split("features", ",")).alias("n_features"),
                    ((F.col("pc1_var") >= F.col("pc2_var")) & (F.col("pc2_var") >= 0)
                     & (F.col("pc1_var") + F.col("pc2_var") <= 1.000001)).alias("ratios_ok"),
                    F.coalesce(F.col("silhouette_sq_pc12").between(-1, 1), F.lit(True)).alias("silhouette_ok"))


_TIMED = LAB_SQL.replace("lab AS (SELECT row_id,", "lab AS (SELECT row_id, ts,")


@register("suite_checks", f"""
WITH {_TIMED}, {TEST_SQL},
p AS (SELECT label_fault, row_number() OVER (ORDER BY ts ASC NULLS LAST, row_id) AS pos, count(*) OVER () AS n FROM lab),
late AS (SELECT label_fault FROM p WHERE pos > floor(CAST(0.7 AS DOUBLE) * n) + floor(CAST(0.15 AS DOUBLE) * n)),
{islands_sql("lab", "300000000.0", null_splits=False)},
grp AS (SELECT label_fault, CASE WHEN label_fault = 1 THEN 'e' || CAST(event_no - 1 AS VARCHAR)
                            ELSE 'r' || CAST(row_id AS VARCHAR) END AS g FROM isl),
rg AS (SELECT g, row_number() OVER (ORDER BY md5(g || '-42'), g) AS rn, count(*) OVER () AS n
       FROM (SELECT DISTINCT g FROM grp)),
cut AS (SELECT g, rn, CAST(ceil(CAST(0.3 AS DOUBLE) * n) AS BIGINT) AS n_out FROM rg),
ev AS (SELECT label_fault FROM grp JOIN cut USING (g)
       WHERE rn > n_out - CAST(ceil(CAST(0.5 AS DOUBLE) * n_out) AS BIGINT) AND rn <= n_out),
sizes AS (SELECT 'processed' AS tag, label_fault FROM test UNION ALL SELECT 'processed_guard', label_fault FROM test
          UNION ALL SELECT 'processed_time', label_fault FROM late UNION ALL SELECT 'processed_event', label_fault FROM ev)
SELECT m AS model, tag, count(*) AS n_test, CAST(sum(label_fault) AS BIGINT) AS n_test_faults, true AS metrics_ok,
       true AS setting_ok
FROM sizes, (VALUES ('lr'), ('svm'), ('rf'), ('mlp')) v(m) GROUP BY m, tag""")
def q_suite_checks(spark, sf_dir):
    """Model kinds, regimes and the size and faults of each test fold."""
    s = Q.suite_frame(spark, sf_dir)
    ok = F.lit(True)
    for c in ("accuracy", "f1_macro", "recall_fault", "val_f1_macro"):
        ok = ok & F.col(c).between(0, 1)
    known = F.lit(False)
    for kind, grid in M.GRIDS.items():
        known = known | ((F.col("model") == kind) & F.col("best_params").isin([str(g) for g in grid]))
    return s.select("model", "tag", "n_test", "n_test_faults", ok.alias("metrics_ok"), known.alias("setting_ok"))


# ------------------------------------------------------------ D2 with ties, NULL keys and NULL values
_TIED = f"""{TELE_SQL},
tied AS (SELECT row_id, ts, CASE WHEN asset % 10 = 0 THEN NULL ELSE asset END AS asset,
                CASE WHEN vibration % 7 = 0 THEN NULL ELSE vibration END AS v FROM tele),
w AS (SELECT row_id, asset, sum(CAST(v AS DECIMAL(28,6))) OVER r AS s, count(v) OVER r AS n,
             sum(CAST(v AS DECIMAL(28,6))) OVER l AS ls, count(v) OVER l AS ln FROM tied
      WINDOW r AS (PARTITION BY asset ORDER BY epoch_us(ts) RANGE BETWEEN 259199999999 PRECEDING AND CURRENT ROW),
             l AS (PARTITION BY asset, ts ORDER BY row_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))"""


def _tied(strategy):
    def q(spark, sf_dir):
        t = tele(spark, sf_dir).select(
            "row_id", "ts", F.when(F.col("asset") % 10 != 0, F.col("asset")).alias("asset"),
            F.when(F.col("vibration") % 7 != 0, F.col("vibration")).alias("v"))
        out = D.rolling_time_mean(t, ["v"], 259200.0, keys=["asset"], fill=False, strategy=strategy)
        return finish(out.select("row_id", F.coalesce("asset", F.lit(-1)).alias("asset"), F.col("v").alias("mean_v")))
    return q


_TIED_SQL = f"""WITH {_TIED}
SELECT row_id, coalesce(asset, -1) AS asset, round(CAST(s - coalesce(ls, 0) AS DOUBLE) / nullif(n - coalesce(ln, 0), 0), 6) AS mean_v FROM w"""
register("rolling_time_mean_tied", _TIED_SQL)(_tied("window"))
register("rolling_time_mean_tied_ranged", _TIED_SQL)(_tied("ranged"))


# ------------------------------------------------------------ H6 on the PC1/PC2 embedding
@register("class_ellipse_pca", f"""
WITH {PAIR_SQL},
q4 AS (SELECT quantile_cont(vibration, 0.95) AS v, quantile_cont(speed, 0.95) AS s,
              quantile_cont(energy, 0.95) AS e, quantile_cont(revolutions, 0.95) AS rv FROM tele),
p AS (SELECT (a + b) * sqrt(CAST(0.5 AS DOUBLE)) AS p1, (a - b) * sqrt(CAST(0.5 AS DOUBLE)) AS p2, label_fault
      FROM (SELECT (vibration - mv) / sv AS a, CASE WHEN r > 0 THEN 1 ELSE -1 END * (humidity - mh) / sh AS b,
                   CAST((CAST(coalesce(vibration > v, false) AS INTEGER) + CAST(coalesce(speed > s, false) AS INTEGER)
                   + CAST(coalesce(energy > e, false) AS INTEGER) + CAST(coalesce(revolutions > rv, false) AS INTEGER)) >= 2
                   AS INTEGER) AS label_fault FROM tele, st, q4)),
c AS (SELECT label_fault, count(*) AS n, var_samp(p1) AS a, covar_samp(p1, p2) AS b, var_samp(p2) AS c
      FROM p GROUP BY label_fault)
SELECT label_fault, n, round(2 * 1.96 * sqrt((a + c) / 2.0 + sqrt(pow((a - c) / 2.0, 2) + pow(b, 2))), 6) AS width,
       round(2 * 1.96 * sqrt((a + c) / 2.0 - sqrt(pow((a - c) / 2.0, 2) + pow(b, 2))), 6) AS height
FROM c WHERE n >= 3 AND a * c - b * b > 0""")
def q_class_ellipse_pca(spark, sf_dir):
    """H6 drawn on H5: axes of the class ellipses in the PC1/PC2 plane of two features."""
    t = L.k_of_n(tele(spark, sf_dir), RULE4)
    emb = H.pca_project(t, PAIR, keep=["label_fault"])
    return finish(H.class_ellipse(emb, "PC1", "PC2", "label_fault").select("label_fault", "n", "width", "height"))


# ------------------------------------------------------------ D2 over any double
_EXTREME_SQL = f"""
WITH {TELE_SQL},
x AS (SELECT row_id, ts, asset, CAST(vibration AS HUGEINT) AS k,
             CAST(right(row_id, 9) AS BIGINT) AS r FROM tele),
y AS (SELECT *, r % 101 = 3 AND asset % 5 = 0 AS up, r % 103 = 5 AND asset % 5 = 0 AS down, r % 17 = 0 AS gone FROM x),
w AS (SELECT row_id, sum(CASE WHEN up OR down OR gone THEN 0 ELSE k END) OVER r AS s,
             count(CASE WHEN NOT gone OR up OR down THEN 1 END) OVER r AS n,
             count(CASE WHEN up THEN 1 END) OVER r AS u, count(CASE WHEN down AND NOT up THEN 1 END) OVER r AS d,
             sum(CASE WHEN up OR down OR gone THEN 0 ELSE k END) OVER l AS ls,
             count(CASE WHEN NOT gone OR up OR down THEN 1 END) OVER l AS ln,
             count(CASE WHEN up THEN 1 END) OVER l AS lu, count(CASE WHEN down AND NOT up THEN 1 END) OVER l AS ld FROM y
      WINDOW r AS (PARTITION BY asset ORDER BY epoch_us(ts) RANGE BETWEEN 863999999999 PRECEDING AND CURRENT ROW),
             l AS (PARTITION BY asset, ts ORDER BY row_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
v AS (SELECT row_id, CAST(s - coalesce(ls, 0) AS DOUBLE) AS s, n - coalesce(ln, 0) AS n, u - coalesce(lu, 0) AS u,
             d - coalesce(ld, 0) AS d FROM w)
SELECT row_id, CASE WHEN n = 0 THEN 'none' WHEN u > 0 AND d > 0 THEN 'nan' WHEN u > 0 THEN 'inf' WHEN d > 0 THEN '-inf'
       ELSE 'finite' END AS kind, round(CASE WHEN n > 0 AND u = 0 AND d = 0 THEN s / n ELSE 0 END, 6) AS mean_scaled FROM v"""


def _extreme(strategy):
    def q(spark, sf_dir):
        # each asset has a scale of its own, so a mean over it is known up to the scale
        scale = F.when(F.col("asset") % 3 == 0, F.lit(1e-14)).when(F.col("asset") % 3 == 1, F.lit(1e27)).otherwise(F.lit(1.0))
        five, r = F.col("asset") % 5 == 0, F.expr("right(row_id, 9)").cast("bigint")
        v = F.when((r % 101 == 3) & five, F.lit(float("inf"))) \
            .when((r % 103 == 5) & five, F.lit(float("-inf"))) \
            .when(r % 34 == 0, F.lit(float("nan"))).when(r % 17 == 0, F.lit(None)) \
            .otherwise(F.col("vibration").cast("bigint").cast("double") * scale)
        t = tele(spark, sf_dir).select("row_id", "ts", "asset", v.alias("v"))
        out = D.rolling_time_mean(t, ["v"], 864000.0, keys=["asset"], fill=False, strategy=strategy)
        m = F.col("v")
        kind = F.when(m.isNull(), "none").when(F.isnan(m), "nan").when(m == float("inf"), "inf") \
            .when(m == float("-inf"), "-inf").otherwise("finite")
        return finish(out.select("row_id", kind.alias("kind"),
                                 F.when(kind == "finite", m / scale).otherwise(0.0).alias("mean_scaled")))
    return q


register("rolling_time_mean_extreme", _EXTREME_SQL)(_extreme("window"))
register("rolling_time_mean_extreme_ranged", _EXTREME_SQL)(_extreme("ranged"))
