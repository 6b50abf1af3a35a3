"""Model queries (I1-I13, J8, A8, H8).  Rows-only: model parity with the
reference is approximate by design; tests check invariants instead."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import compare as FC
from ..operators import events as E
from ..operators import labels as L
from ..operators import linalg as H
from ..operators import metrics as J
from ..operators import models as M
from ..operators import schema as S
from ..operators import series as D
from ..operators import splits as G
from ..session import scratch_path
from ..sources import tele
from .catalog import TELE_SQL, finish, register

FEATS = ["vibration", "revolutions", "speed", "energy", "humidity"]
RULE4 = ["vibration", "speed", "energy", "revolutions"]
FAST = dict(num_trees=20, max_iter=50, rff_components=50)


def prepared(spark, sf_dir):
    """tele -> 2-of-4 label -> stratified 70/15/15 folds (weights belong to each fit)."""
    t = L.k_of_n(tele(spark, sf_dir), RULE4).select("row_id", "ts", "asset", *FEATS, "label_fault")
    return G.split_stratified(t, "label_fault")


def fit_columns(df):
    """What fits and ratings read: ids and times stay out of the cache."""
    return df.select(*FEATS, "label_fault", "fold")


def sample_columns(df):
    """What bounded fits and ratings read: the key that draws the sample, no times and assets."""
    return df.select("row_id", *FEATS, "label_fault", "fold")


def _folds(df):
    return (df.where(F.col("fold") == "train"), df.where(F.col("fold") == "val"),
            df.where(F.col("fold") == "test"))


def _test_metrics(model, test, name, tag="processed"):
    s = M.score_rows(model, test, keep=["label_fault"])
    b = J.binary_metrics(s, "label_fault", "yhat").withColumn("_k", F.lit(1))
    a = J.auc_ap(s, "label_fault", "p_fault").withColumn("_k", F.lit(1))
    return b.join(a, "_k").drop("_k").select(F.lit(name).alias("model"), F.lit(tag).alias("tag"), "*")


@register("class_weights", f"""
WITH {TELE_SQL},
q4 AS (SELECT quantile_cont(vibration, 0.95) AS v, quantile_cont(speed, 0.95) AS s,
              quantile_cont(energy, 0.95) AS e, quantile_cont(revolutions, 0.95) AS r FROM tele),
lab AS (SELECT row_id, CAST((CAST(coalesce(vibration > v, false) AS INTEGER) + CAST(coalesce(speed > s, false) AS INTEGER)
        + CAST(coalesce(energy > e, false) AS INTEGER) + CAST(coalesce(revolutions > r, false) AS INTEGER)) >= 2 AS INTEGER)
        AS label_fault FROM tele CROSS JOIN q4),
cc AS (SELECT label_fault, count(*) AS c, sum(count(*)) OVER () AS n, count(*) OVER () AS k FROM lab GROUP BY 1)
SELECT row_id, label_fault, round(n / (k * c), 6) AS weight FROM lab JOIN cc USING (label_fault)""")
def q_class_weights(spark, sf_dir):
    """Balanced weights n / (2 n_c)."""
    t = L.k_of_n(tele(spark, sf_dir), RULE4).select("row_id", "label_fault")
    return finish(M.class_weights(t, "label_fault"))


def _train_one(kind, params):
    def q(spark, sf_dir):
        df = fit_columns(prepared(spark, sf_dir)).cache()
        tr, va, te = _folds(df)
        m = M.fit(tr, FEATS, "label_fault", kind, params, **FAST)
        out = _test_metrics(m, te, kind).toPandas()
        df.unpersist()
        return finish(spark.createDataFrame(out))
    return q


register("train_lr")(_train_one("lr", {"C": 1.0}))
register("train_rbf_svm")(_train_one("svm", {"C": 1.0, "gamma": "scale"}))
register("train_rf")(_train_one("rf", {"maxDepth": 12}))
register("train_mlp")(_train_one("mlp", {"hidden": (64, 32)}))


@register("tree_rules")
def q_tree_rules(spark, sf_dir):
    """Depth-3 weighted tree as rules."""
    df = prepared(spark, sf_dir).cache()
    m = M.fit(_folds(df)[0], FEATS, "label_fault", "tree", {"maxDepth": 3})
    df.unpersist()
    rules = M.tree_rules(m, FEATS)
    return spark.createDataFrame([(i, r, p) for i, (r, p) in enumerate(rules)], "rule_id int, rule string, prediction int")


@register("grid_search")
def q_grid_search(spark, sf_dir):
    """LR grid on the fixed validation fold, refit on train + val."""
    df = fit_columns(prepared(spark, sf_dir)).cache()
    tr, va, te = _folds(df)
    m, best_p, best = M.grid_search(tr, va, FEATS, "lr", **FAST)
    out = _test_metrics(m, te, "lr").withColumn("best_params", F.lit(str(best_p))) \
                                     .withColumn("val_f1_macro", F.lit(float(best))).toPandas()
    df.unpersist()
    return finish(spark.createDataFrame(out))


@register("score_rows")
def q_score_rows(spark, sf_dir):
    """I8: class and P(fault) for every test row."""
    whole = prepared(spark, sf_dir)
    df = fit_columns(whole).cache()
    m = M.fit(_folds(df)[0], FEATS, "label_fault", "rf", {"maxDepth": 12}, **FAST)
    df.unpersist()      # the fit read it many times, the result reads its rows once
    return finish(M.score_rows(m, _folds(whole)[2], keep=["row_id", "label_fault"]))


def _forest_and_test(spark, sf_dir):
    """A forest of the training fold, and the cached test fold; the training rows are released."""
    whole = prepared(spark, sf_dir)
    df = _folds(whole)[0].select(*FEATS, "label_fault").cache()     # without the fold, which would be dealt twice a row
    m = M.fit(df, FEATS, "label_fault", "rf", {"maxDepth": 12}, **FAST)
    df.unpersist()
    return m, _folds(whole)[2].select("row_id", *FEATS, "label_fault").cache()


@register("permutation_importance")
def q_permutation_importance(spark, sf_dir):
    """I9 on the whole test fold, 3 repeats, accuracy."""
    m, te = _forest_and_test(spark, sf_dir)
    out = M.permutation_importance(m, te, FEATS, "label_fault", repeats=3).toPandas()
    te.unpersist()
    return finish(spark.createDataFrame(out))


@register("impurity_importance")
def q_impurity_importance(spark, sf_dir):
    """I10."""
    df = prepared(spark, sf_dir).cache()
    m = M.fit(_folds(df)[0], FEATS, "label_fault", "rf", {"maxDepth": 12}, **FAST)
    df.unpersist()
    return finish(spark.createDataFrame(M.impurity_importance(m, FEATS), "feature string, importance double"))


@register("select_topk")
def q_select_topk(spark, sf_dir):
    """Top-4 features by permutation importance on a balanced sample."""
    t = L.k_of_n(tele(spark, sf_dir), RULE4).select("row_id", *FEATS, "label_fault")
    top = M.select_topk(t, FEATS, "label_fault", k=4, repeats=3)
    return spark.createDataFrame([(i + 1, f) for i, f in enumerate(top)], "rank int, feature string")


@register("partial_dependence")
def q_partial_dependence(spark, sf_dir):
    """20-point PDP of vibration, averaged over the whole test fold."""
    df = prepared(spark, sf_dir).cache()
    tr, _, te = _folds(df)
    m = M.fit(tr, FEATS, "label_fault", "rf", {"maxDepth": 12}, **FAST)
    out = M.partial_dependence(m, te, "vibration").toPandas()
    df.unpersist()
    return finish(spark.createDataFrame(out))


@register("stress_diagnostics")
def q_stress_diagnostics(spark, sf_dir):
    """Per factor, the fault rate of all rows, the silhouette of the
    relabelled rows on the fixed PCA embedding, and the fault recall on the
    whole test fold of a forest fitted on the whole training fold."""
    t = L.k_of_n(tele(spark, sf_dir), RULE4).select("row_id", *FEATS, "label_fault").cache()
    thr = L.quantile_thresholds(t, RULE4, 0.95)
    emb = H.pca_project(t, FEATS, keep=RULE4).cache()
    rates = {r["factor"]: r["fault_rate"] for r in L.threshold_stress(t, RULE4, thresholds=thr).collect()}
    def diagnose(f):
        lab = (L.rule_count(RULE4, {c: thr[c] * f for c in RULE4}) >= 2).cast("int")
        sil = H.silhouette_sq(emb.withColumn("y_f", lab), ["PC1", "PC2"], "y_f")
        sp = G.split_two_way(t.withColumn("y_f", lab), "y_f", 0.3)
        tr, te = sp.where(F.col("fold") == "train"), sp.where(F.col("fold") == "test")
        rec, stats = None, M.fit_stats(tr, FEATS, "y_f")
        if stats.classes.get(1, 0) > 0:
            mdl = M.fit(tr, FEATS, "y_f", "rf", {"maxDepth": None}, stats=stats, **FAST)
            rec = J.binary_metrics(M.score_rows(mdl, te, keep=["y_f"]), "y_f", "yhat").first()["recall_fault"]
        return float(f), float(rates[float(f)]), sil, rec

    rows = M.side_by_side(spark, [lambda f=f: diagnose(f) for f in L.STRESS_FACTORS], M.fit_width(t.count()))
    for d in (t, emb):
        d.unpersist()
    return finish(spark.createDataFrame(rows, "factor double, fault_rate double, silhouette_sq_pc12 double, "
                                              "rf_fault_recall double"))


SUITE = dict(num_trees=10, max_iter=20, rff_components=30)


def suite_rows(spark, sf_dir):
    """Per regime (random, leakage guard, chronological, event-grouped)
    and model kind, the grid is searched on the validation fold and the
    choice refitted on train + validation, each fit on whole folds, then
    rated on the whole test fold.  One row per (model, regime)."""
    base = L.k_of_n(tele(spark, sf_dir), RULE4).select("row_id", "ts", *FEATS, "label_fault")
    random, timed, grouped = M.side_by_side(spark, [
        lambda: fit_columns(G.split_stratified(base, "label_fault")),
        lambda: fit_columns(G.split_chronological(base)),
        lambda: fit_columns(G.split_event_group(E.event_ids(base, "label_fault", gap_min=5.0)))])
    return M.regime_suite({
        "processed": (random, FEATS),
        "processed_guard": (random, S.leakage_guard(FEATS, RULE4)),
        "processed_time": (timed, FEATS),
        "processed_event": (grouped, FEATS),
    }, **SUITE)


def suite_frame(spark, sf_dir):
    cols = ["model", "tag", "accuracy", "precision_macro", "recall_macro", "f1_macro", "recall_fault", "auc_roc",
            "avg_precision", "val_f1_macro", "best_params", "n_test", "n_test_faults"]
    kinds = {"model": "string", "tag": "string", "best_params": "string", "n_test": "bigint", "n_test_faults": "bigint"}
    return spark.createDataFrame([tuple(r.get(c) for c in cols) for r in suite_rows(spark, sf_dir)],
                                 ", ".join(f"{c} {kinds.get(c, 'double')}" for c in cols))


@register("robustness_suite")
def q_robustness_suite(spark, sf_dir):
    """The four model kinds under the four regimes."""
    return finish(suite_frame(spark, sf_dir))


@register("robustness_overview_suite")
def q_robustness_overview_suite(spark, sf_dir):
    """F3 over the suite's regime tables."""
    s = suite_frame(spark, sf_dir)
    tags = [r["tag"] for r in s.select("tag").distinct().collect()]      # four regimes
    return finish(FC.robustness_overview({t: s.where(F.col("tag") == t) for t in tags}))


@register("model_roundtrip")
def q_model_roundtrip(spark, sf_dir):
    """Save, reload, and score again; scores must be identical."""
    df = prepared(spark, sf_dir).cache()
    tr, _, te = _folds(df)
    m = M.fit(tr, FEATS, "label_fault", "rf", {"maxDepth": 8}, **FAST)
    path = scratch_path(spark, f"faultline-model-rf-{uuid.uuid4().hex[:12]}")
    df.unpersist()
    M.save_model(m, path)
    m2 = M.load_model(path)
    a = M.score_rows(m, te, keep=["row_id"])
    b = M.score_rows(m2, te, keep=["row_id"]).withColumnRenamed("p_fault", "p_reloaded").drop("yhat")
    return finish(a.join(b, "row_id").withColumn("same", F.col("p_fault") == F.col("p_reloaded")))


@register("variant_separation")
def q_variant_separation(spark, sf_dir):
    """H8: PCA + silhouette for baseline, denoised (5-min trailing mean of
    vibration and speed per asset), top-k selected, and both."""
    t = L.k_of_n(tele(spark, sf_dir), RULE4).select("row_id", "ts", "asset", *FEATS, "label_fault").cache()
    den = D.rolling_time_mean(t, ["vibration", "speed"], 300.0, keys=["asset"]).cache()
    top = M.select_topk(t, FEATS, "label_fault", k=4, repeats=2)
    rows = []
    for tag, frame, cols in (("baseline", t, FEATS), ("denoised", den, FEATS), ("selected", t, top),
                             ("denoise+select", den, top)):
        ratios, _ = H.pca(frame, cols)
        emb = H.pca_project(frame, cols, keep=["label_fault"])
        rows.append((tag, float(ratios[0]), float(ratios[1]), H.silhouette_sq(emb, ["PC1", "PC2"], "label_fault"),
                     ",".join(cols)))
    t.unpersist(); den.unpersist()
    return finish(spark.createDataFrame(rows, "variant string, pc1_var double, pc2_var double, "
                                              "silhouette_sq_pc12 double, features string"))


@register("grid_search_rf")
def q_grid_search_rf(spark, sf_dir):
    """I7 for the forest: depth grid (unlimited -> Spark's 30, 8, 12, 16) on
    the fixed validation fold by macro-F1, refit on train + validation."""
    df = fit_columns(prepared(spark, sf_dir)).cache()
    tr, va, te = _folds(df)
    m, best_p, best = M.grid_search(tr, va, FEATS, "rf", **FAST)
    out = _test_metrics(m, te, "rf").withColumn("best_params", F.lit(str(best_p))) \
                                     .withColumn("val_f1_macro", F.lit(float(best))).toPandas()
    df.unpersist()
    return finish(spark.createDataFrame(out))


def _grid_query(kind):
    def q(spark, sf_dir):
        df = fit_columns(prepared(spark, sf_dir)).cache()
        tr, va, te = _folds(df)
        m, best_p, best = M.grid_search(tr, va, FEATS, kind, **FAST)
        out = _test_metrics(m, te, kind).withColumn("best_params", F.lit(str(best_p))) \
                                        .withColumn("val_f1_macro", F.lit(float(best))).toPandas()
        df.unpersist()
        return finish(spark.createDataFrame(out))
    return q


# I7 for the kernel machine (9 settings) and the network (3); each fit on whole folds
register("grid_search_svm")(_grid_query("svm"))
register("grid_search_mlp")(_grid_query("mlp"))


@register("pdp_by_importance")
def q_pdp_by_importance(spark, sf_dir):
    """I9 -> I12: the two features whose permutation costs most average
    precision get the partial dependence, over the whole test fold."""
    m, te = _forest_and_test(spark, sf_dir)
    imp = M.permutation_importance(m, te, FEATS, "label_fault", repeats=2, scoring="average_precision")
    top = [r["feature"] for r in imp.orderBy(F.desc("importance_mean"), "feature").limit(2).collect()]
    outs = [M.partial_dependence(m, te, f).withColumn("feature", F.lit(f)).withColumn("rank", F.lit(i + 1)).toPandas()
            for i, f in enumerate(top)]
    te.unpersist()
    import pandas as pd
    return finish(spark.createDataFrame(pd.concat(outs, ignore_index=True)))
