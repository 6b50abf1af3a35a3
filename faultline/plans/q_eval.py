"""Evaluation and comparison queries.

The scored table is a fixture: four fixed scoring formulas per row of
``tele_ev`` (named after the reference's four models) in two variants
(``processed`` and ``original``), label ``y = is_error``, ``yhat = score >=
0.5``.  Metric tables are computed per (asset, model), so they grow with
the data; the formulas are plain SQL, identical on both sides.
"""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import compare as FC
from ..operators import metrics as J
from ..session import scratch_path
from ..sources import io as IO
from ..sources import tele_ev
from .catalog import TELE_EV_SQL, finish, register

SCORERS = {
    "processed": {"rf": "least(vibration / 200.0, 1.0)", "mlp": "least(k / 100.0, 1.0)",
                  "lr": "least((vibration + k) / 300.0, 1.0)", "svm": "least(vibration * k / 20000.0, 1.0)"},
    "original": {"rf": "least(vibration / 250.0, 1.0)", "mlp": "least((k + 10.0) / 120.0, 1.0)",
                 "lr": "least((vibration + 2.0 * k) / 400.0, 1.0)", "svm": "least(vibration * k / 15000.0, 1.0)"},
}
METRIC_COLS = ["accuracy", "precision_macro", "recall_macro", "f1_macro", "recall_fault", "auc_roc", "avg_precision"]


def scored(spark, sf_dir, tag="processed"):
    t = tele_ev(spark, sf_dir)
    arr = F.array(*[F.struct(F.lit(m).alias("model"), F.expr(e).cast("double").alias("score"))
                    for m, e in SCORERS[tag].items()])
    s = t.select("row_id", "asset", F.col("is_error").alias("y"), F.inline(arr))
    return s.withColumn("yhat", (F.col("score") >= 0.5).cast("int"))


def metrics_table(spark, sf_dir, tag="processed", keys=("asset", "model")):
    return J.model_metrics(scored(spark, sf_dir, tag), keys=list(keys), tag=tag)


def tagged_metrics(spark, sf_dir, keys=("asset", "model")):
    """Metrics of both variants from one scan: every reading is scored by
    every (tag, model) formula and the metrics are taken per key and tag."""
    arr = F.array(*[F.struct(F.lit(t).alias("tag"), F.lit(m).alias("model"), F.expr(e).cast("double").alias("score"))
                    for t, by in SCORERS.items() for m, e in by.items()])
    s = tele_ev(spark, sf_dir).select("asset", F.col("is_error").alias("y"), F.inline(arr))
    return J.model_metrics(s.withColumn("yhat", (F.col("score") >= 0.5).cast("int")), keys=[*keys, "tag"])


def scored_sql(tag):
    parts = [f"SELECT row_id, asset, '{m}' AS model, is_error AS y, CAST({e} AS DOUBLE) AS score FROM tele_ev"
             for m, e in SCORERS[tag].items()]
    return (f"scored_{tag} AS (SELECT *, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS yhat FROM ("
            + " UNION ALL ".join(parts) + "))")


def _div(a, b):
    return f"CASE WHEN {b} = 0 THEN 0.0 ELSE CAST({a} AS DOUBLE) / {b} END"


def metrics_sql(tag, keys="asset, model"):
    t = tag
    return f"""{scored_sql(t)},
cnt_{t} AS (SELECT {keys}, count(*) AS n,
   sum(CASE WHEN y = 1 AND yhat = 1 THEN 1 ELSE 0 END) AS tp1, sum(CASE WHEN y = 0 AND yhat = 0 THEN 1 ELSE 0 END) AS tp0,
   sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS t1, sum(CASE WHEN y = 0 THEN 1 ELSE 0 END) AS t0,
   sum(CASE WHEN yhat = 1 THEN 1 ELSE 0 END) AS p1, sum(CASE WHEN yhat = 0 THEN 1 ELSE 0 END) AS p0
   FROM scored_{t} GROUP BY {keys}),
pc_{t} AS (SELECT *, {_div('tp0', 'p0')} AS pr0, {_div('tp0', 't0')} AS rc0, {_div('tp1', 'p1')} AS pr1,
   {_div('tp1', 't1')} AS rc1, CASE WHEN t0 + p0 > 0 THEN 1.0 ELSE 0.0 END AS ps0,
   CASE WHEN t1 + p1 > 0 THEN 1.0 ELSE 0.0 END AS ps1 FROM cnt_{t}),
pf_{t} AS (SELECT *, CASE WHEN pr0 + rc0 = 0 THEN 0.0 ELSE 2 * pr0 * rc0 / (pr0 + rc0) END AS f0,
   CASE WHEN pr1 + rc1 = 0 THEN 0.0 ELSE 2 * pr1 * rc1 / (pr1 + rc1) END AS f1 FROM pc_{t}),
bm_{t} AS (SELECT {keys}, {_div('tp0 + tp1', 'n')} AS accuracy,
   (pr0 * ps0 + pr1 * ps1) / (ps0 + ps1) AS precision_macro, (rc0 * ps0 + rc1 * ps1) / (ps0 + ps1) AS recall_macro,
   (f0 * ps0 + f1 * ps1) / (ps0 + ps1) AS f1_macro, rc1 AS recall_fault FROM pf_{t}),
pts_{t} AS (SELECT {keys}, score, CAST(sum(y) AS DOUBLE) AS pos, CAST(count(*) - sum(y) AS DOUBLE) AS neg
   FROM scored_{t} WHERE score IS NOT NULL GROUP BY {keys}, score),
cum_{t} AS (SELECT *, sum(pos) OVER (PARTITION BY {keys} ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cp,
   sum(neg) OVER (PARTITION BY {keys} ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cn,
   sum(pos) OVER (PARTITION BY {keys}) AS tpos, sum(neg) OVER (PARTITION BY {keys}) AS tneg FROM pts_{t}),
aa_{t} AS (SELECT {keys},
   CASE WHEN max(tpos) = 0 OR max(tneg) = 0 THEN NULL ELSE sum(neg * (cp - pos / 2.0)) / (max(tpos) * max(tneg)) END AS auc_roc,
   CASE WHEN max(tpos) = 0 OR max(tneg) = 0 THEN NULL ELSE sum(pos * (cp / (cp + cn))) / max(tpos) END AS avg_precision
   FROM cum_{t} GROUP BY {keys}),
m_{t} AS (SELECT b.*, a.auc_roc, a.avg_precision, '{t}' AS tag FROM bm_{t} b LEFT JOIN aa_{t} a USING ({keys}))"""


def _r(cols, prefix=""):
    return ", ".join(f"round({prefix}{c}, 6) AS {c}" for c in cols)


@register("confusion_matrix", f"""
WITH {TELE_EV_SQL}, {scored_sql('processed')},
dom AS (SELECT * FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) d(actual, predicted)),
mm AS (SELECT DISTINCT model FROM scored_processed),
c AS (SELECT model, y AS actual, yhat AS predicted, count(*) AS n FROM scored_processed GROUP BY ALL)
SELECT mm.model, dom.actual, dom.predicted, CAST(coalesce(c.n, 0) AS BIGINT) AS count
FROM mm CROSS JOIN dom LEFT JOIN c ON c.model = mm.model AND c.actual = dom.actual AND c.predicted = dom.predicted""")
def q_confusion_matrix(spark, sf_dir):
    """2x2 per model, zero cells kept."""
    return J.confusion_matrix(scored(spark, sf_dir), keys=["model"])


@register("binary_metrics", f"""
WITH {TELE_EV_SQL}, {metrics_sql('processed')}
SELECT asset, model, {_r(METRIC_COLS[:5])} FROM bm_processed""")
def q_binary_metrics(spark, sf_dir):
    """J2 per (asset, model)."""
    return finish(J.binary_metrics(scored(spark, sf_dir), keys=["asset", "model"]))


@register("classification_report", f"""
WITH {TELE_EV_SQL}, {metrics_sql('processed', keys='model')},
acc AS (SELECT model, {_div('tp0 + tp1', 'n')} AS accuracy, n, t0, t1 FROM cnt_processed)
SELECT p.model, 'precision' AS metric, round(pr0, 6) AS "Normal", round(pr1, 6) AS "Fault", round(a.accuracy, 6) AS accuracy,
       round((pr0 * ps0 + pr1 * ps1) / (ps0 + ps1), 6) AS macro_avg, round({_div('pr0 * p.t0 + pr1 * p.t1', 'p.n')}, 6) AS weighted_avg
FROM pf_processed p JOIN acc a USING (model)
UNION ALL
SELECT p.model, 'recall', round(rc0, 6), round(rc1, 6), round(a.accuracy, 6), round((rc0 * ps0 + rc1 * ps1) / (ps0 + ps1), 6),
       round({_div('rc0 * p.t0 + rc1 * p.t1', 'p.n')}, 6) FROM pf_processed p JOIN acc a USING (model)
UNION ALL
SELECT p.model, 'f1-score', round(f0, 6), round(f1, 6), round(a.accuracy, 6), round((f0 * ps0 + f1 * ps1) / (ps0 + ps1), 6),
       round({_div('f0 * p.t0 + f1 * p.t1', 'p.n')}, 6) FROM pf_processed p JOIN acc a USING (model)
UNION ALL
SELECT model, 'support', CAST(t0 AS DOUBLE), CAST(t1 AS DOUBLE), round(accuracy, 6), CAST(n AS DOUBLE), CAST(n AS DOUBLE) FROM acc""")
def q_classification_report(spark, sf_dir):
    """J3 per model."""
    return finish(J.classification_report(scored(spark, sf_dir), keys=["model"]))


@register("roc_curve", f"""
WITH {TELE_EV_SQL}, {metrics_sql('processed', keys='model')}
SELECT model, round(score, 6) AS threshold, round(cn / tneg, 6) AS fpr, round(cp / tpos, 6) AS tpr FROM cum_processed""")
def q_roc_curve(spark, sf_dir):
    """J4 points per model (every distinct score)."""
    return finish(J.roc_curve(scored(spark, sf_dir), keys=["model"]))


@register("roc_curve_thin", f"""
WITH {TELE_EV_SQL}, {metrics_sql('processed', keys='model')},
g AS (SELECT model, score, count(*) FILTER (WHERE y = 1) AS p, count(*) FILTER (WHERE y = 0) AS q FROM scored_processed
      GROUP BY ALL),
n AS (SELECT *, row_number() OVER w AS i, lead(p) OVER w AS np, lead(q) OVER w AS nq FROM g
      WINDOW w AS (PARTITION BY model ORDER BY score DESC))
SELECT c.model, round(c.score, 6) AS threshold, round(cn / tneg, 6) AS fpr, round(cp / tpos, 6) AS tpr
FROM cum_processed c JOIN n ON n.model = c.model AND n.score = c.score
WHERE i = 1 OR np IS NULL OR p * nq <> q * np""")
def q_roc_curve_thin(spark, sf_dir):
    """J4 points per model, straight stretches reduced to their ends."""
    return finish(J.roc_curve_thin(scored(spark, sf_dir), keys=["model"]))


@register("roc_auc", f"""
WITH {TELE_EV_SQL}, {metrics_sql('processed', keys='model')}
SELECT model, round(auc_roc, 6) AS auc_roc FROM aa_processed""")
def q_roc_auc(spark, sf_dir):
    """J4 AUC per model (trapezoid, exact; NULL on one class)."""
    return finish(J.auc_ap(scored(spark, sf_dir), keys=["model"]).select("model", "auc_roc"))


@register("pr_curve", f"""
WITH {TELE_EV_SQL}, {metrics_sql('processed', keys='model')}
SELECT model, round(score, 6) AS threshold, round(cp / (cp + cn), 6) AS precision, round(cp / tpos, 6) AS recall
FROM cum_processed""")
def q_pr_curve(spark, sf_dir):
    """J5 points per model."""
    return finish(J.pr_curve(scored(spark, sf_dir), keys=["model"]))


@register("average_precision", f"""
WITH {TELE_EV_SQL}, {metrics_sql('processed', keys='model')}
SELECT model, round(avg_precision, 6) AS avg_precision FROM aa_processed""")
def q_average_precision(spark, sf_dir):
    """J5 step-wise AP per model."""
    return finish(J.auc_ap(scored(spark, sf_dir), keys=["model"]).select("model", "avg_precision"))


@register("calibration", f"""
WITH {TELE_EV_SQL},
e AS (SELECT quantile_cont(score, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS q FROM tele_ev),
b AS (SELECT score, is_error, CAST((score > q[1]) AS INTEGER) + CAST((score > q[2]) AS INTEGER) + CAST((score > q[3]) AS INTEGER)
        + CAST((score > q[4]) AS INTEGER) + CAST((score > q[5]) AS INTEGER) + CAST((score > q[6]) AS INTEGER)
        + CAST((score > q[7]) AS INTEGER) + CAST((score > q[8]) AS INTEGER) + CAST((score > q[9]) AS INTEGER) AS bin
      FROM tele_ev CROSS JOIN e WHERE score IS NOT NULL)
SELECT bin, round(avg(score), 6) AS mean_pred, round(avg(CAST(is_error AS DOUBLE)), 6) AS frac_pos, count(*) AS n
FROM b GROUP BY bin""")
def q_calibration(spark, sf_dir):
    """10 quantile bins of the score."""
    t = tele_ev(spark, sf_dir).select(F.col("is_error").alias("y"), "score")
    return finish(J.calibration(t))


@register("model_metrics", f"""
WITH {TELE_EV_SQL}, {metrics_sql('processed')}
SELECT asset, model, {_r(METRIC_COLS)}, tag FROM m_processed""")
def q_model_metrics(spark, sf_dir):
    """J2 + J4 + J5 per (asset, model): the metrics table."""
    return finish(metrics_table(spark, sf_dir))


@register("rank_models", f"""
WITH {TELE_EV_SQL}, {metrics_sql('processed')}
SELECT asset, model, round(f1_macro, 6) AS f1_macro, round(auc_roc, 6) AS auc_roc,
       row_number() OVER (PARTITION BY asset ORDER BY f1_macro DESC NULLS LAST, auc_roc DESC NULLS LAST, model) AS rank
FROM m_processed""")
def q_rank_models(spark, sf_dir):
    """Models ranked by macro-F1 then AUC within each asset."""
    r = J.rank_models(metrics_table(spark, sf_dir), keys=["asset"])
    return finish(r.select("asset", "model", "f1_macro", "auc_roc", F.col("rank").cast("long").alias("rank")))


BOTH_SQL = f"{TELE_EV_SQL}, {metrics_sql('processed')}, {metrics_sql('original')}"


@register("metrics_delta", f"""
WITH {BOTH_SQL}
SELECT p.asset, p.model, round(o.f1_macro, 6) AS f1_macro_orig, round(o.auc_roc, 6) AS auc_roc_orig,
       round(p.f1_macro, 6) AS f1_macro_proc, round(p.auc_roc, 6) AS auc_roc_proc,
       round(p.f1_macro - o.f1_macro, 6) AS delta_f1, round(p.auc_roc - o.auc_roc, 6) AS delta_auc
FROM m_processed p JOIN m_original o USING (asset, model)""")
def q_metrics_delta(spark, sf_dir):
    """processed vs original per (asset, model)."""
    pair = FC.tag_pair(tagged_metrics(spark, sf_dir), "original", "processed", ["asset", "model"])
    return finish(FC.delta_of(pair, ["asset", "model"]))


def _wide_sql():
    cols = []
    for k in FC.DELTA_METRICS:
        cols += [f"round(b.{k}, 6) AS {k}_base", f"round(c.{k}, 6) AS {k}_cur", f"round(c.{k} - b.{k}, 6) AS delta_{k}"]
    names = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in FC.MODEL_NAMES.items())
    return f"""
WITH {BOTH_SQL}
SELECT asset, CASE model {names} ELSE model END AS "Model", {", ".join(cols)}
FROM m_processed b JOIN m_original c USING (asset, model)"""


@register("metrics_delta_wide", _wide_sql())
def q_metrics_delta_wide(spark, sf_dir):
    """base (processed) vs current (original), six metrics."""
    pair = FC.tag_pair(tagged_metrics(spark, sf_dir), "processed", "original", ["asset", "model"])
    return finish(FC.delta_wide_of(pair, ["asset", "model"]))


@register("robustness_overview", f"""
WITH {BOTH_SQL},
u AS (SELECT * FROM m_processed UNION ALL SELECT * FROM m_original)
SELECT asset, round(accuracy, 6) AS accuracy, round(f1_macro, 6) AS f1_macro, round(precision_macro, 6) AS precision_macro,
       round(recall_macro, 6) AS recall_macro, round(auc_roc, 6) AS auc_roc, round(avg_precision, 6) AS avg_precision,
       round(recall_fault, 6) AS recall_fault, tag,
       CASE model WHEN 'rf' THEN 'Random Forest' WHEN 'mlp' THEN 'Neural Network (MLP)' END AS "Model",
       CAST(CASE tag WHEN 'processed' THEN 0 WHEN 'processed_guard' THEN 1 WHEN 'processed_time' THEN 2
                     WHEN 'processed_event' THEN 3 ELSE 4 END AS INTEGER) AS tag_order
FROM u WHERE model IN ('rf', 'mlp')""")
def q_robustness_overview(spark, sf_dir):
    """tagged union, RF and MLP, display names, tag order."""
    return finish(FC.robustness_overview(tagged_metrics(spark, sf_dir), keys=["asset"]))


@register("interpretable_vs_nn", f"""
WITH {TELE_EV_SQL}, {metrics_sql('processed')}
SELECT asset, CASE model WHEN 'rf' THEN 'Random Forest' WHEN 'mlp' THEN 'Neural Network (MLP)' END AS "Model Name",
       {_r(["accuracy", "f1_macro", "precision_macro", "recall_macro", "auc_roc", "avg_precision"])}
FROM m_processed WHERE model IN ('rf', 'mlp')""")
def q_interpretable_vs_nn(spark, sf_dir):
    """F4."""
    return finish(FC.interpretable_vs_nn(metrics_table(spark, sf_dir), keys=["asset"]))


@register("metrics_optional_read", f"""
WITH {BOTH_SQL}
SELECT model, tag, {_r(METRIC_COLS)} FROM m_processed
UNION ALL SELECT model, tag, {_r(METRIC_COLS)} FROM m_original""")
def q_metrics_optional_read(spark, sf_dir):
    """Write two metric tables, read back the tags that exist of four."""
    tag = uuid.uuid4().hex[:12]
    paths = {}
    for t in ["processed", "processed_guard", "original", "processed_event"]:
        paths[t] = scratch_path(spark, f"faultline-metrics-{tag}-{t}")
    for t in ["processed", "original"]:
        m = metrics_table(spark, sf_dir, t).select("model", "tag", *METRIC_COLS)
        IO.write_table(m, paths[t], fmt="csv")
    # the two other tags were never written: skipped, as in the reference
    return finish(IO.read_metrics_tagged(spark, paths))
