"""Evaluation (J1-J7) as exact distributed aggregations over a scored
table (label ``y`` in {0,1}, prediction ``yhat``, probability ``score``).

* The class domain is fixed to {0, 1}: a one-class fold still yields a 2x2
  confusion matrix, and AUC / AP are NULL there (Spark's evaluator would
  say 0.0).
* ROC and PR need no per-row window over the whole table: rows collapse to
  one row per (keys, distinct score) with positive/negative counts, and a
  running sum in descending score order (segmented scan) gives every
  threshold's TP/FP.  AUC = sum(neg * (cum_pos - pos / 2)) / (P * N) is the
  trapezoid rule; AP = sum(pos / P * cum_pos / (cum_pos + cum_neg)) is the
  step-wise average precision -- both plain aggregates.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import safe_div
from ..plans.order import carry_prev, running_sums
from ..plans.quantile import quantiles

CLASS_NAMES = {0: "Normal", 1: "Fault"}


def _counts(df: DataFrame, y: str, yhat: str, keys):
    yy, pp = F.col(y).cast("int"), F.col(yhat).cast("int")
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if((yy == 1) & (pp == 1)).alias("tp1"), F.count_if((yy == 0) & (pp == 0)).alias("tp0"),
        F.count_if(yy == 1).alias("t1"), F.count_if(yy == 0).alias("t0"),
        F.count_if(pp == 1).alias("p1"), F.count_if(pp == 0).alias("p0"))


def confusion_matrix(df: DataFrame, y: str = "y", yhat: str = "yhat", keys=()) -> DataFrame:
    """(actual, predicted, count) over the full 2x2 domain."""
    keys = list(keys)
    yy, pp = F.col(y).cast("int"), F.col(yhat).cast("int")
    c = df.groupBy(*keys).agg(*[F.count_if((yy == a) & (pp == b)).alias(f"c{a}{b}")
                                for a in (0, 1) for b in (0, 1)])
    cells = F.array(*[F.struct(F.lit(a).alias("actual"), F.lit(b).alias("predicted"),
                               F.col(f"c{a}{b}").cast("long").alias("count")) for a in (0, 1) for b in (0, 1)])
    return c.select(*keys, F.inline(cells))


def _per_class(c: DataFrame):
    out = {}
    for k in (0, 1):
        p = safe_div(f"tp{k}", f"p{k}")
        r = safe_div(f"tp{k}", f"t{k}")
        f = F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0))
        present = ((F.col(f"t{k}") + F.col(f"p{k}")) > 0).cast("double")
        out[k] = (p, r, f, present)
    return out


def binary_metrics(df: DataFrame, y: str = "y", yhat: str = "yhat", keys=()) -> DataFrame:
    """Accuracy, macro precision / recall / F1 over the classes seen in
    truth or prediction, and fault recall; 0 on zero division."""
    keys = list(keys)
    c = _counts(df, y, yhat, keys)
    pc = _per_class(c)
    npres = pc[0][3] + pc[1][3]
    macro = lambda i: (pc[0][i] * pc[0][3] + pc[1][i] * pc[1][3]) / npres
    return c.select(*keys,
                    safe_div(F.col("tp0") + F.col("tp1"), "n").alias("accuracy"),
                    macro(0).alias("precision_macro"), macro(1).alias("recall_macro"),
                    macro(2).alias("f1_macro"), pc[1][1].alias("recall_fault"))


def classification_report(df: DataFrame, y: str = "y", yhat: str = "yhat", keys=()) -> DataFrame:
    """Rows precision / recall / f1-score / support; columns Normal,
    Fault, accuracy, macro_avg, weighted_avg (layout of the reference CSV)."""
    keys = list(keys)
    c = _counts(df, y, yhat, keys)
    pc = _per_class(c)
    acc = safe_div(F.col("tp0") + F.col("tp1"), "n")
    npres = pc[0][3] + pc[1][3]
    rows = []
    for i, name in enumerate(["precision", "recall", "f1-score"]):
        macro = (pc[0][i] * pc[0][3] + pc[1][i] * pc[1][3]) / npres
        weighted = safe_div(pc[0][i] * F.col("t0") + pc[1][i] * F.col("t1"), "n")
        rows.append(F.struct(F.lit(name).alias("metric"), pc[0][i].alias("Normal"), pc[1][i].alias("Fault"),
                             acc.alias("accuracy"), macro.alias("macro_avg"), weighted.alias("weighted_avg")))
    rows.append(F.struct(F.lit("support").alias("metric"), F.col("t0").cast("double").alias("Normal"),
                         F.col("t1").cast("double").alias("Fault"), acc.alias("accuracy"),
                         F.col("n").cast("double").alias("macro_avg"), F.col("n").cast("double").alias("weighted_avg")))
    return c.select(*keys, F.inline(F.array(*rows)))


def score_points(df: DataFrame, y: str = "y", score: str = "score", keys=(), strategy="auto") -> DataFrame:
    """One row per (keys, distinct score): pos, neg, cumulative counts in
    descending score order, and the key's totals."""
    keys = list(keys)
    g = (df.where(F.col(score).isNotNull())
           .groupBy(*keys, F.col(score).alias("threshold"))
           .agg(F.sum(F.col(y).cast("long")).alias("pos"),
                (F.count(F.lit(1)) - F.sum(F.col(y).cast("long"))).alias("neg"))
           .withColumn("_desc", -F.col("threshold")))
    d = running_sums(g, keys, ["_desc"], ["pos", "neg"], strategy=strategy)
    return d.drop("_desc", "_seg", "_rn")


def roc_curve(df: DataFrame, y: str = "y", score: str = "score", keys=()) -> DataFrame:
    """J4 points: (threshold, fpr, tpr) for every distinct score, descending."""
    p = score_points(df, y, score, keys)
    return p.select(*keys, "threshold", F.try_divide(F.col("cum_neg"), F.col("tot_neg")).alias("fpr"),
                    F.try_divide(F.col("cum_pos"), F.col("tot_pos")).alias("tpr"))


def roc_curve_thin(df: DataFrame, y: str = "y", score: str = "score", keys=()) -> DataFrame:
    """J4 points without those on a straight line between their neighbours
    (the first and last of a key stay); the area is unchanged.

    The step before a point is its own count of each class, the step after it
    that of the next point: one carry in the opposite order, which crosses
    segment borders like any other."""
    keys = list(keys)
    p = score_points(df, y, score, keys)
    p = carry_prev(p, keys, ["threshold"], ["pos", "neg"], prefix="_next_")
    straight = F.col("pos").cast("decimal(19,0)") * F.col("_next_neg") == F.col("neg").cast("decimal(19,0)") * F.col("_next_pos")
    first = (F.col("cum_pos") == F.col("pos")) & (F.col("cum_neg") == F.col("neg"))
    p = p.where(first | F.col("_next_pos").isNull() | ~straight)
    return p.select(*keys, "threshold", F.try_divide(F.col("cum_neg"), F.col("tot_neg")).alias("fpr"),
                    F.try_divide(F.col("cum_pos"), F.col("tot_pos")).alias("tpr"))


def pr_curve(df: DataFrame, y: str = "y", score: str = "score", keys=()) -> DataFrame:
    """J5 points: (threshold, precision, recall)."""
    p = score_points(df, y, score, keys)
    return p.select(*keys, "threshold",
                    (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
                    F.try_divide(F.col("cum_pos"), F.col("tot_pos")).alias("recall"))


def auc_ap(df: DataFrame, y: str = "y", score: str = "score", keys=(), strategy="auto") -> DataFrame:
    """J4 AUC (trapezoid) and J5 AP (step-wise) per key; NULL when a class
    is missing."""
    keys = list(keys)
    p = score_points(df, y, score, keys, strategy)
    one_class = (F.max("tot_pos") == 0) | (F.max("tot_neg") == 0)
    # doubles before multiplying: the product of two counts can pass a bigint
    pairs = F.max("tot_pos").cast("double") * F.max("tot_neg").cast("double")
    auc = F.sum(F.col("neg").cast("double") * (F.col("cum_pos") - F.col("pos") / 2.0)) / pairs
    ap = F.sum(F.col("pos") * (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg")))) / F.max("tot_pos")
    return p.groupBy(*keys).agg(F.when(one_class, F.lit(None)).otherwise(auc).cast("double").alias("auc_roc"),
                                F.when(one_class, F.lit(None)).otherwise(ap).cast("double").alias("avg_precision"))


def calibration(df: DataFrame, y: str = "y", score: str = "score", n_bins: int = 10) -> DataFrame:
    """Quantile bins (edges at i / n_bins), bin = number of inner edges
    strictly below the score; mean prediction and observed rate of the
    non-empty bins."""
    qs = [i / n_bins for i in range(1, n_bins)]
    qv = quantiles(df.select(score), [score], qs)
    edges = [qv[(score, q)] for q in qs]
    if any(e is None for e in edges):
        return df.sparkSession.createDataFrame([], "bin int, mean_pred double, frac_pos double, n bigint")
    b = sum([(F.col(score) > F.lit(e)).cast("int") for e in edges[1:]], (F.col(score) > F.lit(edges[0])).cast("int"))
    return (df.where(F.col(score).isNotNull()).groupBy(b.alias("bin"))
              .agg(F.avg(score).alias("mean_pred"), F.avg(F.col(y).cast("double")).alias("frac_pos"),
                   F.count(F.lit(1)).alias("n")))


def model_metrics(df: DataFrame, y: str = "y", yhat: str = "yhat", score: str = "score", keys=("model",),
                  tag: str | None = None) -> DataFrame:
    """J2 + J4/J5 in one table per key (the reference's model_metrics)."""
    keys = list(keys)
    m = binary_metrics(df, y, yhat, keys).join(auc_ap(df, y, score, keys), keys, "left")
    if tag is not None:
        m = m.withColumn("tag", F.lit(tag))
    return m


def rank_models(metrics: DataFrame, keys=(), out: str = "rank") -> DataFrame:
    """Rank by macro-F1, then AUC, descending (ties: model name)."""
    w = Window.partitionBy(*keys).orderBy(F.col("f1_macro").desc_nulls_last(),
                                          F.col("auc_roc").desc_nulls_last(), F.col("model"))
    return metrics.withColumn(out, F.row_number().over(w))
