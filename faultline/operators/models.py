"""Models and explanation (I1-I13, J8, A8) on Spark ML.

Folds, class weights and scaling are columns of one DataFrame; every model
is a ``PipelineModel`` (a SQL scaling stage with the training statistics
as literals, a ``VectorAssembler`` and the classifier), so it can be saved,
reloaded and applied as one unit.  Differences to the reference's
scikit-learn models (kept deliberately, see README): Spark's MLP uses
sigmoid units and L-BFGS; the RBF SVM is approximated by random Fourier
features + ``LinearSVC`` with a Platt-scaled probability; an unlimited tree
depth maps to Spark's maximum of 30.
"""
from __future__ import annotations

import math
import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager, nullcontext
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, LinearSVC, LinearSVCModel, LogisticRegression,
                                       MultilayerPerceptronClassifier, RandomForestClassifier)
from pyspark.ml.common import _py2java
from pyspark.ml.feature import SQLTransformer, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import metrics as J
from . import solvers as V
from .linalg import moments
from ..plans.quantile import quantiles
from ..session import scratch_path, short_methods, shuffle_partitions

# Fixed values of the reference pipeline: parameter grids.
GRIDS = {
    "lr": [{"C": c} for c in [0.5, 1.0, 2.0, 5.0]],
    "svm": [{"C": c, "gamma": g} for c in [0.5, 1.0, 2.0] for g in ["scale", 0.01, 0.001]],
    "rf": [{"maxDepth": d} for d in [None, 8, 12, 16]],
    "mlp": [{"hidden": h} for h in [(64, 32), (128, 64), (128, 64, 32)]],
}
SPARK_MAX_DEPTH = 30
SIDE_BY_SIDE = 8
FEW_ROWS = 50_000           # more rows are fitted by passes of our own (solvers)
MANY_ROWS = 4_000_000       # of fits that run side by side, together


def fit_width(rows: int) -> int:
    """How many fits on ``rows`` rows run side by side: each keeps its rows in a form of its own."""
    return max(1, min(SIDE_BY_SIDE, MANY_ROWS // max(rows, 1)))


def side_by_side(spark, calls, width: int = SIDE_BY_SIDE) -> list:
    """Results, in order, of independent driver-side calls that each run
    their own jobs: at most ``width`` at a time, each thread in a scheduler
    pool of its own (fair shares where the cluster schedules fairly) and with
    the caller's job group and other local properties.  The first error is
    raised after the running calls have ended."""
    def run(i, call):
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"side-{i % width}")
        return call()

    with ThreadPoolExecutor(max_workers=width) as pool:
        waiting = [pool.submit(inheritable_thread_target(spark)(run), i, c) for i, c in enumerate(calls)]
        return [w.result() for w in waiting]


@dataclass(frozen=True)
class FitStats:
    """What every fit on the same rows needs: class sizes and feature moments."""
    classes: dict
    moments: dict

    @property
    def rows(self) -> int:
        return sum(self.classes.values())


def fit_stats(train: DataFrame, features, label: str) -> FitStats:
    """Two small aggregates, shared by all settings that are fitted on ``train``."""
    return FitStats(_class_sizes(train, label), moments(train, features))


def _class_sizes(df: DataFrame, label: str) -> dict:
    return {r[0]: r[1] for r in df.groupBy(label).count().collect()}     # one row per class


def class_weights(df: DataFrame, label: str, out: str = "weight", counts: dict | None = None) -> DataFrame:
    """Balanced weights n / (2 n_c) (one count per class, as literals)."""
    counts = _class_sizes(df, label) if counts is None else counts
    n, k = sum(counts.values()), len(counts)
    expr = None
    for c, nc in counts.items():
        w = F.lit(n / (k * nc))
        expr = F.when(F.col(label) == c, w) if expr is None else expr.when(F.col(label) == c, w)
    return df.withColumn(out, expr if expr is not None else F.lit(1.0))


def scaler_stage(st: dict, features) -> SQLTransformer:
    """Population z-scores with the moments ``st`` frozen into SQL."""
    parts = []
    for c in features:
        m, s = st[c]
        s = 1.0 if (s is None or s == 0 or math.isnan(s)) else s
        m = 0.0 if m is None else m
        parts.append(f"(`{c}` - {m!r}) / {s!r} AS `{c}__z`")
    return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")


def rff_stage(features, gamma: float, n_components: int = 100, seed: int = 42) -> SQLTransformer:
    """Random Fourier features for the RBF kernel exp(-gamma |x - y|^2)
    (Rahimi & Recht 2007) as a SQL projection of the scaled features."""
    W, b = V.fourier_map(len(features), gamma, n_components, seed)
    scale = math.sqrt(2.0 / n_components)
    parts = []
    for i in range(n_components):
        lin = " + ".join(f"{float(W[i, j])!r} * `{c}__z`" for j, c in enumerate(features))
        parts.append(f"{scale!r} * cos({lin} + {float(b[i])!r}) AS `rff_{i}`")
    return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")


def _estimator(kind: str, params: dict, n_features: int, label: str, weight: str | None, seed: int,
               n_rows: int, num_trees: int, max_iter: int):
    if kind == "lr":
        return LogisticRegression(featuresCol="features", labelCol=label, weightCol=weight or "",
                                  regParam=1.0 / (params.get("C", 1.0) * max(n_rows, 1)), elasticNetParam=0.0,
                                  standardization=False, maxIter=max_iter)
    if kind == "rf":
        d = params.get("maxDepth")
        return RandomForestClassifier(featuresCol="features", labelCol=label, weightCol=weight or "",
                                      numTrees=num_trees, maxDepth=SPARK_MAX_DEPTH if d is None else d, seed=seed)
    if kind == "mlp":
        layers = [n_features, *params.get("hidden", (64, 32)), 2]
        return MultilayerPerceptronClassifier(featuresCol="features", labelCol=label, layers=layers,
                                              blockSize=256, maxIter=max_iter, seed=seed)
    if kind == "tree":
        return DecisionTreeClassifier(featuresCol="features", labelCol=label, weightCol=weight or "",
                                      maxDepth=params.get("maxDepth", 3), seed=seed)
    raise ValueError(kind)


def fit_sample(train: DataFrame, label: str, rows: int | None, key: str = "row_id", seed: int = 42) -> DataFrame:
    """At most ``rows`` training rows, drawn by hash within each class; all without a bound."""
    from .splits import sample_stratified
    if rows is None:
        return train
    # A bounded sample in few partitions: iterations cost per-task overhead, not data.  Only the drawn rows are
    # exchanged, and put back in the table's order; the scan that draws them keeps its own tasks.
    drawn = sample_stratified(train, label, rows, key, seed).withColumn("_at", F.monotonically_increasing_id())
    return drawn.repartition(max(1, rows // 10_000)).sortWithinPartitions("_at").drop("_at")


def fit(train: DataFrame, features, label: str = "label_fault", kind: str = "rf", params: dict | None = None,
        weighted: bool = True, seed: int = 42, num_trees: int = 20, max_iter: int = 100,
        rff_components: int = 100, stats: FitStats | None = None) -> PipelineModel:
    """Scale -> (RFF) -> assemble -> classifier, as one PipelineModel.
    The class weights are those of the rows it is fitted on; ``stats`` of
    these rows, if known, save their aggregates."""
    params = dict(params or {})
    features = list(features)
    weight = "_weight" if weighted else None
    stats = stats or fit_stats(train, features, label)
    n = stats.rows
    if kind in ("svm", "mlp") and n > FEW_ROWS:
        return _fit_in_passes(train, features, label, kind, [params], weighted, seed, max_iter, rff_components, stats)[0]
    if weighted:
        train = class_weights(train, label, weight, stats.classes)
    if kind == "tree":          # scale-invariant: keep raw units so rules read as the data
        stages, cols = [], list(features)
    else:
        stages = [scaler_stage(stats.moments, features)]
        cols = [f"{c}__z" for c in features]
    if kind == "svm":
        stages.append(rff_stage(features, _gamma(params, features), rff_components, seed))
        cols = [f"rff_{i}" for i in range(rff_components)]
    stages.append(VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="keep"))
    rows = PipelineModel(stages).transform(train).select(label, *([weight] if weighted else []), "features")
    if kind != "svm":
        model = _estimator(kind, params, len(cols), label, weight, seed, n, num_trees, max_iter).fit(rows)
        return PipelineModel([*stages, model])
    short_methods(train.sparkSession)
    svc = LinearSVC(featuresCol="features", labelCol=label, weightCol=weight or "",
                    regParam=1.0 / (params.get("C", 1.0) * max(n, 1)), maxIter=max_iter,
                    standardization=False,      # else C would not be the kernel machine's C
                    rawPredictionCol="svm_raw", predictionCol="svm_pred")
    margin, platt, final = _platt_stages(label, max_iter)
    # of few rows the Fourier features are kept: four passes read them
    with cached(rows) if n <= FEW_ROWS else nullcontext(rows) as rows:
        svc = svc.fit(rows)
        platt = platt.fit(margin.transform(svc.transform(rows)))
    return PipelineModel([*stages, svc, margin, platt, final])


def _gamma(params: dict, features) -> float:
    g = params.get("gamma", "scale")
    return 1.0 / len(features) if g == "scale" else float(g)       # scaled features: variance 1


def _platt_stages(label: str, max_iter: int):
    """Margin of the SVM, its Platt fit, and the outcome: class from the SVM decision, probability from the Platt fit."""
    return (VectorSlicer(inputCol="svm_raw", outputCol="platt_features", indices=[1]),
            LogisticRegression(featuresCol="platt_features", labelCol=label, maxIter=max_iter, predictionCol="platt_pred"),
            SQLTransformer(statement="SELECT *, svm_pred AS prediction FROM __THIS__"))


def _fit_in_passes(train: DataFrame, features, label: str, kind: str, settings, weighted: bool, seed: int, max_iter: int,
                   rff_components: int, stats: FitStats) -> list:
    """Models of several settings of the kernel machine or the network on many rows: the scaled rows are kept once, and
    each step of all settings is one pass over them (:mod:`solvers`)."""
    spark, n, features = train.sparkSession, len(features), list(features)
    short_methods(spark)
    scaler, cols = scaler_stage(stats.moments, features), [f"{c}__z" for c in features]
    rows = scaler.transform(class_weights(train, label, "_weight", stats.classes) if weighted
                            else train.withColumn("_weight", F.lit(1.0)))
    z = [F.col(c).cast("double").alias(c) for c in cols] + [F.col(label).cast("double").alias(label)]
    if kind == "mlp":
        layers = [[n, *g.get("hidden", (64, 32)), 2] for g in settings]
        two = spark.createDataFrame([(float(i), Vectors.dense([float(i)] * n)) for i in (0, 1)], [label, "features"])

        def network(i, start=None):     # Spark's own start for the seed, or a model with given weights: no step is made
            c = _estimator(kind, settings[i], n, label, None, seed, 2, 0, 0)
            return (c if start is None else c.setInitialWeights(Vectors.dense(start))).setMaxIter(0).fit(two)

        starts = [network(i).weights.toArray() for i in range(len(settings))]
        with V.packed(rows.select(*z)) as blocks:
            found = V.fit_networks(blocks, n, layers, starts, max_iter)
        assembler = VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="keep")
        return [PipelineModel([scaler, assembler, network(i, w)]) for i, w in enumerate(found)]

    gammas = sorted({_gamma(g, features) for g in settings})
    maps = [V.fourier_map(n, g, rff_components, seed) for g in gammas]
    which = [gammas.index(_gamma(g, features)) for g in settings]
    with V.packed(rows.select(*z, F.col("_weight"))) as blocks:
        found = V.fit_hinges(blocks, n, maps, [(k, 1.0 / (g.get("C", 1.0) * stats.rows)) for k, g in zip(which, settings, strict=True)],
                             max_iter)
    rffs = [f"rff_{i}" for i in range(rff_components)]
    assembler = VectorAssembler(inputCols=rffs, outputCol="features", handleInvalid="keep")
    out = []
    for k, (coefficients, intercept) in zip(which, found, strict=True):
        sc = spark.sparkContext
        svc = LinearSVCModel(sc._jvm.org.apache.spark.ml.classification.LinearSVCModel(
            f"LinearSVC_{uuid.uuid4().hex[:12]}", _py2java(sc, Vectors.dense(coefficients)), intercept))
        svc._set(featuresCol="features", rawPredictionCol="svm_raw", predictionCol="svm_pred")
        margin, platt, final = _platt_stages(label, max_iter)
        m = V.margins(rows.select(*z), n, *maps[k], coefficients, intercept, label)
        platt = platt.fit(VectorAssembler(inputCols=["margin"], outputCol="platt_features", handleInvalid="keep").transform(m))
        out.append(PipelineModel([scaler, rff_stage(features, gammas[k], rff_components, seed), assembler, svc, margin, platt, final]))
    return out


def score_rows(model: PipelineModel, df: DataFrame, keep=()) -> DataFrame:
    """I8: predicted class and P(fault)."""
    out = model.transform(df)
    return out.select(*keep, F.col("prediction").cast("int").alias("yhat"),
                      vector_to_array("probability")[1].alias("p_fault"))


def rate_settings(models, val: DataFrame, label: str = "label_fault", scorer: str = "f1_macro") -> list:
    """Validation score of each model: all predictions in one frame, one grouped metric."""
    parts = [score_rows(m, val, keep=[label]).withColumn("_setting", F.lit(i)) for i, m in enumerate(models)]
    return _rate(reduce(DataFrame.unionByName, parts), len(models), label, scorer)


def _rate(scored: DataFrame, n: int, label: str, scorer: str) -> list:
    """Score of each of ``n`` settings from predictions with their ``_setting``."""
    if scorer == "f1_macro":
        table = J.binary_metrics(scored, label, "yhat", keys=["_setting"]).select("_setting", F.col("f1_macro").alias("v"))
    else:
        # every setting has the whole fold's rows, so none is measured for hot keys: that would score them twice
        table = J.auc_ap(scored, label, "p_fault", keys=["_setting"], strategy="ranged").select(
            "_setting", F.col("avg_precision").alias("v"))
    got = {r["_setting"]: r["v"] for r in table.collect()}         # one row per setting
    return [got.get(i) or 0.0 for i in range(n)]


def rate_depths(model: PipelineModel, val: DataFrame, depths, label: str = "label_fault", scorer: str = "f1_macro") -> list:
    """Validation score of the forest at each depth limit, from the deepest one, rows scored once.

    Trees grow level by level, and a node's split depends on its rows and
    the levels above it: a forest with a lower limit is the deeper one cut at
    that level, its cut nodes then merged where both leaves predict alike, as
    a fit does.  (Where a level has too many nodes for one pass of the fit,
    Spark draws the candidate features of its nodes in another order.)"""
    prepared, cut = PipelineModel(model.stages[:-1]), []
    nodes = node_table(model.stages[-1], val.sparkSession).orderBy("tree", "id").toPandas()      # bounded by the model
    for _, t in nodes.groupby("tree"):
        left, right, pred = (t[c].to_numpy() for c in ("left", "right", "prediction"))
        levels, at = [], np.array([0])
        while len(at):
            levels.append(at)
            inner = at[left[at] >= 0]
            at = np.concatenate([left[inner], right[inner]])
        ends = []
        for d in depths:
            leaf = left < 0
            for k, at in reversed(list(enumerate(levels))):
                inner = at[left[at] >= 0]
                a, b = left[inner], right[inner]
                leaf[inner] = (k >= d) | (leaf[a] & leaf[b] & (pred[a] == pred[b]))
            end, done = np.arange(len(left)), leaf.copy()          # the cut tree's leaf at or above each node
            for at in levels:
                inner = at[left[at] >= 0]
                for child in (left[inner], right[inner]):
                    end[child] = np.where(done[inner], end[inner], child)
                    done[child] |= done[inner]
            ends.append(end)
        stats = np.array([[s[0], s[1] if len(s) > 1 else 0.0] for s in t["stats"]], float)
        total = stats.sum(axis=1, keepdims=True)
        share = np.divide(stats, total, out=np.zeros_like(stats), where=total != 0)
        cut.append((left, right, t["feature"].to_numpy(), t["threshold"].to_numpy(float), [share[e] for e in ends]))

    def run(batches):
        for b in batches:
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            raw = np.zeros((len(depths), len(x), 2))
            for left, right, feat, threshold, shares in cut:
                at, rows = np.zeros(len(x), np.int64), np.arange(len(x))
                while len(rows):
                    rows = rows[left[at[rows]] >= 0]
                    k = at[rows]
                    at[rows] = np.where(x[rows, feat[k]] <= threshold[k], left[k], right[k])
                for r, share in zip(raw, shares, strict=True):
                    r += share[at]
            for i, r in enumerate(raw):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), i, np.int32)), b.column(0), pa.array((r[:, 1] > r[:, 0]).astype(np.int32)),
                     pa.array(r[:, 1] / r.sum(axis=1))], names=["_setting", label, "yhat", "p_fault"])

    rows = prepared.transform(val).select(label, vector_to_array("features").alias("x"))
    kind = val.schema[label].dataType.simpleString()
    return _rate(rows.mapInArrow(run, f"_setting int, `{label}` {kind}, yhat int, p_fault double"), len(depths), label, scorer)


def fit_settings(sample: DataFrame, features, settings, label: str = "label_fault", stats: FitStats | None = None,
                 width: int = SIDE_BY_SIDE, **kw) -> list:
    """Models of several (kind, setting) on the same rows, fitted side by
    side; of many rows, kernel machines and networks in passes they share."""
    stats = stats or fit_stats(sample, features, label)
    shared = [k for k in ("svm", "mlp") if stats.rows > FEW_ROWS and any(k == kind for kind, _ in settings)]
    alone = [i for i, (k, _) in enumerate(settings) if k not in shared]
    calls = [lambda i=i: {i: fit(sample, features, label, *settings[i], stats=stats, **kw)} for i in alone]

    def together(kind):
        mine = [i for i, (k, _) in enumerate(settings) if k == kind]
        o = {"weighted": True, "seed": 42, "max_iter": 100, "rff_components": 100, **kw}
        return dict(zip(mine, _fit_in_passes(sample, features, label, kind, [dict(settings[i][1] or {}) for i in mine], o["weighted"],
                                             o["seed"], o["max_iter"], o["rff_components"], stats), strict=True))

    calls += [lambda k=k: together(k) for k in shared]
    got = reduce(dict.__or__, side_by_side(sample.sparkSession, calls, min(width, fit_width(stats.rows))), {})
    return [got[i] for i in range(len(settings))]


def best_setting(grid, ratings) -> int:
    """Position of the best rating; of equals the first in the grid."""
    return max(range(len(grid)), key=lambda i: (ratings[i], -i))


@contextmanager
def cached(df: DataFrame):
    """``df`` cached for the block.  One that its owner has cached stays cached."""
    level = df.storageLevel
    own = not (level.useMemory or level.useDisk)
    try:
        yield df.cache() if own else df
    finally:
        if own:
            df.unpersist()


def _held(df: DataFrame, fit_rows: int | None):
    """A drawn sample is cached for its fits; whole folds are read from where their owner holds them."""
    return nullcontext(df) if fit_rows is None else cached(df)


def rated_grid(sample: DataFrame, val: DataFrame, features, kind: str, grid, label: str, scorer: str, stats: FitStats | None = None,
               width: int = SIDE_BY_SIDE, **kw) -> list:
    """Validation score of every setting of the grid, fitted on ``sample``.  Forests that differ in their depth limit
    alone are cuts of the deepest one, which is fitted once (:func:`rate_depths`)."""
    if kind == "rf" and all(set(g) <= {"maxDepth"} for g in grid):
        depths = [SPARK_MAX_DEPTH if g.get("maxDepth") is None else g["maxDepth"] for g in grid]
        deepest = fit(sample, features, label, kind, {"maxDepth": max(depths)}, stats=stats, **kw)
        return rate_depths(deepest, val, depths, label, scorer)
    return rate_settings(fit_settings(sample, features, [(kind, g) for g in grid], label, stats, width, **kw), val, label, scorer)


def grid_search(train: DataFrame, val: DataFrame, features, kind: str, grid=None, label: str = "label_fault",
                scorer: str = "f1_macro", fit_rows: int | None = None, **kw):
    """Every setting is fitted on the training fold, side by side, and
    rated on the whole validation fold (macro-F1 or AP); the best one -- of
    equals the first in the grid -- is fitted again on both folds.
    ``fit_rows`` bounds the rows of each fit.  Returns (model, setting, score)."""
    grid = list(GRIDS[kind] if grid is None else grid)
    with _held(fit_sample(train, label, fit_rows), fit_rows) as sample:
        ratings = rated_grid(sample, val, features, kind, grid, label, scorer, **kw)
    chosen = best_setting(grid, ratings)
    with _held(fit_sample(train.unionByName(val), label, fit_rows), fit_rows) as both:
        final = fit(both, features, label, kind, grid[chosen], **kw)
    return final, grid[chosen], ratings[chosen]


def regime_suite(regimes: dict, label: str = "label_fault", fit_rows: int | None = None, **kw) -> list[dict]:
    """The four model kinds under several regimes.

    ``regimes``: tag -> (rows with a ``fold`` column, features).  Each
    regime's rows are cached once, and fit samples, if ``fit_rows`` bounds
    them, are drawn once for all kinds.  Of few rows all regimes are worked
    on side by side, so the time is that of the longest chain; of many, the
    regimes of one split at a time, so storage holds one split and the rows
    of one or a few fits.  One dict per (tag, model)."""
    spark = next(iter(regimes.values()))[0].sparkSession
    splits = {}
    for tag, (df, features) in regimes.items():        # regimes may share their split
        splits.setdefault(id(df), {})[tag] = (df, features)
    rows = max(side_by_side(spark, [next(iter(s.values()))[0].count for s in splits.values()]))
    groups = [regimes] if rows <= FEW_ROWS * SIDE_BY_SIDE * 2 else list(splits.values())
    return [r for g in groups for r in _suite(spark, g, label, fit_rows, min(SIDE_BY_SIDE, fit_width(min(rows, fit_rows or rows))), **kw)]


def _suite(spark, regimes: dict, label: str, fit_rows: int | None, width: int, **kw) -> list[dict]:
    def folds(df):
        d = df.cache()
        f = {x: d.where(F.col("fold") == x) for x in ("train", "val", "test")}
        parts = [fit_sample(f["train"], label, fit_rows), fit_sample(f["train"].unionByName(f["val"]), label, fit_rows)]
        if fit_rows is not None:
            parts = [p.cache() for p in parts]
        n, faults = f["test"].agg(F.count("*"), F.sum(label).cast("long")).first()
        return d, f, parts, int(n), int(faults or 0)

    splits = {id(df): df for df, _ in regimes.values()}
    distinct = dict(zip(splits, side_by_side(spark, [lambda d=d: folds(d) for d in splits.values()]), strict=True))
    held = {tag: distinct[id(df)] for tag, (df, _) in regimes.items()}
    stats = {(tag, i): None for tag in regimes for i in (0, 1)}
    got = side_by_side(spark, [lambda t=t, i=i: fit_stats(held[t][2][i], regimes[t][1], label) for t, i in stats])
    stats = dict(zip(stats, got, strict=True))
    searches = [(t, k) for k in sorted(GRIDS, key=lambda k: -len(GRIDS[k])) for t in regimes]       # the longest first
    got = side_by_side(spark, [lambda t=t, k=k: rated_grid(held[t][2][0], held[t][1]["val"], regimes[t][1], k, GRIDS[k], label, "f1_macro",
                                                           stats[t, 0], 1, **kw) for t, k in searches], width)
    rated = dict(zip(searches, got, strict=True))
    chosen = {(t, k): best_setting(GRIDS[k], rated[t, k]) for t in regimes for k in GRIDS}
    final = dict(zip(chosen, side_by_side(spark, [
        lambda t=t, k=k, i=i: fit(held[t][2][1], regimes[t][1], label, k, GRIDS[k][i], stats=stats[t, 1], **kw)
        for (t, k), i in chosen.items()], width), strict=True))

    def test_metrics(tag):
        scored = [score_rows(final[tag, k], held[tag][1]["test"], keep=[label]).withColumn("model", F.lit(k))
                  for k in GRIDS]
        s = reduce(DataFrame.unionByName, scored).cache()      # read by both tables below
        out = {r["model"]: r.asDict() for r in J.binary_metrics(s, label, "yhat", keys=["model"]).collect()}
        for r in J.auc_ap(s, label, "p_fault", keys=["model"]).collect():
            out[r["model"]] |= r.asDict()
        s.unpersist()
        return out

    tested = dict(zip(regimes, side_by_side(spark, [lambda t=t: test_metrics(t) for t in regimes], width), strict=True))
    for d, _, parts, _, _ in distinct.values():
        for x in (*parts, d):
            x.unpersist()
    return [{**tested[t].get(k, {"model": k}), "tag": t, "best_params": str(GRIDS[k][i]),
             "val_f1_macro": float(rated[t, k][i]), "n_test": held[t][3], "n_test_faults": held[t][4]}
            for (t, k), i in chosen.items()]


def impurity_importance(model: PipelineModel, features) -> list:
    """(feature, importance) sorted descending (sums to 1)."""
    imp = model.stages[-1].featureImportances.toArray()
    return sorted(zip(features, map(float, imp)), key=lambda t: -t[1])


def node_table(stage, spark=None) -> DataFrame:
    """The nodes of a fitted tree or forest, one row each, as Spark's own
    writer stores them: tree, id, left, right (-1 at a leaf), feature,
    threshold, prediction, stats (weight per class)."""
    from pyspark.sql import SparkSession
    spark = spark or SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()     # none is active in a new thread
    path = scratch_path(spark, f"faultline-nodes-{uuid.uuid4().hex[:12]}")
    stage.write().overwrite().save(path)
    t = spark.read.parquet(path + "/data")
    tree, n = (F.col("treeID"), "nodeData.") if "nodeData" in t.columns else (F.lit(0), "")
    return t.select(tree.alias("tree"), F.col(n + "id").alias("id"), F.col(n + "leftChild").alias("left"),
                    F.col(n + "rightChild").alias("right"), F.col(n + "split.featureIndex").alias("feature"),
                    F.get(n + "split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
                    F.col(n + "prediction").alias("prediction"), F.col(n + "impurityStats").alias("stats"))


def tree_rule_table(stage, features) -> DataFrame:
    """One row per leaf (tree, path, rule, prediction): the stored nodes
    joined level by level from the root, as often as the trees are deep.
    ``path`` spells the turns (L, R); a tree of one leaf has an empty rule."""
    nodes = node_table(stage)
    depth = max(t.depth for t in stage.trees) if hasattr(stage, "trees") else stage.depth
    name = F.element_at(F.array(*[F.lit(c) for c in features]), F.col("feature") + 1)
    front = nodes.where("id = 0").withColumns({"path": F.lit(""), "rule": F.lit("")})
    leaves = front.where("left < 0")
    for _ in range(depth):
        said = lambda op: F.concat_ws(" AND ", F.nullif("rule", F.lit("")), F.concat_ws(" ", name, F.lit(op),
                                                                                       F.col("threshold").cast("string")))
        turns = F.array(F.struct(F.col("left").alias("id"), F.concat("path", F.lit("L")).alias("path"), said("<=").alias("rule")),
                        F.struct(F.col("right").alias("id"), F.concat("path", F.lit("R")).alias("path"), said(">").alias("rule")))
        below = front.where("left >= 0").select("tree", F.inline(turns))
        front = nodes.join(below, ["tree", "id"])
        leaves = leaves.unionByName(front.where("left < 0"))
    return leaves.select("tree", "path", "rule", F.col("prediction").cast("int").alias("prediction"))


def tree_rules(model: PipelineModel, features) -> list:
    """(rule, prediction) of a fitted tree's leaves, left before right (bounded by the tree)."""
    return [(r["rule"], r["prediction"]) for r in tree_rule_table(model.stages[-1], features).orderBy("path").collect()]


@contextmanager
def _dropped_shuffles(spark):
    """Shuffle files go when their query ends, not when the driver next collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _copy_place(copy: int, seed: int, row_id: str, buckets: int):
    """A row's place in the random order of a copy, and the bucket of that place: the places are 64-bit hashes, so
    equal ranges of them hold about equally many rows and need no sampling."""
    place = F.xxhash64(F.col(row_id), F.lit(copy), F.lit(seed))
    share = (place.cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64)
    return place, F.least(F.floor(share * buckets), F.lit(buckets - 1)).cast("int")


def _bucket_ends(df: DataFrame, features, copies, seed: int, row_id: str, buckets: int) -> dict:
    """{(copy, bucket): the permuted feature's value on the last row before the bucket}, that of the last row of all
    before the first one.  The last place of each bucket, then the value there (of rows with one id the greatest,
    NULLs first, as the copies are sorted): two aggregates over all copies, at most copies x buckets rows."""
    parts = []
    for i, (j, _) in enumerate(copies):
        place, bucket = _copy_place(i, seed, row_id, buckets)
        parts.append(F.struct(F.lit(i).alias("copy"), bucket.alias("b"), place.alias("ph"),
                              F.col(features[j]).cast("double").alias("v")))
    st = df.select(F.inline(F.array(*parts)))
    last = st.groupBy("copy", "b").agg(F.max("ph").alias("ph"))
    got = st.join(F.broadcast(last), ["copy", "b", "ph"]).groupBy("copy", "b").agg(F.max("v").alias("v")).collect()
    held = {(r["copy"], r["b"]): r["v"] for r in got}
    before = {}
    for i in range(len(copies)):
        full = [b for b in range(buckets) if (i, b) in held]
        for b, prev in zip(full, full[-1:] + full[:-1], strict=True):
            before[i, b] = held[i, prev]
    return before


def _permuted_copy(df: DataFrame, features, copy: int, j: int, before: dict, seed: int, row_id: str, buckets: int,
                   carry) -> DataFrame:
    """One copy of the columns ``carry`` and ``features`` of ``df`` with feature ``j`` permuted."""
    name = features[j]
    place, bucket = _copy_place(copy, seed, row_id, buckets)
    st = df.select(*carry, *[F.col(c).cast("double").alias(c) if c == name else F.col(c) for c in features],
                   place.alias("_ph"), bucket.alias("_b"))
    w = Window.partitionBy("_b").orderBy("_ph", F.col(name).asc_nulls_first())
    prev = F.lag(F.struct(F.col(name).alias("v"))).over(w)          # a struct: a NULL value is not a missing row
    ends = F.array(*[F.lit(before.get((copy, b))).cast("double") for b in range(buckets)])
    st = st.withColumn("_prev", prev)
    new = F.when(F.col("_prev").isNull(), F.get(ends, F.col("_b"))).otherwise(F.col("_prev")["v"])
    return st.withColumn(name, new).drop("_ph", "_b", "_prev") \
             .withColumns({"copy": F.lit(copy), "fj": F.lit(j)})


def _copies_of(df: DataFrame, features, repeats: int, seed: int, row_id: str, carry) -> list:
    """One copy of ``df`` per (feature, repeat) in which that feature is
    permuted: rows are put in a random order (hash of id and copy) and each
    row takes the feature value of its predecessor in that order, the first
    row that of the last -- a random cyclic permutation.  Each copy is one
    exchange of the carried columns by ranges of the hash; nothing is stored."""
    copies = [(j, r) for j in range(len(features)) for r in range(repeats)]
    buckets = 4 * shuffle_partitions(df.sparkSession)
    before = _bucket_ends(df, features, copies, seed, row_id, buckets)
    return [_permuted_copy(df, features, i, j, before, seed, row_id, buckets, carry) for i, (j, _) in enumerate(copies)]


def _permuted_copies(df: DataFrame, features, repeats: int, seed: int, row_id: str, label: str) -> DataFrame:
    """All copies of :func:`_copies_of` in one frame, with id and label."""
    return reduce(DataFrame.unionByName, _copies_of(df, features, repeats, seed, row_id, [row_id, label]))


def permutation_importance(model: PipelineModel, df: DataFrame, features, label: str = "label_fault",
                           repeats: int = 10, scoring: str = "accuracy", seed: int = 42,
                           row_id: str = "row_id") -> DataFrame:
    """Score drop when one feature is permuted, mean and std over
    repeats.  Copies are made and scored one after the other, each over all
    rows, and a copy's exchange is dropped before the next one: the disk holds
    one copy, whatever the number of features and repeats."""
    spark, features = df.sparkSession, list(features)

    def rated(rows):
        if scoring == "accuracy":
            return rows.agg(F.avg((F.col("yhat") == F.col(label)).cast("double"))).first()[0]
        return J.auc_ap(rows, label, "p_fault").first()["avg_precision"]

    with _dropped_shuffles(spark):
        base = rated(score_rows(model, df, keep=[label]))
        got = [(i // repeats, rated(score_rows(model, c, keep=[label])))
               for i, c in enumerate(_copies_of(df, features, repeats, seed, row_id, [label]))]
    names = F.array(*[F.lit(c) for c in features])
    per = spark.createDataFrame(got, "fj int, m double")            # one row per copy
    return (per.withColumn("drop", F.lit(base) - F.col("m")).groupBy("fj")
               .agg(F.avg("drop").alias("importance_mean"), F.stddev_pop("drop").alias("importance_std"))
               .select(names[F.col("fj")].alias("feature"), "importance_mean", "importance_std"))


def select_topk(df: DataFrame, features, label: str = "label_fault", k: int = 4, cap: int = 6000,
                seed: int = 42, repeats: int = 8, num_trees: int = 20, row_id: str = "row_id") -> list:
    """A forest on a balanced sample (at most ``cap`` rows, a bound on
    the fit), permutation importance on all rows outside it, first k."""
    from .splits import balanced_subsample
    small = balanced_subsample(df, label, cap, key=row_id, seed=seed).cache()
    m = fit(small, features, label, "rf", {"maxDepth": None}, num_trees=num_trees, seed=seed)
    rest = df.select(row_id, *features, label).join(small.select(row_id), row_id, "left_anti").cache()    # read by every copy
    pi = permutation_importance(m, rest, features, label, repeats=repeats, seed=seed, row_id=row_id)
    top = [r["feature"] for r in pi.orderBy(F.desc("importance_mean"), "feature").limit(k).collect()]
    for d in (rest, small):
        d.unpersist()
    return top


def partial_dependence(model: PipelineModel, background: DataFrame, feature: str, n_grid: int = 20,
                       q_lo: float = 0.01, q_hi: float = 0.99) -> DataFrame:
    """Mean P(fault) with ``feature`` fixed at each of ``n_grid``
    points on [P1, P99] of the background.

    For a tree or forest every row's prediction is a step function of the
    feature, so one pass over the rows gives all points
    (:func:`_tree_dependence`).  Other models score a copy of each row per
    grid point (bounded by ``n_grid``)."""
    qv = quantiles(background, [feature], [q_lo, q_hi])
    lo, hi = qv[(feature, q_lo)], qv[(feature, q_hi)]
    grid = [float(x) for x in np.linspace(lo, hi, n_grid)]
    if hasattr(model.stages[-1], "featureImportances"):
        return _tree_dependence(model, background, feature, grid)
    rep = background.select("*", F.explode(F.array(*[F.lit(v) for v in grid])).alias("grid_value"))
    rep = rep.withColumn(feature, F.col("grid_value"))
    s = score_rows(model, rep, keep=["grid_value"])
    return s.groupBy("grid_value").agg(F.avg("p_fault").alias("mean_p_fault"))


def _tree_dependence(model: PipelineModel, background: DataFrame, feature: str, grid: list) -> DataFrame:
    """Partial dependence of a tree model, rows read once and never copied.

    A batch of rows walks each tree together with the range of grid points
    that still lead to the node: a split on another feature divides the rows,
    a split on this one the range.  At a leaf the rows' share of the class is
    added to the range.  Only the node table (bounded by the model) travels;
    each task returns one total per grid point."""
    spark = background.sparkSession
    stage, assembler = model.stages[-1], model.stages[-2]
    prepared = PipelineModel(model.stages[:-1])
    inputs = assembler.getInputCols()
    at = next(i for i, c in enumerate(inputs) if c in (feature, f"{feature}__z"))
    raw = [c.removesuffix("__z") for c in inputs]
    # the grid in the model's own units, by the model's own stages
    points = prepared.transform(spark.createDataFrame([(i, *[v] * len(raw)) for i, v in enumerate(grid)],
                                                      "i int, " + ", ".join(f"`{c}` double" for c in raw)))
    z = np.array([r["x"][at] for r in points.select("i", vector_to_array("features").alias("x")).orderBy("i").collect()])
    nodes = node_table(stage, spark).orderBy("tree", "id").toPandas()
    trees = []
    for _, t in nodes.groupby("tree"):
        stats = [np.asarray(s, float) for s in t["stats"]]
        share = [s[1] / s.sum() if len(s) > 1 and s.sum() else 0.0 for s in stats]
        trees.append((t["left"].to_numpy(), t["right"].to_numpy(), t["feature"].to_numpy(),
                      t["threshold"].to_numpy(float), np.array(share)))

    def run(batches):
        total, n = np.zeros(len(z)), 0
        for b in batches:
            x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            n += len(x)
            for left, right, feat, threshold, share in trees:
                walk = [(0, np.arange(len(x)), 0, len(z))]
                while walk:
                    k, rows, a, c = walk.pop()
                    if not len(rows) or a >= c:
                        continue
                    if left[k] < 0:
                        total[a:c] += len(rows) * share[k]
                    elif feat[k] == at:
                        g = int(np.searchsorted(z, threshold[k], side="right"))
                        walk += [(left[k], rows, a, min(c, g)), (right[k], rows, max(a, g), c)]
                    else:
                        goes = x[rows, feat[k]] <= threshold[k]
                        walk += [(left[k], rows[goes], a, c), (right[k], rows[~goes], a, c)]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(z), dtype=np.int32)), pa.array(total),
                                          pa.array(np.full(len(z), n, np.int64))], names=["i", "total", "n"])

    x = prepared.transform(background).select(vector_to_array("features").alias("x"))
    sums = x.mapInArrow(run, "i int, total double, n bigint").groupBy("i").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    value = F.element_at(F.array(*[F.lit(v) for v in grid]), F.col("i") + 1)
    return sums.select(value.alias("grid_value"), (F.col("total") / (F.col("n") * len(trees))).alias("mean_p_fault"))


def save_model(model: PipelineModel, path: str) -> None:
    """A8."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
