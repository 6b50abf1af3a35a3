"""Features and linear algebra (H1-H8).

Tall-skinny: every statistic is one distributed aggregate whose size is
bounded by the number of features (means, population standard deviations,
the d x d correlation matrix, per-class sums); only those small matrices
reach the driver, where the eigen-decomposition runs (as Spark ML's own
RowMatrix PCA does).  Projection back onto rows is a narrow projection
with literal loadings.

Silhouette: the squared-Euclidean form decomposes into per-class sums, so
it is exact over all rows in O(n) (``silhouette_sq``).  The Euclidean form
needs every pairwise distance and is not built.
"""
from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def moments(df: DataFrame, cols) -> dict:
    r = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
               *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    return {c: (r[f"m{i}"], r[f"s{i}"]) for i, c in enumerate(cols)}


def standardize(df: DataFrame, cols, stats: dict | None = None, suffix: str = "") -> DataFrame:
    """H1: (x - mean) / population std; a zero (or undefined) std scales by 1."""
    stats = stats or moments(df, cols)
    out = {}
    for c in cols:
        m, s = stats[c]
        s = 1.0 if (s is None or s == 0 or math.isnan(s)) else s
        out[c + suffix] = (F.col(c) - F.lit(m)) / F.lit(s)
    return df.withColumns(out)


def correlation_matrix(df: DataFrame, cols) -> np.ndarray:
    """Pearson correlations in one aggregate (d(d-1)/2 expressions)."""
    d = len(cols)
    pairs = [(i, j) for i in range(d) for j in range(i + 1, d)]
    if not pairs:
        return np.ones((1, 1))
    r = df.agg(*[F.corr(cols[i], cols[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    m = np.eye(d)
    for i, j in pairs:
        v = r[f"c{i}_{j}"]
        m[i, j] = m[j, i] = 0.0 if v is None or math.isnan(v) else v
    return m


def pca(df: DataFrame, cols, k: int = 2):
    """PCA of the standardised columns: (variance ratios of all components,
    loadings d x k with the largest absolute entry of each column positive)."""
    cols = list(cols)
    clean = df.dropna(subset=cols)
    c = correlation_matrix(clean, cols)
    vals, vecs = np.linalg.eigh(c)
    order = np.argsort(vals)[::-1]
    vals, vecs = np.clip(vals[order], 0.0, None), vecs[:, order]
    for j in range(vecs.shape[1]):
        if vecs[np.argmax(np.abs(vecs[:, j])), j] < 0:
            vecs[:, j] = -vecs[:, j]
    ratios = vals / vals.sum()
    return ratios, vecs[:, :k]


def pca_variance(df: DataFrame, settings: dict) -> DataFrame:
    """H2: PC1, PC2 variance ratio and their sum per feature setting."""
    rows = []
    for name, cols in settings.items():
        ratios, _ = pca(df, cols)
        n = df.dropna(subset=list(cols)).count()
        rows.append((name, float(ratios[0]), float(ratios[1]) if len(ratios) > 1 else 0.0,
                     float(ratios[:2].sum()), int(n)))
    return df.sparkSession.createDataFrame(rows, "setting string, pc1_var double, pc2_var double, "
                                                 "pc12_var_sum double, n_samples bigint")


def pca_scree(df: DataFrame, cols) -> DataFrame:
    """H3: every component's variance ratio and the cumulative sum."""
    ratios, _ = pca(df, cols, k=len(cols))
    cum = np.cumsum(ratios)
    rows = [(i + 1, float(r), float(c)) for i, (r, c) in enumerate(zip(ratios, cum))]
    return df.sparkSession.createDataFrame(rows, "component int, ratio double, cumulative double")


def pca_loadings(df: DataFrame, cols) -> DataFrame:
    """H4: PC1 and PC2 loadings per feature, sorted by feature name."""
    _, vecs = pca(df, cols, k=2)
    rows = sorted((c, float(vecs[i, 0]), float(vecs[i, 1])) for i, c in enumerate(cols))
    return df.sparkSession.createDataFrame(rows, "feature string, PC1_loading double, PC2_loading double")


def pca_project(df: DataFrame, cols, keep=(), k: int = 2) -> DataFrame:
    """H5: standardise, then project every row onto the first ``k``
    components (a narrow projection; rows with a NULL feature dropped)."""
    cols = list(cols)
    clean = df.dropna(subset=cols)
    _, vecs = pca(clean, cols, k)
    z = standardize(clean, cols, suffix="__z")
    proj = [sum((F.col(c + "__z") * F.lit(float(vecs[i, j])) for i, c in enumerate(cols)), F.lit(0.0))
            .alias(f"PC{j + 1}") for j in range(k)]
    return z.select(*keep, *proj)


def class_ellipse(df: DataFrame, x: str, y: str, label: str, n_std: float = 1.96) -> DataFrame:
    """H6: per class the mean, sample covariance and the 1.96-sd ellipse
    (width, height, angle in degrees of the major axis); classes with fewer
    than 3 points or a non-positive determinant are skipped."""
    s = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"), F.avg(x).alias("mean_x"), F.avg(y).alias("mean_y"),
                              F.var_samp(x).alias("a"), F.covar_samp(x, y).alias("b"), F.var_samp(y).alias("c"))
    half = (F.col("a") + F.col("c")) / 2.0
    rad = F.sqrt(F.pow((F.col("a") - F.col("c")) / 2.0, 2) + F.pow(F.col("b"), 2))
    return (s.where((F.col("n") >= 3) & (F.col("a") * F.col("c") - F.col("b") * F.col("b") > 0))
             .select(label, "n", "mean_x", "mean_y",
                     (2 * n_std * F.sqrt(half + rad)).alias("width"),
                     (2 * n_std * F.sqrt(half - rad)).alias("height"),
                     F.degrees(0.5 * F.atan2(2 * F.col("b"), F.col("a") - F.col("c"))).alias("angle")))


def silhouette_sq(df: DataFrame, cols, label: str, min_count: int = 10):
    """H7 (scalable): mean silhouette with squared Euclidean distance, exact
    over all rows.  For a point x in class c: a = (n_c|x|^2 - 2 x.S_c + Q_c)
    / (n_c - 1), b = nearest other class (n_o|x|^2 - 2 x.S_o + Q_o) / n_o.
    NULL with fewer than 2 classes or a class under ``min_count`` rows."""
    cols = list(cols)
    d = df.dropna(subset=cols + [label])
    sq = sum((F.col(c) * F.col(c) for c in cols[1:]), F.col(cols[0]) * F.col(cols[0]))
    st = d.groupBy(label).agg(F.count(F.lit(1)).alias("n"), F.sum(sq).alias("q"),
                              *[F.sum(c).alias(f"s{i}") for i, c in enumerate(cols)]).collect()  # one row per class
    if len(st) < 2 or min(r["n"] for r in st) < min_count:
        return None
    xx = sq
    per = {}
    for r in st:
        dot = sum((F.col(c) * F.lit(float(r[f"s{i}"])) for i, c in enumerate(cols[1:], 1)),
                  F.col(cols[0]) * F.lit(float(r["s0"])))
        per[r[label]] = (r["n"], F.lit(float(r["n"])) * xx - 2 * dot + F.lit(float(r["q"])))
    s_expr = None
    for c, (n_c, tot) in per.items():
        a = tot / F.lit(float(max(n_c - 1, 1)))
        others = [t / F.lit(float(n_o)) for o, (n_o, t) in per.items() if o != c]
        b = others[0] if len(others) == 1 else F.least(*others)
        s = F.when(F.lit(n_c) <= 1, F.lit(0.0)).otherwise(
            F.coalesce(F.try_divide(b - a, F.greatest(a, b)), F.lit(0.0)))
        s_expr = F.when(F.col(label) == F.lit(c), s) if s_expr is None else s_expr.when(F.col(label) == F.lit(c), s)
    return d.select(s_expr.alias("s")).agg(F.avg("s")).first()[0]
