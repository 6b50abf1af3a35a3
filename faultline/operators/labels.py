"""Labelling (C1-C11): quantile thresholds, k-of-n rules, auto-tuning,
threshold stress and class balance.

Thresholds are computed once per call with the exact distributed quantile
(:mod:`faultline.plans.quantile`) and enter the row-wise rule as literals,
so the rule itself is a single narrow projection inside whole-stage codegen
(and Parquet can prune on it).  NULL readings never satisfy a comparison.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cmp, flag
from ..plans.quantile import quantiles

# Fixed values of the reference pipeline.
LADDER_QUANTILES = [0.90, 0.925, 0.95, 0.975]
LADDER_NAMES = ["Fault_900", "Fault_925", "Fault_950", "Fault_975"]
TUNE_VIB_GRID = [0.70, 0.75, 0.80, 0.85, 0.90]
TUNE_REV_GRID = [0.65, 0.70, 0.75, 0.80, 0.85]
TUNE_SPD_GRID = [0.65, 0.70, 0.75, 0.80, 0.85]
TUNE_TARGET = 0.08
STRESS_FACTORS = [0.8, 0.9, 1.0, 1.1, 1.2]


def _src(c: str, abs_cols) -> Column:
    return F.abs(F.col(c)) if c in set(abs_cols or ()) else F.col(c)


def quantile_thresholds(df: DataFrame, cols, q=0.95, scale: float = 1.0, abs_cols=(),
                        method: str = "refine") -> dict:
    """{col: quantile(col, q) * scale}; ``q`` may be a per-column dict."""
    cols = list(cols)
    qd = q if isinstance(q, dict) else {c: q for c in cols}
    src = df.select(*[_src(c, abs_cols).alias(f"_q{i}") for i, c in enumerate(cols)])
    # one set of jobs for all columns and quantiles
    res = quantiles(src, src.columns, sorted(set(qd.values())), method=method)
    got = {c: res[(f"_q{i}", float(qd[c]))] for i, c in enumerate(cols)}
    return {c: None if v is None else v * scale for c, v in got.items()}


def thresholds_frame(spark, thr: dict, q=None) -> DataFrame:
    """One row per feature: (feature, quantile, threshold)."""
    rows = [(c, None if q is None else float(q if not isinstance(q, dict) else q[c]),
             None if v is None else float(v)) for c, v in thr.items()]
    return spark.createDataFrame(rows, "feature string, quantile double, threshold double")


def rule_count(cols, thr: dict, op: str = ">", abs_cols=()) -> Column:
    """Number of columns whose reading passes its threshold (NULL -> no)."""
    terms = [flag(cmp(_src(c, abs_cols), op, F.lit(thr[c]) if thr[c] is not None
                      else F.lit(None).cast("double"))) for c in cols]
    return sum(terms[1:], terms[0])


def k_of_n(df: DataFrame, cols, q=0.95, k: int = 2, op: str = ">", abs_cols=(), scale: float = 1.0,
           thresholds: dict | None = None, label: str = "label_fault", keep_flags: bool = False,
           flag_suffix: str = "_fault", method: str = "refine", fit_on: DataFrame | None = None) -> DataFrame:
    """label = (#columns passing their threshold) >= k.

    Thresholds come from ``df`` itself (the reference's behaviour, which
    lets test rows shape their own labels) unless ``fit_on`` -- e.g. the
    training fold -- is given."""
    cols = list(cols)
    thr = thresholds if thresholds is not None else \
        quantile_thresholds(fit_on if fit_on is not None else df, cols, q, scale, abs_cols, method)
    out = df
    if keep_flags:
        out = out.withColumns({f"{c}{flag_suffix}": flag(cmp(_src(c, abs_cols), op, F.lit(thr[c])))
                               for c in cols})
    return out.withColumn(label, (rule_count(cols, thr, op, abs_cols) >= k).cast("int"))


def threshold_ladder(df: DataFrame, col: str, qs=LADDER_QUANTILES, names=LADDER_NAMES,
                     op: str = ">=", method: str = "refine") -> DataFrame:
    """One 0/1 column per quantile of ``col`` (``>=``)."""
    res = quantiles(df.select(col), [col], qs, method=method)
    return df.withColumns({n: flag(cmp(col, op, F.lit(res[(col, float(q))])))
                           for q, n in zip(qs, names)})


def autotune(df: DataFrame, vib="vibration", rev="revolutions", spd="speed",
             vib_grid=TUNE_VIB_GRID, rev_grid=TUNE_REV_GRID, spd_grid=TUNE_SPD_GRID,
             target: float = TUNE_TARGET, abs_cols=("speed",), op: str = ">=", k: int = 2,
             method: str = "refine") -> DataFrame:
    """The percentile triple whose 2-of-3 fault rate is closest to ``target``.

    Every row gets three *grades* (how many grid thresholds of a column it
    meets; thresholds grow with the percentile, so it meets the i-th iff its
    grade is at least i), and the rows collapse to a histogram of at most
    6^3 grade cells in one aggregation.  Each cell is then credited to the
    grid points whose rule it passes, and the grid point with the least
    (distance from ``target``, place in the grid) is chosen, all in Spark.
    A table without rows has rate 0 everywhere."""
    spark, cols = df.sparkSession, [vib, rev, spd]
    grids = [list(vib_grid), list(rev_grid), list(spd_grid)]
    src = df.select(*[_src(c, abs_cols).alias(c) for c in cols])
    res = quantiles(src, cols, sorted({q for g in grids for q in g}), method=method)
    thr = [[res[(c, float(q))] for q in g] for c, g in zip(cols, grids)]
    grade = [sum((flag(cmp(c, op, F.lit(t))) for t in ts[1:]), flag(cmp(c, op, F.lit(ts[0])))).alias(f"g{i}")
             for i, (c, ts) in enumerate(zip(cols, thr))]
    cells = src.select(*grade).groupBy("g0", "g1", "g2").agg(F.count(F.lit(1)).alias("n"))
    points = [F.explode(F.sequence(F.lit(1), F.lit(len(g)))) for g in grids]
    met = cells
    for i, p in enumerate(points):          # bounded by the grid, not by the rows
        met = met.select("*", p.alias(f"p{i}"))
    hits = sum((F.when(F.col(f"g{i}") >= F.col(f"p{i}"), 1).otherwise(0) for i in range(3)), F.lit(0))
    rated = met.groupBy("p0", "p1", "p2").agg((F.sum(F.when(hits >= k, F.col("n")).otherwise(0)) / F.sum("n")).alias("rate"))
    place = F.struct(F.abs(F.col("rate") - F.lit(target)).alias("off"), "p0", "p1", "p2")
    best = rated.agg(F.min_by(F.struct("p0", "p1", "p2", "rate"), place).alias("b")).select("b.*").first()
    at = [0, 0, 0] if best["p0"] is None else [best[f"p{i}"] - 1 for i in range(3)]
    row = [g[j] for g, j in zip(grids, at)] + [best["rate"] or 0.0] + [t[j] for t, j in zip(thr, at)]
    return spark.createDataFrame([tuple(row)], "vib_p double, rev_p double, spd_p double, rate double, "
                                 "thr_vibration double, thr_revolutions double, thr_speed_abs double")


def apply_autotune(df: DataFrame, best_row, vib="vibration", rev="revolutions", spd="speed",
                   label: str = "Fault_Combo2of3_TUNED", abs_cols=("speed",)) -> DataFrame:
    thr = {vib: best_row["thr_vibration"], rev: best_row["thr_revolutions"], spd: best_row["thr_speed_abs"]}
    return k_of_n(df, [vib, rev, spd], k=2, op=">=", abs_cols=abs_cols, thresholds=thr, label=label)


def threshold_stress(df: DataFrame, cols, q: float = 0.95, factors=STRESS_FACTORS, k: int = 2,
                     op: str = ">", thresholds: dict | None = None, method: str = "refine") -> DataFrame:
    """Fault rate of the k-of-n rule with thresholds x factor; one
    aggregate for all factors, then unpivoted to (factor, fault_rate)."""
    cols = list(cols)
    base = thresholds or quantile_thresholds(df, cols, q, method=method)
    aggs = []
    for i, f in enumerate(factors):
        thr = {c: None if base[c] is None else base[c] * f for c in cols}
        aggs.append(F.avg((rule_count(cols, thr, op) >= k).cast("double")).alias(f"r{i}"))
    one = df.agg(*aggs)
    return one.select(F.inline(F.array(*[F.struct(F.lit(float(f)).alias("factor"),
                                                  F.col(f"r{i}").alias("fault_rate"))
                                         for i, f in enumerate(factors)])))


def class_balance(df: DataFrame, labels, domain=(0, 1)) -> DataFrame:
    """Per label column and class value: count and share; classes in
    ``domain`` that never occur get 0.  One aggregate for all label columns."""
    labels = [labels] if isinstance(labels, str) else list(labels)
    aggs = [F.count(F.lit(1)).alias("_total")]
    for li, l in enumerate(labels):
        for v in domain:
            aggs.append(F.count(F.when(F.col(l) == v, 1)).alias(f"_c{li}_{v}"))
    one = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(l).alias("label"), F.lit(int(v)).alias("value"),
                              F.col(f"_c{li}_{v}").cast("long").alias("count"),
                              (F.col(f"_c{li}_{v}") / F.col("_total")).alias("share"))
                     for li, l in enumerate(labels) for v in domain])
    return one.select(F.inline(rows))


def ladder_counts(df: DataFrame, labels=LADDER_NAMES) -> DataFrame:
    """C11: positives per label column with the percentage of all rows;
    only label columns present in the frame are reported."""
    present = [l for l in labels if l in df.columns]
    if not present:
        return df.sparkSession.createDataFrame([], "label string, count bigint, pct double")
    one = df.agg(F.count(F.lit(1)).alias("_total"),
                 *[F.sum(F.col(l).cast("long")).alias(f"_s{i}") for i, l in enumerate(present)])
    rows = F.array(*[F.struct(F.lit(l).alias("label"), F.coalesce(F.col(f"_s{i}"), F.lit(0)).cast("long").alias("count"),
                              (F.coalesce(F.col(f"_s{i}"), F.lit(0)) * 100.0 / F.col("_total")).alias("pct"))
                     for i, l in enumerate(present)])
    return one.select(F.inline(rows))
