"""Exact linear-interpolated quantiles without a single-reducer aggregate.

Spark's exact ``percentile`` keeps every distinct value of a group in one
hash map on one reducer: fine for millions of values, not for a 100 TB
column.  ``method="refine"`` finds the exact order statistics instead by
narrowing intervals of *ranks*:

* job 1: the number of values per column (one scan, partial aggregation);
* each round, for every pending target, an approximate-percentile sketch of
  its interval gives two values around the wanted rank, and one aggregate
  counts the interval's values below, at, between and above them exactly.
  The rank then lies on one of the two values -- which is the answer -- or
  in one of the open intervals.  The one between them holds at most
  ``4 / accuracy`` of the values whatever their distribution (infinities,
  many decades, heavy ties), so n values need about log(n / small) /
  log(accuracy / 4) rounds: two for 10^13;
* once an interval holds at most ``small`` values those are fetched --
  bounded by the parameter and a budget per pass -- and the rank is read off.

The interpolation is ``x_lo + (x_hi - x_lo) * frac`` with
``h = (n - 1) * q`` -- the same arithmetic as DuckDB's ``quantile_cont``
and pandas' linear quantile -- so equal neighbours give the value itself.
NULLs are ignored (NaN must be normalised to NULL first).
"""
from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FETCH_BUDGET = 4_000_000      # values brought to the driver per pass (~32 MB)


def _interp(lo, hi, frac):
    if frac == 0.0 or lo == hi:
        return lo
    return lo + (hi - lo) * frac


def quantiles(df: DataFrame, cols, qs, method: str = "refine", small: int = 1_000_000,
              accuracy: int = 10_000) -> dict:
    """{(col, q): value or None}.  ``method``: refine (exact, scalable),
    percentile (Spark exact, one reducer per group), approx."""
    cols, qs = list(cols), [float(q) for q in qs]
    if method == "percentile":
        row = df.agg(*[F.percentile(F.col(c), F.array(*[F.lit(q) for q in qs])).alias(c)
                       for c in cols]).first()
        return {(c, q): (row[c][i] if row[c] is not None else None)
                for c in cols for i, q in enumerate(qs)}
    if method == "approx":
        row = df.agg(*[F.percentile_approx(F.col(c), [F.lit(q) for q in qs], accuracy).alias(c)
                       for c in cols]).first()
        return {(c, q): (row[c][i] if row[c] is not None else None)
                for c in cols for i, q in enumerate(qs)}
    if method != "refine":
        raise ValueError(method)

    st = df.agg(*[F.count(F.col(c)).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    plan = {}      # (col index, q) -> (lo rank, hi rank, frac)
    state = {}     # (col index, rank) -> its interval, see _start
    for i, c in enumerate(cols):
        n = int(st[f"n{i}"])
        for q in qs:
            if n == 0:
                plan[(i, q)] = None
                continue
            h = (n - 1) * q
            lo, hi = int(math.floor(h)), int(math.ceil(h))
            plan[(i, q)] = (lo, hi, h - lo)
            for r in (lo, hi):
                state.setdefault((i, r), _start(n))
    _select(df, cols, state, small, accuracy)

    out = {}
    for (i, q), p in plan.items():
        if p is None:
            out[(cols[i], q)] = None
            continue
        lo, hi, frac = p
        out[(cols[i], q)] = _interp(state[(i, lo)]["value"], state[(i, hi)]["value"], frac)
    return out


def _start(n: int) -> dict:
    """The open interval (above, under) that holds a rank: None is unbounded."""
    return {"above": None, "under": None, "below": 0, "count": n, "value": None}


def _inside(c, v):
    x = F.col(c).cast("double")
    ok = x.isNotNull()
    if v["above"] is not None:
        ok = ok & (x > F.lit(v["above"]))
    if v["under"] is not None:
        ok = ok & (x < F.lit(v["under"]))
    return x, ok


def _select(df, cols, state, small, accuracy):
    """Resolve every ``state[(col index, rank)]`` to the exact value of that
    0-based order statistic (NULLs excluded)."""
    while pending := {k: v for k, v in state.items() if v["value"] is None}:
        # fetch the smallest intervals while the total stays within budget
        # (intervals shared by several targets are counted once)
        fetch, seen, used = {}, set(), 0
        for k, v in sorted(pending.items(), key=lambda kv: kv[1]["count"]):
            iv = (k[0], v["above"], v["under"])
            cost = 0 if iv in seen else v["count"]
            if v["count"] <= small and used + cost <= FETCH_BUDGET:
                fetch[k] = v
                seen.add(iv)
                used += cost
        refine = {k: v for k, v in pending.items() if k not in fetch and v["count"] > small}
        if fetch:
            _fetch_exact(df, cols, fetch)
        if refine:
            _narrow_once(df, cols, refine, accuracy)


def order_statistics(df: DataFrame, col: str, ranks, small: int = 1_000_000, accuracy: int = 10_000) -> dict:
    """{rank: value} for 0-based ranks among the non-NULL values of ``col``
    (ranks outside [0, n) map to None)."""
    got = multi_order_statistics(df, {col: list(ranks)}, small, accuracy)
    return {int(r): got[(col, int(r))] for r in ranks}


def multi_order_statistics(df: DataFrame, wanted: dict, small: int = 1_000_000, accuracy: int = 10_000) -> dict:
    """{(col, rank): value} for several columns at once (one counting job
    and shared rounds)."""
    cols = list(wanted)
    st = df.agg(*[F.count(F.col(c)).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    state = {(i, int(r)): _start(int(st[f"n{i}"])) for i, c in enumerate(cols) for r in wanted[c]
             if 0 <= int(r) < int(st[f"n{i}"])}
    _select(df, cols, state, small, accuracy)
    return {(c, int(r)): (state[(i, int(r))]["value"] if (i, int(r)) in state else None)
            for i, c in enumerate(cols) for r in wanted[c]}


def _narrow_once(df, cols, items, accuracy):
    """One round: two values around each rank, then exact counts about them."""
    keys, aggs = list(items), []
    asked = {}                                          # one sketch for all targets of an interval
    for k in keys:
        v = items[k]
        f = (k[1] - v["below"]) / max(1, v["count"] - 1)
        asked.setdefault((k[0], v["above"], v["under"]), {})[k] = [
            min(1.0, max(0.0, f + d / accuracy)) for d in (-1.5, 1.5)]
    for s, ends in enumerate(asked.values()):
        k = next(iter(ends))
        x, ok = _inside(cols[k[0]], items[k])
        aggs.append(F.percentile_approx(F.when(ok, x), [e for two in ends.values() for e in two], 2 * accuracy).alias(f"s{s}"))
    got = df.agg(*aggs).first()                         # two values per target
    cuts = {k: got[f"s{s}"][2 * i:2 * i + 2] for s, ends in enumerate(asked.values()) for i, k in enumerate(ends)}
    aggs = []
    for t, k in enumerate(keys):
        x, ok = _inside(cols[k[0]], items[k])
        lo, hi = (F.lit(float(e)) for e in cuts[k])
        aggs += [F.count_if(ok & (x < lo)).alias(f"l{t}"), F.count_if(ok & (x == lo)).alias(f"a{t}"),
                 F.count_if(ok & (x > lo) & (x < hi)).alias(f"m{t}"),
                 F.count_if(ok & (x == hi) & (hi > lo)).alias(f"b{t}")]
    n = df.agg(*aggs).first()                           # four counts per target
    for t, k in enumerate(keys):
        v, (lo, hi) = items[k], cuts[k]
        left = k[1] - v["below"]
        for count, above, under, value in ((n[f"l{t}"], v["above"], lo, None), (n[f"a{t}"], None, None, lo),
                                           (n[f"m{t}"], lo, hi, None), (n[f"b{t}"], None, None, hi),
                                           (math.inf, hi, v["under"], None)):
            if left < count:
                inside = min(count, v["count"] - (k[1] - v["below"] - left))
                v.update(above=above, under=under, below=k[1] - left, count=int(inside),
                         value=None if value is None else float(value))
                break
            left -= count


def _fetch_exact(df, cols, items):
    ids, parts = {}, []
    for k, v in items.items():          # one fetch for all targets of an interval
        iv = (k[0], v["above"], v["under"])
        if iv not in ids:
            ids[iv] = len(ids)
            x, ok = _inside(cols[k[0]], v)
            parts.append(F.when(ok, F.struct(F.lit(ids[iv]).alias("t"), x.alias("v"))))
    pdf = (df.select(F.explode(F.array(*parts)).alias("x")).where(F.col("x").isNotNull())
             .select("x.t", "x.v").toPandas())   # Arrow; bounded by FETCH_BUDGET values
    held = {t: np.sort(g.to_numpy()) for t, g in pdf.groupby("t")["v"]}
    for k, v in items.items():
        v["value"] = float(held[ids[k[0], v["above"], v["under"]]][k[1] - v["below"]])


def quantile_map(df: DataFrame, cols, q: float, method: str = "refine", scale: float = 1.0) -> dict:
    """{col: quantile(col, q) * scale}."""
    qv = quantiles(df, cols, [q], method=method)
    return {c: (None if qv[(c, float(q))] is None else qv[(c, float(q))] * scale) for c in cols}


def grouped_quantile(df: DataFrame, keys, col: str, q: float, row_id: str, out: str = "value",
                     strategy: str = "auto", accuracy: int = 10_000) -> DataFrame:
    """Exact linear quantile of ``col`` per group, for all groups at once.

    One mergeable sketch per group gives two values around the wanted rank,
    and exact counts below, at, between and above them follow, both with
    map-side partial results.  Where a rank lies on one of the two values it
    is known; the rows of the open interval that holds it otherwise -- some
    4 / ``accuracy`` of a large group, whatever its values -- are ranked by
    the segmented scan, so a hot group is neither sorted nor held anywhere.
    Output: keys, n, out."""
    from .order import pin, position          # local import: order imports nothing from here
    keys, names = list(keys), [f"_k{i}" for i in range(len(keys))]
    d = df.where(F.col(col).isNotNull()).select(*keys, row_id, F.col(col).cast("double").alias("_v"))

    def join(rows, table):
        """Null-safe inner join on the keys, which stay as the rows have them."""
        t = table.withColumnsRenamed(dict(zip(keys, names, strict=True)))
        cond = [rows[k].eqNullSafe(t[n]) for k, n in zip(keys, names, strict=True)]
        return rows.join(t, reduce(lambda a, b: a & b, cond)).drop(*names)

    h = (F.col("n") - 1) * F.lit(float(q))
    ends = [min(1.0, max(0.0, q + x / accuracy)) for x in (-1.5, 1.5)]
    cuts = d.groupBy(*keys).agg(F.count("*").alias("n"), F.percentile_approx("_v", ends, 2 * accuracy).alias("_c"))
    cuts = cuts.select(*keys, "n", F.col("_c")[0].alias("_lo"), F.col("_c")[1].alias("_hi"))
    v, lo, hi = F.col("_v"), F.col("_lo"), F.col("_hi")
    regions = [v < lo, v == lo, (v > lo) & (v < hi), (v == hi) & (hi > lo), v > hi]
    counts = join(d, cuts).groupBy(*keys).agg(
        F.any_value("n").alias("n"), F.any_value("_lo").alias("_lo"), F.any_value("_hi").alias("_hi"),
        *[F.count_if(r).alias(f"_r{i}") for i, r in enumerate(regions)])
    counts = pin(counts)                                     # one row per group
    # each wanted rank with its region and its place there
    before = [sum((F.col(f"_r{j}") for j in range(i)), F.lit(0)) for i in range(6)]
    region = F.lit(4)
    for i in range(3, -1, -1):
        region = F.when(F.col("_rank") < before[i + 1], i).otherwise(region)
    want = counts.select("*", F.explode(F.array(F.floor(h), F.ceil(h))).alias("_rank")).distinct()
    want = want.withColumn("_region", region)
    at = F.array(*before[:5])
    want = want.withColumn("_place", F.col("_rank") - F.get(at, F.col("_region")) + 1)
    known = want.withColumn("_x", F.when(F.col("_region") == 1, lo).when(F.col("_region") == 3, hi))
    open_ = want.where(F.col("_region").isin(0, 2, 4))
    rest = join(d, open_.select(*keys, "_lo", "_hi", "_region").distinct())
    inside = F.when(F.col("_region") == 0, regions[0]).when(F.col("_region") == 2, regions[2]).otherwise(regions[4])
    rest = rest.where(inside).select(*keys, F.col("_region").alias("_g"), row_id, "_v")
    rest = position(rest, [*keys, "_g"], ["_v", row_id], strategy=strategy, pos="_pos", total="_total")
    found = join(rest.select(*keys, "_g", "_pos", "_v"), open_.select(*keys, "_region", "_place", "_rank")) \
        .where((F.col("_g") == F.col("_region")) & (F.col("_pos") == F.col("_place")))
    values = known.where(F.col("_x").isNotNull()).select(*keys, "_rank", "_x") \
        .unionByName(found.select(*keys, "_rank", F.col("_v").alias("_x")))
    g = values.groupBy(*keys).agg(F.min_by("_x", "_rank").alias("_a"), F.max_by("_x", "_rank").alias("_b"))
    f = h - F.floor(h)
    val = F.when((f == 0) | (F.col("_a") == F.col("_b")), F.col("_a")) \
           .otherwise(F.col("_a") + (F.col("_b") - F.col("_a")) * f)
    return join(counts.select(*keys, "n"), g).select(*keys, "n", val.alias(out))
