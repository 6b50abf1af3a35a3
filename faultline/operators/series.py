"""Time-series operators (D1-D10): differences, rolling means, calendar
keys, zero-filled fault profiles, traffic regimes and span profiles."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import US_PER_S, day_key, epoch_us, month_key, to_ntz, us_to_ts, week_key
from ..functions.exact import digits_of, mean as exact_mean, tallies
from ..plans.order import (RN, SEG, attach, carry_prev, choose_strategy, fill_forward_backward,
                           local_window, pin, prepare, running_sums, seg_window)


def first_difference(df: DataFrame, col: str, out: str = "acceleration", ts: str = "ts",
                     row_id: str = "row_id", keys=(), per_second: bool = False,
                     strategy: str = "auto") -> DataFrame:
    """``c - previous c`` in time order (per key), first row 0; with
    ``per_second`` divided by the time step in seconds.  Rows of one time
    have a step of 0: their rate is infinite, or NaN where nothing changed."""
    keys = list(keys)
    d = df.withColumn("_d1us", epoch_us(ts))
    d = carry_prev(d, keys, [ts, row_id], [col, "_d1us"], strategy=strategy, prefix="_d1p_")
    diff = F.col(col) - F.col(f"_d1p_{col}")
    if per_second:
        step = (F.col("_d1us") - F.col("_d1p__d1us")) / F.lit(float(US_PER_S))
        at_once = F.when(diff > 0, F.lit(float("inf"))).when(diff < 0, F.lit(float("-inf"))) \
            .when(diff == 0, F.lit(float("nan")))
        diff = F.when(step == 0, at_once).otherwise(F.try_divide(diff, step))
    return d.withColumn(out, F.coalesce(diff, F.lit(0.0))).drop(
        "_d1us", f"_d1p_{col}", "_d1p__d1us", "_seg", "_rn")


def rolling_time_mean(df: DataFrame, cols, window_s: float = 300.0, ts: str = "ts", row_id: str = "row_id",
                      keys=(), fill: bool = True, strategy: str = "auto") -> DataFrame:
    """Trailing mean over the time window (t - window, t], then
    forward/backward fill.

    One meaning in both plans: of the rows that share a time only the row
    itself and those before it in (time, row id) order count; a row without
    a time has a window of its own; NULL keys are one group; no row is lost
    or repeated, whatever its id.  Sums are exact for any doubles (integer
    digits, ``functions/exact.py``); NaN counts as missing, a window with an
    infinity has it as its mean (NaN with both).

    A mean is the difference of two exact running sums: up to the row, and up
    to the window's opening.  Without a hot key both are growing frames of
    one sort per key.  With a hot key -- or no key at all -- they come from
    the segmented scan: ids and digits only, each row as itself and as a
    *probe* at t - window (after the data rows of that time); the means meet
    their rows again by row number."""
    keys, cols = list(keys), list(cols)
    strategy = choose_strategy(df, keys, strategy)      # resolved once, reused by the fill
    means = _range_means if strategy == "window" else _prefix_means
    out = means(df, cols, int(window_s * US_PER_S), ts, row_id, keys)
    if fill:
        out = fill_forward_backward(out, keys, [ts, row_id], cols, strategy).drop(SEG, RN)
    return out


def _exact_parts(places, cols):
    """Names and columns of what is summed: digits and tallies per column."""
    parts = {}
    for i, c in enumerate(cols):
        for j, x in enumerate([*tallies(F.col(c)), *places[c].split(F.col(c))]):
            parts[f"_x{i}_{j}"] = x
    return parts


def _exact_means(places, cols, of):
    """Mean per column; ``of(name)`` is the window's sum of a part."""
    out = {}
    for i, c in enumerate(cols):
        n, up, down, *digits = [of(f"_x{i}_{j}") for j in range(places[c].count + 3)]
        out[c] = exact_mean(places[c], digits, n, up, down)
    return out


def _alone(value, ts):
    """A row without a time has only itself in its window (NaN is missing there too)."""
    x = value.cast("double")
    return lambda m: F.when(ts.isNull(), F.when(~F.isnan(x), x)).otherwise(m)


def _range_means(df, cols, width_us, ts, row_id, keys):
    places = digits_of(df, cols)
    parts = _exact_parts(places, cols)
    d = df.withColumns({"_t": epoch_us(ts), **parts})
    part = Window.partitionBy(*(keys or [F.lit(0)]))
    upto = part.orderBy(F.col("_t").asc_nulls_first(), F.col(row_id).asc_nulls_last()) \
        .rowsBetween(Window.unboundedPreceding, 0)
    opened = part.orderBy(F.col("_t").asc_nulls_first()).rangeBetween(Window.unboundedPreceding, -width_us)
    # the finer order first: its sort serves the other frame too
    d = d.withColumns({f"_u{x}": F.sum(x).over(upto) for x in parts})
    d = d.withColumns({f"_o{x}": F.coalesce(F.sum(x).over(opened), F.lit(0)) for x in parts})
    d = d.withColumns({f"_d{x}": F.col(f"_u{x}") - F.col(f"_o{x}") for x in parts})
    means = _exact_means(places, cols, lambda x: F.col(f"_d{x}"))
    out = d.withColumns({c: _alone(F.col(c), F.col(ts))(m) for c, m in means.items()})
    return out.drop("_t", *[f"{k}{x}" for x in parts for k in ("", "_u", "_o", "_d")])


def _prefix_means(df, cols, width_us, ts, row_id, keys):
    places = digits_of(df, cols)
    parts = list(_exact_parts(places, cols))
    # numbered and pinned once: the narrow scan and the rows it returns to see the same numbers
    rows = pin(df.withColumn("_u", F.monotonically_increasing_id()))
    d = rows.select(*[F.col(k) for k in keys], "_u", F.col(row_id).alias("_rid"), epoch_us(ts).alias("_t"),
                    *[x.alias(n) for n, x in _exact_parts(places, cols).items()])
    point = F.struct(F.lit(0).alias("_kind"), F.col("_t"), *parts)
    probe = F.struct(F.lit(1).alias("_kind"), (F.col("_t") - F.lit(width_us)).alias("_t"),
                     *[F.lit(0).cast("bigint").alias(x) for x in parts])
    d = d.where(F.col("_t").isNotNull()).select(*keys, "_u", "_rid", F.inline(F.array(point, probe)))
    r = running_sums(d, keys, ["_t", "_kind", "_rid"], parts, strategy="ranged")
    at = F.when(F.col("_kind") == 0, 1).otherwise(-1)
    g = r.groupBy("_u").agg(*[F.sum(at * F.col(f"cum_{x}")).alias(x) for x in parts])
    g = g.select(F.col("_u").alias("_v"), *[m.alias(f"_m{i}") for i, m in
                                            enumerate(_exact_means(places, cols, F.col).values())])
    out = rows.join(g, F.col("_u") == F.col("_v"), "left")
    out = out.withColumns({c: _alone(F.col(c), F.col(ts))(F.col(f"_m{i}")) for i, c in enumerate(cols)})
    return out.drop("_u", "_v", *[f"_m{i}" for i in range(len(cols))])


def rolling_row_mean(df: DataFrame, cols, n: int = 5, ts: str = "ts", row_id: str = "row_id", keys=(),
                     fill: bool = False, strategy: str = "auto") -> DataFrame:
    """D3: trailing mean over the last ``n`` rows (at least one).  On the
    segmented scan the first rows of a segment complete their frame from a
    carried tail of the previous ``n - 1`` rows (bounded by ``n``)."""
    keys, cols = list(keys), list(cols)
    order = [ts, row_id]
    resolved, d = prepare(df, keys, order, strategy)
    w = local_window(keys, order)
    frame = w.rowsBetween(-(n - 1), 0)
    if resolved == "window":
        out = d.withColumns({c: F.avg(c).over(frame) for c in cols}).drop(SEG)
        if fill:
            out = fill_forward_backward(out, keys, order, cols, resolved).drop(SEG, RN)
        return out
    d = d.withColumn(RN, F.row_number().over(w)).withColumn("_cnt", F.count(F.lit(1)).over(
        Window.partitionBy(*keys, SEG)))
    d = d.withColumns({f"_ls_{c}": F.sum(c).over(frame) for c in cols})
    d = d.withColumns({f"_lc_{c}": F.count(c).over(frame) for c in cols})
    d = pin(d)
    tail = d.groupBy(*keys, SEG).agg(F.sort_array(F.collect_list(F.when(
        F.col(RN) > F.col("_cnt") - (n - 1), F.struct(F.col(RN).alias("rn"), *[F.col(c) for c in cols])))).alias("_tail"))
    prev = F.flatten(F.collect_list("_tail").over(seg_window(keys).rowsBetween(-(n - 1), -1)))
    tail = tail.select(*keys, SEG, F.slice(prev, F.greatest(F.size(prev) - (n - 2), F.lit(1)), n - 1).alias("_carry"))
    d = attach(d, tail, keys)
    need = F.greatest(F.lit(n) - F.col(RN), F.lit(0))
    car = F.coalesce(F.col("_carry"), F.array())
    take = F.when(need > 0, F.slice(car, F.greatest(F.size(car) - need + 1, F.lit(1)), need)).otherwise(F.array())
    out = d
    for c in cols:
        cs = F.aggregate(take, F.lit(0.0), lambda acc, x: acc + F.coalesce(x[c].cast("double"), F.lit(0.0)))
        cc = F.aggregate(take, F.lit(0), lambda acc, x: acc + F.when(x[c].isNotNull(), 1).otherwise(0))
        out = out.withColumn(c, (F.coalesce(F.col(f"_ls_{c}"), F.lit(0.0)) + cs)
                             / F.nullif((F.col(f"_lc_{c}") + cc).cast("double"), F.lit(0.0)))
    out = out.drop("_cnt", "_carry", *[f"_ls_{c}" for c in cols], *[f"_lc_{c}" for c in cols])
    if fill:
        out = fill_forward_backward(out.drop(SEG, RN), keys, order, cols, resolved)
    return out.drop(SEG, RN)


def calendar_keys(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Hour of day, day, Monday-start week, month."""
    return df.withColumns({"hour": F.hour(to_ntz(ts)).cast("int"), "day": day_key(ts),
                           "week": week_key(ts), "month": month_key(ts)})


def faults_by_hour(df: DataFrame, y: str, ts: str = "ts") -> DataFrame:
    """Faults per hour of day, all 24 hours (0 when none)."""
    c = df.groupBy(F.hour(to_ntz(ts)).cast("int").alias("hour")).agg(F.sum(F.col(y).cast("long")).alias("faults"))
    hours = df.sparkSession.range(24).select(F.col("id").cast("int").alias("hour"))
    return hours.join(c, "hour", "left").select("hour", F.coalesce("faults", F.lit(0)).cast("long").alias("faults"))


def _filled_grid(df: DataFrame, y: str, ts: str, unit: str) -> DataFrame:
    """Sums per ``unit`` bucket over the whole span, empty buckets 0.  The
    grid runs from the data's least to its greatest bucket as a distributed
    range, so a stray time makes many rows but no large array."""
    key = day_key(ts) if unit == "day" else F.date_trunc("hour", to_ntz(ts)).cast("timestamp_ntz")
    step = (24 if unit == "day" else 1) * 3600 * US_PER_S
    sums = df.groupBy(key.alias("bucket")).agg(F.sum(F.col(y).cast("long")).alias("faults"))
    ends = sums.agg(F.min(epoch_us("bucket")).alias("a"), F.max(epoch_us("bucket")).alias("b")).first()
    if ends["a"] is None:
        return sums.where(F.col("bucket").isNotNull())
    grid = df.sparkSession.range(ends["a"], ends["b"] + 1, step).select(us_to_ts("id").alias("bucket"))
    return grid.join(sums, "bucket", "left").select(
        "bucket", F.coalesce("faults", F.lit(0)).cast("long").alias("faults"))


def faults_daily(df: DataFrame, y: str, ts: str = "ts") -> DataFrame:
    """Daily fault sums, empty days 0."""
    return _filled_grid(df, y, ts, "day").withColumnRenamed("bucket", "day")


def faults_daily_rolling(df: DataFrame, y: str, ts: str = "ts", n: int = 3) -> DataFrame:
    """D6 plus the trailing ``n``-day mean (at least one day).  The
    window runs over the day grid (one row per day), not over rows."""
    d = faults_daily(df, y, ts)
    w = Window.orderBy("day").rowsBetween(-(n - 1), 0)
    return d.withColumn("rolling_mean", F.avg("faults").over(w))


def faults_hourly(df: DataFrame, y: str, ts: str = "ts") -> DataFrame:
    """Hourly fault sums with empty hours 0 (a 1-hour rolling sum is the
    identity)."""
    return _filled_grid(df, y, ts, "hour").withColumnRenamed("bucket", "hour_start")


def regime(ts: str = "ts"):
    """D9 buckets: weekend; weekday rush 7-9 and 17-19; midday 10-16; quiet."""
    t = to_ntz(ts)
    h, dow = F.hour(t), F.dayofweek(t)          # 1 = Sunday ... 7 = Saturday
    return (F.when(dow.isin(1, 7), "weekend")
             .when(h.between(7, 9) | h.between(17, 19), "rush")
             .when(h.between(10, 16), "midday")
             .otherwise("quiet"))


def traffic_regime(df: DataFrame, y: str, ts: str = "ts") -> DataFrame:
    """Rows and fault rate per traffic regime."""
    return df.groupBy(regime(ts).alias("regime")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg(F.col(y).cast("double")).alias("fault_rate"))


def time_span(df: DataFrame, ts: str = "ts") -> DataFrame:
    """First and last time, span in hours, distinct days."""
    return df.agg(F.min(ts).alias("time_min"), F.max(ts).alias("time_max"),
                  ((epoch_us(F.max(ts)) - epoch_us(F.min(ts))) / F.lit(3600.0 * US_PER_S)).alias("span_hours"),
                  F.countDistinct(day_key(ts)).alias("n_days"))
