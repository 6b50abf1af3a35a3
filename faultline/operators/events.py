"""Events (E1-E11): run-based events, per-row event ids, learned and
quantile merge gaps, gap-merge tickets, summaries and time profiles.

All sequential logic goes through :func:`faultline.plans.order.islands`,
so neither a hot asset nor the no-asset (global) order ever lands in one
task.  Event aggregates (min/max/count) use partial aggregation, so even
an event spanning a third of the table is combined map-side.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import US_PER_S, day_key, epoch_us, month_key, to_ntz, week_key
from ..plans.order import carry_prev, islands
from ..plans.quantile import grouped_quantile, quantiles

DAY_S = 24 * 3600.0


def _calendar(df: DataFrame, start: str = "start") -> DataFrame:
    return df.withColumns({
        "hour": F.hour(start).cast("int"),
        "day": day_key(start), "week": week_key(start), "month": month_key(start)})


def _aggregate(d: DataFrame, keys, ts: str, id_col: str = "event_id") -> DataFrame:
    ev = (d.groupBy(*keys, "_event_no")
           .agg(F.min(ts).alias("start"), F.max(ts).alias("end"), F.count(F.lit(1)).alias("n_rows"))
           .withColumnRenamed("_event_no", id_col))
    dur = (epoch_us("end") - epoch_us("start")) / F.lit(float(US_PER_S))
    ev = ev.withColumn("duration_s", dur).withColumn("duration_min", dur / 60.0)
    return _calendar(ev).select(*keys, id_col, "start", "end", "duration_s", "n_rows",
                                "duration_min", "hour", "day", "week", "month")


def fault_events(df: DataFrame, y: str = "label_fault", ts: str = "ts", row_id: str = "row_id",
                 gap_sec=120.0, keys=(), strategy: str = "auto") -> DataFrame:
    """Sort by time; a fault row opens an event if the previous row is
    normal or the time since the previous fault row exceeds ``gap_sec``
    (equal merges); a normal row closes it.  NULL time opens a new event.
    ``gap_sec`` may be a Column (per-row limit, E5).  Ids from 1 per key."""
    keys = list(keys)
    gap = gap_sec * float(US_PER_S) if isinstance(gap_sec, (int, float)) else gap_sec * F.lit(float(US_PER_S))
    # only what the events need enters the (checkpointed) segmented scan
    d = df.select(*keys, ts, row_id, y, *([] if isinstance(gap_sec, (int, float)) else [gap.alias("_gapx")]))
    if not isinstance(gap_sec, (int, float)):
        gap = F.col("_gapx")
    d = islands(d, keys, ts, row_id, y, gap, null_time_splits=True, strategy=strategy)
    return _aggregate(d.where(F.col("_y") == 1), keys, ts)


def event_ids(df: DataFrame, y: str = "label_fault", ts: str = "ts", row_id: str = "row_id",
              gap_min: float = 5.0, keys=(), strategy: str = "auto", out: str = "event_id") -> DataFrame:
    """Per-row event id (0-based, -1 for normal rows); a gap ``>``
    ``gap_min`` minutes splits; a NULL time never splits."""
    keys = list(keys)
    d = islands(df, keys, ts, row_id, y, gap_min * 60.0 * US_PER_S, null_time_splits=False,
                strategy=strategy)
    d = d.withColumn(out, F.when(F.col("_y") == 1, F.col("_event_no") - 1).otherwise(F.lit(-1)).cast("long"))
    return d.drop("_y", "_us", "_seg", "_rn", "_is_start", "_event_no")


def fault_gaps(df: DataFrame, y: str = "label_fault", ts: str = "ts", row_id: str = "row_id",
               keys=(), strategy: str = "auto") -> DataFrame:
    """Seconds between consecutive fault rows (integer micros, then divided)."""
    keys = list(keys)
    f = df.where(F.col(y) == 1).select(*keys, ts, row_id).withColumn("_us", epoch_us(ts))
    f = carry_prev(f, keys, [ts, row_id], ["_us"], strategy=strategy)
    return f.select(*keys, ts, row_id, ((F.col("_us") - F.col("prev__us")) / F.lit(float(US_PER_S))).alias("gap_s"))


def learn_gap(df: DataFrame, y: str = "label_fault", ts: str = "ts", row_id: str = "row_id",
              min_sec: float = 60.0, max_sec: float = 900.0, q: float = 0.95,
              strategy: str = "auto") -> float:
    """P95 of consecutive fault gaps below one day, clamped to
    [min_sec, max_sec]; ``min_sec`` when there is no gap."""
    g = fault_gaps(df, y, ts, row_id, strategy=strategy).where(F.col("gap_s") < DAY_S)
    v = quantiles(g, ["gap_s"], [q])[("gap_s", float(q))]
    if v is None:
        return float(min_sec)
    return float(min(max(v, min_sec), max_sec))


def gap_quantile_global(df: DataFrame, y: str = "label_fault", ts: str = "ts", row_id: str = "row_id",
                        q: float = 0.95, min_gaps: int = 10, fallback_sec: float = 10.0,
                        retry: bool = True, strategy: str = "auto") -> float:
    """Quantile of fault gaps below one day if at least ``min_gaps``
    exist; else retry at min(0.8, q) with min_gaps // 2; else the fallback."""
    g = fault_gaps(df, y, ts, row_id, strategy=strategy).where(F.col("gap_s") < DAY_S).cache()
    try:
        n = g.where(F.col("gap_s").isNotNull()).count()
        if n >= min_gaps:
            return float(quantiles(g, ["gap_s"], [q])[("gap_s", float(q))])
        if retry and n >= min_gaps // 2:
            q2 = min(0.8, q)
            return float(quantiles(g, ["gap_s"], [q2])[("gap_s", float(q2))])
        return float(fallback_sec)
    finally:
        g.unpersist()


def daily_gap_thresholds(df: DataFrame, y: str = "label_fault", ts: str = "ts", row_id: str = "row_id",
                         q: float = 0.95, min_gaps: int = 6) -> DataFrame:
    """E5 helper: per-day quantile of gaps between consecutive fault rows of
    the same day (days with at least ``min_gaps`` gaps).  Both the gaps and
    the exact per-day quantile run on the segmented scan keyed by day, so a
    day holding a third of the data is still split over many tasks."""
    f = df.where((F.col(y) == 1) & F.col(ts).isNotNull()).select(ts, row_id).withColumn("day", day_key(ts))
    g = fault_gaps(f.withColumn("_one", F.lit(1)), "_one", ts, row_id, keys=["day"])
    g = g.where(F.col("gap_s").isNotNull() & (F.col("gap_s") < DAY_S))
    qd = grouped_quantile(g, ["day"], "gap_s", q, row_id, out="gap_s")
    return qd.where(F.col("n") >= min_gaps).select("day", "gap_s")


MAX_DAYS = 4096


def _with_day_gap(d: DataFrame, daily: DataFrame) -> DataFrame:
    """Add each row's day threshold.  When the days with one span at most
    ``MAX_DAYS`` (eleven years), they are a literal array indexed by the day,
    so rows are not moved; beyond that the day table is joined with the rows'
    days dealt out over a salt, so that no day is one task."""
    day_us = 86_400 * US_PER_S
    few = daily.select(epoch_us("day").alias("us"), "gap_s").limit(MAX_DAYS + 1).collect()
    if not few:
        return d.withColumn("_day_gap", F.lit(None).cast("double"))
    first, last = min(r["us"] for r in few), max(r["us"] for r in few)
    if len(few) <= MAX_DAYS and (last - first) // day_us < MAX_DAYS:
        gap = {(r["us"] - first) // day_us: float(r["gap_s"]) for r in few}
        arr = F.array(*[F.lit(gap.get(i)).cast("double") for i in range(max(gap) + 1)])
        at = ((epoch_us("day") - F.lit(first)) / F.lit(float(day_us))).cast("int")
        return d.withColumn("_day_gap", F.when(epoch_us("day") >= F.lit(first), F.get(arr, at)))
    n = 32
    side = daily.select("day", F.col("gap_s").alias("_day_gap"), F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("_salt"))
    return d.withColumn("_salt", F.pmod(F.xxhash64(*d.columns), F.lit(n)).cast("int")) \
        .join(side, ["day", "_salt"], "left").drop("_salt")


def events_gap_per_day(df: DataFrame, y: str = "label_fault", ts: str = "ts", row_id: str = "row_id",
                       q: float = 0.95, min_gaps_daily: int = 6, min_gaps_global: int = 10,
                       fallback_sec: float = 10.0, strategy: str = "auto") -> DataFrame:
    """E5: run-based events where the merge limit of each row is its day's
    gap quantile, falling back to the global quantile at min(0.8, q) (needs
    min_gaps_global // 2 gaps) and then to ``fallback_sec``.  Rows with a
    NULL time are dropped first."""
    d = df.where(F.col(ts).isNotNull())
    glob = gap_quantile_global(d, y, ts, row_id, q=min(0.8, q), min_gaps=min_gaps_global // 2,
                               fallback_sec=fallback_sec, retry=False, strategy=strategy)
    daily = daily_gap_thresholds(d, y, ts, row_id, q, min_gaps_daily)
    d = _with_day_gap(d.withColumn("day", day_key(ts)), daily)
    d = d.withColumn("_row_gap", F.coalesce(F.col("_day_gap"), F.lit(glob)))
    ev = fault_events(d, y, ts, row_id, gap_sec=F.col("_row_gap"), strategy=strategy)
    return ev.withColumn("duration_s", F.greatest(F.col("duration_s"), F.lit(0.0)))


def event_summary_modes(events: DataFrame, mode: str, gap_seconds: float | None, quantile: float | None,
                        global_gap: float | None, daily_days: int, fallback_sec: float) -> DataFrame:
    """E7, extended form: gap mode and parameters used, number of events,
    distinct event days, first start and last end."""
    fmt = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    s = events.agg(F.count(F.lit(1)).alias("n_events"),
                   F.countDistinct(day_key("start")).alias("span_days"),
                   F.coalesce(F.date_format(F.min("start"), fmt), F.lit("")).alias("first_ts"),
                   F.coalesce(F.date_format(F.max("end"), fmt), F.lit("")).alias("last_ts"))
    return s.select(F.lit(mode).alias("gap_mode_used"), F.lit(gap_seconds).cast("double").alias("merge_gap_seconds_used"),
                    F.lit(quantile).cast("double").alias("quantile_used"),
                    F.lit(global_gap).cast("double").alias("global_quantile_gap_sec"),
                    F.lit(int(daily_days)).cast("long").alias("daily_threshold_days"),
                    F.lit(float(fallback_sec)).alias("fallback_sec"), "n_events",
                    F.col("span_days").cast("long").alias("span_days"), "first_ts", "last_ts")


def gap_merge(df: DataFrame, y: str = "label_fault", ts: str = "ts", row_id: str = "row_id",
              gap_sec: float = 60.0, keys=(), strategy: str = "auto",
              id_col: str = "ticket_id") -> DataFrame:
    """Tickets from fault rows only; consecutive fault rows merge while
    their gap is <= ``gap_sec`` (normal rows are ignored)."""
    keys = list(keys)
    f = df.where(F.col(y) == 1).select(*keys, ts, row_id).withColumn("_f", F.lit(1))
    d = islands(f, keys, ts, row_id, "_f", gap_sec * US_PER_S, null_time_splits=True, strategy=strategy)
    ev = _aggregate(d, keys, ts, id_col=id_col)
    return ev.select(*keys, id_col, "start", "end", "duration_s", "n_rows")


def event_summary(events: DataFrame, rows: DataFrame | None = None, ts: str = "ts",
                  gap_used: float | None = None) -> DataFrame:
    """n_events, mean / P50 / P95 of duration_min (0 when empty), the
    time range and span of the underlying rows, and the merge gap used."""
    qv = quantiles(events, ["duration_min"], [0.5, 0.95])
    p50, p95 = qv[("duration_min", 0.5)], qv[("duration_min", 0.95)]
    s = events.agg(F.count(F.lit(1)).alias("n_events"),
                   F.coalesce(F.avg("duration_min"), F.lit(0.0)).alias("duration_min_mean"))
    s = s.withColumns({"duration_min_p50": F.lit(p50 if p50 is not None else 0.0),
                       "duration_min_p95": F.lit(p95 if p95 is not None else 0.0)})
    fmt = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    if rows is not None:
        r = rows.agg(F.date_format(F.min(ts), fmt).alias("a"), F.date_format(F.max(ts), fmt).alias("b"),
                     ((epoch_us(F.max(ts)) - epoch_us(F.min(ts))) / F.lit(3600.0 * US_PER_S)).alias("h")).first()
        s = s.withColumns({"time_min": F.lit(r["a"]).cast("string"), "time_max": F.lit(r["b"]).cast("string"),
                           "span_hours": F.lit(r["h"] if r["h"] is not None else 0.0).cast("double")})
    return s.withColumn("merge_gap_seconds_used", F.lit(gap_used).cast("double"))


def events_per_grain(events: DataFrame, grain: str, id_cols=("event_id",)) -> DataFrame:
    """Distinct events per hour of day (all 24, zero filled), day, week
    or month."""
    ident = F.struct(*id_cols) if len(id_cols) > 1 else F.col(id_cols[0])
    if grain == "hour":
        c = events.groupBy("hour").agg(F.countDistinct(ident).alias("n_events"))
        hours = events.sparkSession.range(24).select(F.col("id").cast("int").alias("hour"))
        return hours.join(c, "hour", "left").select(
            "hour", F.coalesce("n_events", F.lit(0)).cast("long").alias("n_events"))
    return events.groupBy(grain).agg(F.countDistinct(ident).cast("long").alias("n_events"))


def events_adaptive_grain(events: DataFrame) -> DataFrame:
    """Weekly counts if the events cover >= 2 weeks, else by hour of day;
    monthly if >= 2 months, else daily.  Output (panel, grain, bucket, n)."""
    span = events.agg(F.countDistinct("week").alias("w"), F.countDistinct("month").alias("m")).first()
    first = "week" if span["w"] >= 2 else "hour"
    second = "month" if span["m"] >= 2 else "day"
    parts = []
    for panel, g in (("weekly_or_hourly", first), ("monthly_or_daily", second)):
        c = events_per_grain(events, g)
        key = F.col(g).cast("string") if g == "hour" else F.date_format(g, "yyyy-MM-dd")
        parts.append(c.select(F.lit(panel).alias("panel"), F.lit(g).alias("grain"),
                              key.alias("bucket"), "n_events"))
    return parts[0].unionByName(parts[1])


def duration_histogram(events: DataFrame, col: str = "duration_min", bins: int = 30,
                       upper_q: float = 0.99) -> DataFrame:
    """Values clipped to [0, P99], ``bins`` equal bins over the clipped
    range, last bin closed; all bins reported (zeros included)."""
    p = quantiles(events, [col], [upper_q])[(col, float(upper_q))]
    spark = events.sparkSession
    if p is None:
        return spark.createDataFrame([], "bin int, lo double, hi double, n bigint")
    x = F.least(F.greatest(F.col(col), F.lit(0.0)), F.lit(p))
    rng = events.select(x.alias("x")).agg(F.min("x").alias("a"), F.max("x").alias("b")).first()
    lo, hi = rng["a"], rng["b"]
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    w = (hi - lo) / bins
    b = F.least(F.floor((x - F.lit(lo)) / F.lit(w)), F.lit(bins - 1)).cast("int")
    c = events.select(b.alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    allb = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (allb.join(c, "bin", "left")
                .select("bin", (F.lit(lo) + F.col("bin") * F.lit(w)).alias("lo"),
                        (F.lit(lo) + (F.col("bin") + 1) * F.lit(w)).alias("hi"),
                        F.coalesce("n", F.lit(0)).cast("long").alias("n")))


def top_events(events: DataFrame, n: int = 10, by: str = "duration_s", id_col: str = "event_id") -> DataFrame:
    """The ``n`` longest events (a top-k report: TakeOrdered, no global sort)."""
    return events.orderBy(F.col(by).desc_nulls_last(), F.col(id_col)).limit(n)
