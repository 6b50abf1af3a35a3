"""Ordered (sequential) operators without a single-task stage.

Gaps-and-islands, lags, running counts and forward fills need rows in time
order per asset.  ``Window.partitionBy(asset)`` sends every row of an asset
to one task -- fatal when one asset holds a third of the data, and with no
asset key at all it is a single task for the whole table.

The *segmented scan* used here:

1. ``repartitionByRange(n, *keys, ts, row_id)`` cuts the total order into
   ``n`` contiguous, balanced ranges (the range partitioner samples the full
   sort key, so a hot asset is spread over many ranges).  The partition id
   becomes the segment number ``_seg``.
   The segmented rows are written once with a reliable ``checkpoint()`` to
   the shared checkpoint folder: the range partitioner samples with a seed
   tied to the RDD id, so two executions of the same exchange (one per plan
   branch, or a recomputation after a lost executor) could cut different
   ranges.  Pinning the assignment makes every consumer -- the rows and
   their per-segment summary -- see the same segments.
2. Each (keys, segment) is processed by an ordinary window (bounded size).
3. One summary row per (keys, segment) -- at most ``#keys + n`` rows, small
   and independent of row count -- carries the state across segment borders
   (last row, number of starts, last non-null, row counts) with a window
   over segments.
4. The summary is joined back on (keys, segment); adaptive execution turns
   that join into a broadcast at run time when the summary is small, and
   keeps a shuffle join otherwise.

``strategy="window"`` uses one segment per key (the plain window).
``strategy="auto"`` (the default) measures the key distribution with one
aggregate: when no key holds more than ``HOT_FACTOR`` times an average
partition's rows the plain keyed window is used (one shuffle, no
checkpoint); otherwise -- and always for a global order without keys --
the segmented scan.  All strategies give identical results.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir, shuffle_partitions

SEG = "_seg"
RN = "_rn"
HOT_FACTOR = 2.0


def choose_strategy(df: DataFrame, keys, strategy: str = "auto") -> str:
    """Resolve ``auto``: ranged if there are no keys or a key is hot."""
    if strategy != "auto":
        return strategy
    keys = list(keys)
    if not keys:
        return "ranged"
    r = df.groupBy(*keys).count().agg(F.max("count").alias("m"), F.sum("count").alias("n")).first()
    if r["n"] is None:
        return "window"
    per_task = r["n"] / shuffle_partitions(df.sparkSession)
    return "ranged" if r["m"] > max(HOT_FACTOR * per_task, 1.0) else "window"


def _ord(order):
    return [F.col(c).asc_nulls_last() for c in order]


def prepare(df: DataFrame, keys, order, strategy: str = "auto", num_segments: int | None = None):
    """(resolved strategy, rows tagged with a segment number).  For
    ``ranged`` the segments are contiguous ranges of (keys, order); callers
    compute their local windows and then :func:`pin` the result before
    deriving the per-segment summary from it."""
    keys, order = list(keys), list(order)
    resolved = choose_strategy(df, keys, strategy)
    if resolved == "window":
        return resolved, df.withColumn(SEG, F.lit(0))
    if resolved != "ranged":
        raise ValueError(f"unknown strategy {strategy!r}")
    n = num_segments or shuffle_partitions(df.sparkSession)
    exprs = [F.col(k).asc_nulls_last() for k in keys] + _ord(order)
    return resolved, df.repartitionByRange(n, *exprs).withColumn(SEG, F.spark_partition_id())


def pin(d: DataFrame) -> DataFrame:
    """Reliable checkpoint (shared ``spark.checkpoint.dir``) of the
    segmented, locally windowed rows: the segment assignment and the local
    window values are computed in exactly one job, and both the rows and
    their summary read the same materialisation (no second exchange, no
    recomputation that could cut different ranges)."""
    checkpoint_dir(d.sparkSession)
    return d.checkpoint(eager=True)


def segment(df: DataFrame, keys, order, strategy: str = "auto",
            num_segments: int | None = None) -> DataFrame:
    """Segment-tagged rows, pinned when ranged (for callers that window the
    result themselves)."""
    resolved, d = prepare(df, keys, order, strategy, num_segments)
    return pin(d) if resolved == "ranged" else d


def local_window(keys, order):
    return Window.partitionBy(*keys, SEG).orderBy(*_ord(order))


def running(w):
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def seg_window(keys):
    return Window.partitionBy(*keys).orderBy(SEG)


def attach(df: DataFrame, summary: DataFrame, keys) -> DataFrame:
    """Join per-segment carries back (null-safe on keys)."""
    keys = list(keys)
    on = [SEG] + keys
    s = summary.select(*[F.col(c).alias(f"__j{i}") for i, c in enumerate(on)],
                       *[c for c in summary.columns if c not in on])
    cond = reduce(lambda a, b: a & b,
                  [df[c].eqNullSafe(s[f"__j{i}"]) for i, c in enumerate(on)])
    out = df.join(s, cond, "left")
    return out.drop(*[f"__j{i}" for i in range(len(on))])


def carry_prev(df: DataFrame, keys, order, cols, strategy="auto", prefix="prev_") -> DataFrame:
    """``prev_<c>`` = value of ``c`` on the previous row of the same key in
    (order); NULL on the first row.  Adds ``_seg``/``_rn``."""
    keys, cols = list(keys), list(cols)
    resolved, d = prepare(df, keys, order, strategy)
    w = local_window(keys, order)
    d = d.withColumn(RN, F.row_number().over(w))
    for c in cols:
        d = d.withColumn(prefix + c, F.lag(c).over(w))
    if resolved == "window":
        return d
    d = pin(d)
    last = d.groupBy(*keys, SEG).agg(F.max_by(F.struct(*cols), F.col(RN)).alias("_last"))
    last = last.withColumn("_carry", F.lag("_last").over(seg_window(keys))).drop("_last")
    d = attach(d, last, keys)
    for c in cols:
        d = d.withColumn(prefix + c, F.when(F.col(RN) == 1, F.col("_carry")[c])
                         .otherwise(F.col(prefix + c)))
    return d.drop("_carry")


def position(df: DataFrame, keys, order, strategy="auto", pos="_pos", total="_n") -> DataFrame:
    """1-based row position within key in (order), and the key's row count."""
    keys = list(keys)
    resolved, d = prepare(df, keys, order, strategy)
    w = local_window(keys, order)
    d = d.withColumn(RN, F.row_number().over(w))
    if resolved == "window":
        return (d.withColumn(pos, F.col(RN).cast("long"))
                 .withColumn(total, F.count(F.lit(1)).over(Window.partitionBy(*keys))))
    d = pin(d)
    cnt = d.groupBy(*keys, SEG).agg(F.count(F.lit(1)).alias("_c"))
    ws = seg_window(keys)
    cnt = (cnt.withColumn("_off", F.coalesce(F.sum("_c").over(
                ws.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .withColumn(total, F.sum("_c").over(Window.partitionBy(*keys)))
              .drop("_c"))
    d = attach(d, cnt, keys)
    return d.withColumn(pos, (F.col("_off") + F.col(RN)).cast("long")).drop("_off")


def fill_forward_backward(df: DataFrame, keys, order, cols, strategy="auto", prev=()) -> DataFrame:
    """Forward fill, then back fill, per key in (order).  For columns of
    ``prev`` (none of ``cols``) the same scan adds ``prev_<c>``, see :func:`carry_prev`.

    After a forward fill only leading NULLs remain, and their back-fill value
    is the first non-NULL of the key; both come from per-segment carries."""
    keys, cols, prev = list(keys), list(cols), list(prev)
    resolved, d = prepare(df, keys, order, strategy)
    w = local_window(keys, order)
    d = d.withColumn(RN, F.row_number().over(w))
    d = d.withColumns({f"_ff_{c}": F.last(c, ignorenulls=True).over(running(w)) for c in cols}
                      | {f"prev_{c}": F.lag(c).over(w) for c in prev})
    if resolved == "window":
        whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        d = d.withColumns({c: F.coalesce(F.col(f"_ff_{c}"), F.first(c, ignorenulls=True).over(whole))
                           for c in cols})
        return d.drop(*[f"_ff_{c}" for c in cols])
    d = pin(d)
    aggs = []
    for c in cols:
        nn = F.when(F.col(c).isNotNull(), F.col(RN))
        aggs += [F.max_by(F.col(c), nn).alias(f"_lnn_{c}"), F.min_by(F.col(c), nn).alias(f"_fnn_{c}")]
    if prev:
        aggs.append(F.max_by(F.struct(*prev), F.col(RN)).alias("_last"))
    summ = d.groupBy(*keys, SEG).agg(*aggs)
    ws = seg_window(keys)
    before = ws.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys).orderBy(SEG).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    sel = [*keys, SEG]
    for c in cols:
        sel += [F.last(f"_lnn_{c}", ignorenulls=True).over(before).alias(f"_cf_{c}"),
                F.first(f"_fnn_{c}", ignorenulls=True).over(whole).alias(f"_cb_{c}")]
    if prev:
        sel.append(F.lag("_last").over(ws).alias("_carry"))
    summ = summ.select(*sel)
    d = attach(d, summ, keys)
    for c in cols:
        d = d.withColumn(c, F.coalesce(F.col(f"_ff_{c}"), F.col(f"_cf_{c}"), F.col(f"_cb_{c}")))
    d = d.withColumns({f"prev_{c}": F.when(F.col(RN) == 1, F.col("_carry")[c]).otherwise(F.col(f"prev_{c}")) for c in prev})
    return d.drop("_carry", *[f"_cf_{c}" for c in cols], *[f"_cb_{c}" for c in cols], *[f"_ff_{c}" for c in cols])


def _start_rule(y, us, gap, py, pus, null_time_splits: bool) -> Column:
    """A fault row opens an event when there is no previous row, the previous
    row is not a fault, or the time gap exceeds the limit (gap <= limit
    merges).  With ``null_time_splits`` a NULL time always opens a new event
    (the comparison is false); otherwise NULL time never splits."""
    within = (us - pus) <= gap
    gap_split = ~F.coalesce(within, F.lit(False)) if null_time_splits else \
        F.coalesce(~within, F.lit(False))
    start = (y == 1) & (py.isNull() | (py != 1) | gap_split)
    return F.coalesce(start, F.lit(False)).cast("int")


def islands(df: DataFrame, keys, ts: str, row_id: str, y: str, gap_us,
            null_time_splits: bool = True, strategy: str = "auto") -> DataFrame:
    """Run-based event numbering.  Adds ``_is_start`` and ``_event_no``
    (1-based per key; on a fault row it is the row's event).

    ``gap_us`` is a number or a per-row Column (microseconds)."""
    keys = list(keys)
    order = [ts, row_id]
    gap = gap_us if isinstance(gap_us, Column) else F.lit(float(gap_us))
    d = (df.withColumn("_y", F.coalesce(F.col(y).cast("int"), F.lit(0)))
           .withColumn("_us", F.timestamp_diff("MICROSECOND",
                                               F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                                               F.col(ts).cast("timestamp_ntz")))
           .withColumn("_gap", gap.cast("double")))
    resolved, d = prepare(d, keys, order, strategy)
    w = local_window(keys, order)
    prev = F.lag(F.struct(F.col("_y").alias("y"), F.col("_us").alias("us"))).over(w)
    d = d.withColumn(RN, F.row_number().over(w)).withColumn("_p", prev)
    rule = _start_rule(F.col("_y"), F.col("_us"), F.col("_gap"), F.col("_p.y"), F.col("_p.us"), null_time_splits)
    if resolved == "window":        # one segment per key: the lag is already complete
        d = d.withColumn("_is_start", rule)
        d = d.withColumn("_event_no", F.sum("_is_start").over(running(w)).cast("long"))
        return d.drop("_p", "_gap")
    d = d.withColumn("_inner", F.when(F.col(RN) > 1, rule).otherwise(F.lit(0)))
    d = d.withColumn("_cum", F.sum("_inner").over(running(w)))
    d = pin(d)
    summ = d.groupBy(*keys, SEG).agg(
        F.min_by(F.struct(F.col("_y").alias("y"), F.col("_us").alias("us"),
                          F.col("_gap").alias("gap")), F.col(RN)).alias("_first"),
        F.max_by(F.struct(F.col("_y").alias("y"), F.col("_us").alias("us")), F.col(RN)).alias("_last"),
        F.sum("_inner").alias("_n_inner"))
    ws = seg_window(keys)
    pl = F.lag("_last").over(ws)
    summ = (summ.withColumn("_pl", pl)
                .withColumn("_fs", _start_rule(F.col("_first.y"), F.col("_first.us"), F.col("_first.gap"),
                                               F.col("_pl.y"), F.col("_pl.us"), null_time_splits))
                .withColumn("_tot", F.col("_fs") + F.col("_n_inner")))
    summ = summ.select(*keys, SEG, "_fs", F.coalesce(F.sum("_tot").over(
        ws.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    d = attach(d, summ, keys)
    d = (d.withColumn("_is_start", F.when(F.col(RN) == 1, F.col("_fs")).otherwise(F.col("_inner")))
          .withColumn("_event_no", (F.col("_off") + F.col("_fs") + F.col("_cum")).cast("long")))
    return d.drop("_p", "_inner", "_cum", "_fs", "_off", "_gap")


def running_sums(df: DataFrame, keys, order, cols, strategy="auto", prefix="cum_",
                 total_prefix="tot_") -> DataFrame:
    """Inclusive running sums of ``cols`` per key in (order) plus per-key
    totals, carried across segments through the per-segment summary."""
    keys, cols = list(keys), list(cols)
    resolved, d = prepare(df, keys, order, strategy)
    w = local_window(keys, order)
    d = d.withColumns({prefix + c: F.sum(c).over(running(w)) for c in cols})
    if resolved == "window":
        return d.withColumns({total_prefix + c: F.sum(c).over(Window.partitionBy(*keys)) for c in cols})
    d = pin(d)
    summ = d.groupBy(*keys, SEG).agg(*[F.sum(c).alias(f"_s_{c}") for c in cols])
    ws = seg_window(keys)
    before = ws.rowsBetween(Window.unboundedPreceding, -1)
    summ = summ.select(*keys, SEG,
                       *[F.coalesce(F.sum(f"_s_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in cols],
                       *[F.sum(f"_s_{c}").over(Window.partitionBy(*keys)).alias(total_prefix + c) for c in cols])
    d = attach(d, summ, keys)
    d = d.withColumns({prefix + c: F.col(prefix + c) + F.col(f"_o_{c}") for c in cols})
    return d.drop(*[f"_o_{c}" for c in cols])
