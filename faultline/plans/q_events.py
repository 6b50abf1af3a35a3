"""Event queries (E1 per asset, E2-E10)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import events as E
from ..operators import labels as L
from ..sources import tele_ev
from .catalog import EV_LAB_SQL, TELE_EV_SQL, events_agg_sql, finish, islands_sql, register
from .q_core import ev_labelled

# tele_ev with fault = vibration > P60: longer runs for the gap-mode queries
EV60_SQL = TELE_EV_SQL + """,
ev60_thr AS (SELECT quantile_cont(vibration, 0.6) AS p FROM tele_ev),
ev_lab AS (SELECT e.*, CASE WHEN e.vibration > t.p THEN 1 ELSE 0 END AS label_fault
           FROM tele_ev e CROSS JOIN ev60_thr t)"""

FAULT_GAPS_SQL = """fg AS (
  SELECT (epoch_us(ts) - lag(epoch_us(ts)) OVER (ORDER BY ts ASC NULLS LAST, row_id)) / 1000000.0 AS gap_s
  FROM ev_lab WHERE label_fault = 1)"""


def ev60(spark, sf_dir):
    return L.k_of_n(tele_ev(spark, sf_dir), ["vibration"], q=0.6, k=1, op=">")


def _bucket_sql(grain):
    return "CAST(hour AS VARCHAR)" if grain == "hour" else f"strftime({grain}, '%Y-%m-%d')"


@register("events_run_by_asset", f"""
WITH {EV_LAB_SQL},
{islands_sql("ev_lab", "600000000.0", partition="asset")}
{events_agg_sql("isl", keys="asset")}""")
def q_events_run_by_asset(spark, sf_dir):
    """E1 keyed by asset (segmented scan keyed by asset)."""
    return finish(E.fault_events(ev_labelled(spark, sf_dir), gap_sec=600.0, keys=["asset"]))


@register("event_ids", f"""
WITH {EV_LAB_SQL},
{islands_sql("ev_lab", "300000000.0", null_splits=False)}
SELECT row_id, CAST(CASE WHEN label_fault = 1 THEN event_no - 1 ELSE -1 END AS BIGINT) AS event_id FROM isl""")
def q_event_ids(spark, sf_dir):
    """Per-row event ids, 5-minute gap, -1 for normal rows."""
    d = E.event_ids(ev_labelled(spark, sf_dir).select("row_id", "ts", "label_fault"), gap_min=5.0)
    return d.select("row_id", "event_id")


@register("learned_gap", f"""
WITH {EV_LAB_SQL}, {FAULT_GAPS_SQL}
SELECT round(coalesce(least(greatest(quantile_cont(gap_s, 0.95), 60.0), 900.0), 60.0), 6) AS gap_seconds
FROM fg WHERE gap_s < 86400""")
def q_learned_gap(spark, sf_dir):
    """P95 of fault gaps under one day, clamped to [60, 900]."""
    g = E.learn_gap(ev_labelled(spark, sf_dir))
    return finish(spark.range(1).select(F.lit(g).cast("double").alias("gap_seconds")))


@register("gap_quantile_global", f"""
WITH {EV60_SQL}, {FAULT_GAPS_SQL},
g AS (SELECT gap_s FROM fg WHERE gap_s IS NOT NULL AND gap_s < 86400)
SELECT round(CASE WHEN count(*) >= 10 THEN quantile_cont(gap_s, 0.95)
                  WHEN count(*) >= 5 THEN quantile_cont(gap_s, 0.8) ELSE 10.0 END, 6) AS gap_seconds FROM g""")
def q_gap_quantile_global(spark, sf_dir):
    """Global gap quantile with the min-gap / retry / fallback chain."""
    g = E.gap_quantile_global(ev60(spark, sf_dir), q=0.95)
    return finish(spark.range(1).select(F.lit(g).cast("double").alias("gap_seconds")))


@register("events_gap_quantile", f"""
WITH {EV60_SQL}, {FAULT_GAPS_SQL},
gs AS (SELECT gap_s FROM fg WHERE gap_s IS NOT NULL AND gap_s < 86400),
gq AS (SELECT CASE WHEN count(*) >= 10 THEN quantile_cont(gap_s, 0.8)
                   WHEN count(*) >= 5 THEN quantile_cont(gap_s, 0.8) ELSE 10.0 END AS gap FROM gs),
src AS (SELECT l.row_id, l.ts, l.label_fault, gq.gap AS row_gap FROM ev_lab l CROSS JOIN gq),
{islands_sql("src", "row_gap * 1000000.0")}
{events_agg_sql("isl")}""")
def q_events_gap_quantile(spark, sf_dir):
    """E4 fed to E1: run-based events merged at the global gap quantile."""
    lab = ev60(spark, sf_dir)
    return finish(E.fault_events(lab, gap_sec=E.gap_quantile_global(lab, q=0.8)))


@register("events_gap_per_day", f"""
WITH {EV60_SQL},
lab AS (SELECT * FROM ev_lab WHERE ts IS NOT NULL),
f AS (SELECT ts, row_id, date_trunc('day', ts) AS day FROM lab WHERE label_fault = 1),
dg AS (SELECT day, (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY day ORDER BY ts, row_id)) / 1000000.0 AS gap_s FROM f),
daily AS (SELECT day, quantile_cont(gap_s, 0.9) AS gap_s FROM dg WHERE gap_s IS NOT NULL AND gap_s < 86400
          GROUP BY day HAVING count(*) >= 6),
gg AS (SELECT (epoch_us(ts) - lag(epoch_us(ts)) OVER (ORDER BY ts, row_id)) / 1000000.0 AS gap_s FROM f),
gfb AS (SELECT CASE WHEN count(*) >= 5 THEN quantile_cont(gap_s, 0.8) ELSE 3.0 END AS g
         FROM gg WHERE gap_s IS NOT NULL AND gap_s < 86400),
src AS (SELECT l.row_id, l.ts, l.label_fault, coalesce(d.gap_s, gfb.g) AS row_gap
        FROM lab l LEFT JOIN daily d ON date_trunc('day', l.ts) = d.day CROSS JOIN gfb),
{islands_sql("src", "row_gap * 1000000.0")}
SELECT event_no AS event_id, min(ts) AS start, max(ts) AS "end",
       round(greatest((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0, 0.0), 6) AS duration_s, count(*) AS n_rows,
       round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0 / 60.0, 6) AS duration_min,
       CAST(hour(min(ts)) AS INTEGER) AS hour, date_trunc('day', min(ts)) AS day,
       date_trunc('week', min(ts)) AS week, date_trunc('month', min(ts)) AS month
FROM isl WHERE label_fault = 1 GROUP BY event_no""")
def q_events_gap_per_day(spark, sf_dir):
    """E5: per-day quantile merge gap (q = 0.9, >= 6 gaps a day), global
    fallback at min(0.8, q), then 3 s."""
    ev = E.events_gap_per_day(ev60(spark, sf_dir), q=0.9, fallback_sec=3.0)
    return finish(ev)


GAP_MERGE_SQL = """{lab},
fr AS (SELECT * FROM ev_lab WHERE label_fault = 1),
{isl}
SELECT {k}event_no AS ticket_id, min(ts) AS start, max(ts) AS "end",
       round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0, 6) AS duration_s, count(*) AS n_rows
FROM isl GROUP BY {k}event_no"""


@register("events_gap_merge", "WITH " + GAP_MERGE_SQL.format(
    lab=EV_LAB_SQL, isl=islands_sql("fr", "600000000.0"), k=""))
def q_events_gap_merge(spark, sf_dir):
    """Gap-merge tickets over fault rows only, 600 s, global order."""
    return finish(E.gap_merge(ev_labelled(spark, sf_dir), gap_sec=600.0))


@register("events_gap_merge_by_asset", "WITH " + GAP_MERGE_SQL.format(
    lab=EV_LAB_SQL, isl=islands_sql("fr", "3600000000.0", partition="asset"), k="asset, "))
def q_events_gap_merge_by_asset(spark, sf_dir):
    """E6 per asset, 3,600 s (the batch twin of the streaming tickets)."""
    return finish(E.gap_merge(ev_labelled(spark, sf_dir), gap_sec=3600.0, keys=["asset"]))


LEARNED_EVENTS_SQL = EV_LAB_SQL + f""", {FAULT_GAPS_SQL},
learned AS (SELECT coalesce(least(greatest(quantile_cont(gap_s, 0.95), 60.0), 900.0), 60.0) AS g
            FROM fg WHERE gap_s < 86400),
src AS (SELECT e.*, l.g AS row_gap FROM ev_lab e CROSS JOIN learned l),
{islands_sql("src", "row_gap * 1000000.0")},
evs AS ({events_agg_sql("isl")})"""


@register("event_summary", f"""
WITH {LEARNED_EVENTS_SQL}
SELECT count(*) AS n_events, round(coalesce(avg(duration_min), 0.0), 6) AS duration_min_mean,
       round(coalesce(quantile_cont(duration_min, 0.5), 0.0), 6) AS duration_min_p50,
       round(coalesce(quantile_cont(duration_min, 0.95), 0.0), 6) AS duration_min_p95,
       (SELECT strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') FROM tele_ev) AS time_min,
       (SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') FROM tele_ev) AS time_max,
       (SELECT round((epoch_us(max(ts)) - epoch_us(min(ts))) / 3600000000.0, 6) FROM tele_ev) AS span_hours,
       round((SELECT g FROM learned), 6) AS merge_gap_seconds_used
FROM evs""")
def q_event_summary(spark, sf_dir):
    """Learned gap -> run-based events -> one summary row."""
    lab = ev_labelled(spark, sf_dir)
    gap = E.learn_gap(lab)
    ev = E.fault_events(lab, gap_sec=gap)
    return finish(E.event_summary(ev, rows=lab, gap_used=gap))


RUN_EVENTS_SQL = EV_LAB_SQL + f""",
{islands_sql("ev_lab", "600000000.0")},
evs AS ({events_agg_sql("isl")})"""


@register("events_per_grain", f"""
WITH {RUN_EVENTS_SQL},
h AS (SELECT CAST(range AS INTEGER) AS hour FROM range(24)),
bh AS (SELECT hour, count(DISTINCT event_id) AS n FROM evs GROUP BY hour)
SELECT 'hour' AS grain, CAST(h.hour AS VARCHAR) AS bucket, CAST(coalesce(bh.n, 0) AS BIGINT) AS n_events
FROM h LEFT JOIN bh USING (hour)
UNION ALL SELECT 'day', strftime(day, '%Y-%m-%d'), count(DISTINCT event_id) FROM evs GROUP BY day
UNION ALL SELECT 'week', strftime(week, '%Y-%m-%d'), count(DISTINCT event_id) FROM evs GROUP BY week
UNION ALL SELECT 'month', strftime(month, '%Y-%m-%d'), count(DISTINCT event_id) FROM evs GROUP BY month""")
def q_events_per_grain(spark, sf_dir):
    """Distinct events per hour of day (zero filled), day, week, month."""
    ev = E.fault_events(ev_labelled(spark, sf_dir), gap_sec=600.0)
    parts = []
    for g in ("hour", "day", "week", "month"):
        c = E.events_per_grain(ev, g)
        key = F.col(g).cast("string") if g == "hour" else F.date_format(g, "yyyy-MM-dd")
        parts.append(c.select(F.lit(g).alias("grain"), key.alias("bucket"), "n_events"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("events_adaptive_grain", f"""
WITH {RUN_EVENTS_SQL},
span AS (SELECT count(DISTINCT week) AS w, count(DISTINCT month) AS m FROM evs),
h AS (SELECT CAST(range AS INTEGER) AS hour FROM range(24)),
bh AS (SELECT hour, count(DISTINCT event_id) AS n FROM evs GROUP BY hour)
SELECT 'weekly_or_hourly' AS panel, 'week' AS grain, strftime(week, '%Y-%m-%d') AS bucket,
       count(DISTINCT event_id) AS n_events FROM evs WHERE (SELECT w FROM span) >= 2 GROUP BY week
UNION ALL
SELECT 'weekly_or_hourly', 'hour', CAST(h.hour AS VARCHAR), CAST(coalesce(bh.n, 0) AS BIGINT)
FROM h LEFT JOIN bh USING (hour) WHERE (SELECT w FROM span) < 2
UNION ALL
SELECT 'monthly_or_daily', 'month', strftime(month, '%Y-%m-%d'), count(DISTINCT event_id)
FROM evs WHERE (SELECT m FROM span) >= 2 GROUP BY month
UNION ALL
SELECT 'monthly_or_daily', 'day', strftime(day, '%Y-%m-%d'), count(DISTINCT event_id)
FROM evs WHERE (SELECT m FROM span) < 2 GROUP BY day""")
def q_events_adaptive_grain(spark, sf_dir):
    """Weekly vs hourly and monthly vs daily by the events' coverage."""
    ev = E.fault_events(ev_labelled(spark, sf_dir), gap_sec=600.0)
    return E.events_adaptive_grain(ev)


@register("event_duration_hist", f"""
WITH {RUN_EVENTS_SQL},
p AS (SELECT quantile_cont(duration_min, 0.99) AS p99 FROM evs),
x AS (SELECT least(greatest(duration_min, 0.0), p.p99) AS x FROM evs CROSS JOIN p),
r0 AS (SELECT min(x) AS a, max(x) AS b FROM x),
r AS (SELECT CASE WHEN a = b THEN a - 0.5 ELSE a END AS lo, CASE WHEN a = b THEN b + 0.5 ELSE b END AS hi FROM r0),
w AS (SELECT lo, (hi - lo) / 30 AS w FROM r),
c AS (SELECT CAST(least(floor((x - w.lo) / w.w), 29) AS INTEGER) AS bin, count(*) AS n FROM x CROSS JOIN w GROUP BY 1),
b AS (SELECT CAST(range AS INTEGER) AS bin FROM range(30))
SELECT b.bin, round(w.lo + b.bin * w.w, 6) AS lo, round(w.lo + (b.bin + 1) * w.w, 6) AS hi,
       CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM b CROSS JOIN w LEFT JOIN c USING (bin)""")
def q_event_duration_hist(spark, sf_dir):
    """30-bin duration histogram clipped at P99."""
    ev = E.fault_events(ev_labelled(spark, sf_dir), gap_sec=600.0)
    return finish(E.duration_histogram(ev))


@register("event_summary_modes", f"""
WITH {EV60_SQL},
lab AS (SELECT * FROM ev_lab WHERE ts IS NOT NULL),
f AS (SELECT ts, row_id, date_trunc('day', ts) AS day FROM lab WHERE label_fault = 1),
dg AS (SELECT day, (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY day ORDER BY ts, row_id)) / 1000000.0 AS gap_s FROM f),
daily AS (SELECT day, quantile_cont(gap_s, 0.9) AS gap_s FROM dg WHERE gap_s IS NOT NULL AND gap_s < 86400
          GROUP BY day HAVING count(*) >= 6),
gg AS (SELECT (epoch_us(ts) - lag(epoch_us(ts)) OVER (ORDER BY ts, row_id)) / 1000000.0 AS gap_s FROM f),
gfb AS (SELECT CASE WHEN count(*) >= 5 THEN quantile_cont(gap_s, 0.8) ELSE 3.0 END AS g
        FROM gg WHERE gap_s IS NOT NULL AND gap_s < 86400),
src AS (SELECT l.row_id, l.ts, l.label_fault, coalesce(d.gap_s, gfb.g) AS row_gap
        FROM lab l LEFT JOIN daily d ON date_trunc('day', l.ts) = d.day CROSS JOIN gfb),
{islands_sql("src", "row_gap * 1000000.0")},
evs AS (SELECT event_no, min(ts) AS start, max(ts) AS "end" FROM isl WHERE label_fault = 1 GROUP BY event_no)
SELECT 'quantile-per-day' AS gap_mode_used, CAST(NULL AS DOUBLE) AS merge_gap_seconds_used,
       CAST(0.9 AS DOUBLE) AS quantile_used, round((SELECT g FROM gfb), 6) AS global_quantile_gap_sec,
       (SELECT count(*) FROM daily) AS daily_threshold_days, CAST(3.0 AS DOUBLE) AS fallback_sec,
       count(*) AS n_events, count(DISTINCT date_trunc('day', start)) AS span_days,
       coalesce(strftime(min(start), '%Y-%m-%d %H:%M:%S.%f'), '') AS first_ts,
       coalesce(strftime(max("end"), '%Y-%m-%d %H:%M:%S.%f'), '') AS last_ts
FROM evs""")
def q_event_summary_modes(spark, sf_dir):
    """E7 extended summary of the per-day quantile mode (E5)."""
    lab = ev60(spark, sf_dir)
    ev = E.events_gap_per_day(lab, q=0.9, fallback_sec=3.0)
    d = lab.where(F.col("ts").isNotNull())
    glob = E.gap_quantile_global(d, q=0.8, min_gaps=5, fallback_sec=3.0, retry=False)
    days = E.daily_gap_thresholds(d, q=0.9, min_gaps=6).count()
    return finish(E.event_summary_modes(ev, "quantile-per-day", None, 0.9, glob, days, 3.0))
