"""Time-series queries."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import series as D
from ..sources import tele, tele_ev
from .catalog import EV_LAB_SQL, TELE_EV_SQL, TELE_SQL, finish, r6, register, tele_ev_sql
from .q_core import ev_labelled


@register("first_difference", f"""
WITH {TELE_SQL}
SELECT row_id, asset, round(coalesce(speed - lag(speed) OVER (PARTITION BY asset ORDER BY ts ASC NULLS LAST, row_id), 0), 6)
       AS acceleration FROM tele""")
def q_first_difference(spark, sf_dir):
    """Per-asset first difference of speed (segmented scan)."""
    t = tele(spark, sf_dir).select("row_id", "asset", "ts", "speed")
    return finish(D.first_difference(t, "speed", "acceleration", keys=["asset"]).select("row_id", "asset", "acceleration"))


@register("first_difference_global", f"""
WITH {TELE_EV_SQL}
SELECT row_id, round(coalesce((vibration - lag(vibration) OVER w)
                              / ((epoch_us(ts) - lag(epoch_us(ts)) OVER w) / 1000000.0), 0), 6) AS rate
FROM tele_ev WINDOW w AS (ORDER BY ts ASC NULLS LAST, row_id)""")
def q_first_difference_global(spark, sf_dir):
    """D1 in global order with the per-second option."""
    t = tele_ev(spark, sf_dir).select("row_id", "ts", "vibration")
    d = D.first_difference(t, "vibration", "rate", per_second=True).select("row_id", "rate")
    finite = F.abs("rate") < F.lit(float("inf"))          # false for NaN too: an infinite rate is not rounded
    return d.select("row_id", F.when(finite, r6(F.col("rate"))).otherwise(F.col("rate")).alias("rate"))


@register("rolling_time_mean", f"""
WITH {tele_ev_sql(7)},
sm AS (SELECT row_id, asset, ts, avg(vibration) OVER (PARTITION BY asset ORDER BY epoch_us(ts)
         RANGE BETWEEN 299999999 PRECEDING AND CURRENT ROW) AS vibration FROM tele_ev)
SELECT row_id, asset, round(coalesce(
   last_value(vibration IGNORE NULLS) OVER (PARTITION BY asset ORDER BY ts ASC NULLS LAST, row_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
   first_value(vibration IGNORE NULLS) OVER (PARTITION BY asset ORDER BY ts ASC NULLS LAST, row_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 6) AS vibration
FROM sm""")
def q_rolling_time_mean(spark, sf_dir):
    """5-minute left-open trailing mean per asset, then ffill/bfill."""
    t = tele_ev(spark, sf_dir, null_every=7).select("row_id", "asset", "ts", "vibration")
    return finish(D.rolling_time_mean(t, ["vibration"], 300.0, keys=["asset"]).select("row_id", "asset", "vibration"))


@register("rolling_row_mean", f"""
WITH {TELE_EV_SQL}
SELECT row_id, asset, round(avg(vibration) OVER (PARTITION BY asset ORDER BY ts ASC NULLS LAST, row_id
       ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 6) AS vibration FROM tele_ev""")
def q_rolling_row_mean(spark, sf_dir):
    """D3: trailing 5-row mean per asset."""
    t = tele_ev(spark, sf_dir).select("row_id", "asset", "ts", "vibration")
    return finish(D.rolling_row_mean(t, ["vibration"], 5, keys=["asset"]).select("row_id", "asset", "vibration"))


@register("calendar_keys", f"""
WITH {TELE_EV_SQL}
SELECT row_id, CAST(hour(ts) AS INTEGER) AS hour, date_trunc('day', ts) AS day, date_trunc('week', ts) AS week,
       date_trunc('month', ts) AS month FROM tele_ev""")
def q_calendar_keys(spark, sf_dir):
    return D.calendar_keys(tele_ev(spark, sf_dir).select("row_id", "ts")).drop("ts")


@register("faults_by_hour", f"""
WITH {EV_LAB_SQL},
h AS (SELECT CAST(range AS INTEGER) AS hour FROM range(24)),
c AS (SELECT CAST(hour(ts) AS INTEGER) AS hour, sum(label_fault) AS faults FROM ev_lab GROUP BY 1)
SELECT h.hour, CAST(coalesce(c.faults, 0) AS BIGINT) AS faults FROM h LEFT JOIN c USING (hour)""")
def q_faults_by_hour(spark, sf_dir):
    return D.faults_by_hour(ev_labelled(spark, sf_dir), "label_fault")


FILLED_DAILY_SQL = EV_LAB_SQL + """,
sums AS (SELECT date_trunc('day', ts) AS day, sum(label_fault) AS faults FROM ev_lab GROUP BY 1),
grid AS (SELECT unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS day FROM sums),
daily AS (SELECT g.day, CAST(coalesce(s.faults, 0) AS BIGINT) AS faults FROM grid g LEFT JOIN sums s USING (day))"""


@register("faults_daily", f"WITH {FILLED_DAILY_SQL} SELECT * FROM daily")
def q_faults_daily(spark, sf_dir):
    return D.faults_daily(ev_labelled(spark, sf_dir), "label_fault")


@register("faults_daily_rolling", f"""
WITH {FILLED_DAILY_SQL}
SELECT day, faults, round(avg(faults) OVER (ORDER BY day ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS rolling_mean
FROM daily""")
def q_faults_daily_rolling(spark, sf_dir):
    return finish(D.faults_daily_rolling(ev_labelled(spark, sf_dir), "label_fault"))


@register("faults_hourly", f"""
WITH {EV_LAB_SQL},
sums AS (SELECT date_trunc('hour', ts) AS hour_start, sum(label_fault) AS faults FROM ev_lab GROUP BY 1),
grid AS (SELECT unnest(generate_series(min(hour_start), max(hour_start), INTERVAL 1 HOUR)) AS hour_start FROM sums)
SELECT g.hour_start, CAST(coalesce(s.faults, 0) AS BIGINT) AS faults FROM grid g LEFT JOIN sums s USING (hour_start)""")
def q_faults_hourly(spark, sf_dir):
    return D.faults_hourly(ev_labelled(spark, sf_dir), "label_fault")


@register("traffic_regime", f"""
WITH {EV_LAB_SQL}
SELECT CASE WHEN isodow(ts) IN (6, 7) THEN 'weekend'
            WHEN hour(ts) BETWEEN 7 AND 9 OR hour(ts) BETWEEN 17 AND 19 THEN 'rush'
            WHEN hour(ts) BETWEEN 10 AND 16 THEN 'midday' ELSE 'quiet' END AS regime,
       count(*) AS n_rows, round(avg(CAST(label_fault AS DOUBLE)), 6) AS fault_rate
FROM ev_lab GROUP BY 1""")
def q_traffic_regime(spark, sf_dir):
    return finish(D.traffic_regime(ev_labelled(spark, sf_dir), "label_fault"))


@register("time_span", f"""
WITH {TELE_EV_SQL}
SELECT min(ts) AS time_min, max(ts) AS time_max,
       round((epoch_us(max(ts)) - epoch_us(min(ts))) / 3600000000.0, 6) AS span_hours,
       count(DISTINCT date_trunc('day', ts)) AS n_days FROM tele_ev""")
def q_time_span(spark, sf_dir):
    return finish(D.time_span(tele_ev(spark, sf_dir)))


@register("rolling_time_mean_global", f"""
WITH {tele_ev_sql(7)}
SELECT row_id, round(avg(vibration) OVER (ORDER BY epoch_us(ts) RANGE BETWEEN 299999999 PRECEDING AND CURRENT ROW), 6)
       AS vibration FROM tele_ev""")
def q_rolling_time_mean_global(spark, sf_dir):
    """D2 over the global time order (no asset): the prefix-sum form on the
    segmented scan, no fill (windows with only NULLs stay NULL)."""
    t = tele_ev(spark, sf_dir, null_every=7).select("row_id", "ts", "vibration")
    return finish(D.rolling_time_mean(t, ["vibration"], 300.0, fill=False).select("row_id", "vibration"))


@register("rolling_row_mean_global", f"""
WITH {tele_ev_sql(7)}
SELECT row_id, round(avg(vibration) OVER (ORDER BY ts ASC NULLS LAST, row_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 6)
       AS vibration FROM tele_ev""")
def q_rolling_row_mean_global(spark, sf_dir):
    """D3 over the global order: segments complete their first frames from
    the carried tail of the previous segment."""
    t = tele_ev(spark, sf_dir, null_every=7).select("row_id", "ts", "vibration")
    return finish(D.rolling_row_mean(t, ["vibration"], 5).select("row_id", "vibration"))
