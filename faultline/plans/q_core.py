"""First slice: thresholds, the 2-of-4 rule, run-based events, top events."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import events as E
from ..operators import labels as L
from ..sources import tele, tele_ev
from .catalog import (EV_LAB_SQL, TELE_SQL, events_agg_sql, finish, islands_sql, register)

RULE4 = ["vibration", "speed", "energy", "revolutions"]


def ev_labelled(spark, sf_dir, q=0.95):
    """tele_ev with fault = vibration > P95 (k = 1 of 1)."""
    return L.k_of_n(tele_ev(spark, sf_dir), ["vibration"], q=q, k=1, op=">")


@register("quantile_thresholds", f"""
WITH {TELE_SQL}
SELECT 'vibration' AS feature, CAST(0.95 AS DOUBLE) AS quantile, round(quantile_cont(vibration, 0.95), 6) AS threshold FROM tele
UNION ALL SELECT 'speed', CAST(0.95 AS DOUBLE), round(quantile_cont(speed, 0.95), 6) FROM tele
UNION ALL SELECT 'energy', CAST(0.95 AS DOUBLE), round(quantile_cont(energy, 0.95), 6) FROM tele
UNION ALL SELECT 'revolutions', CAST(0.95 AS DOUBLE), round(quantile_cont(revolutions, 0.95), 6) FROM tele
""")
def q_quantile_thresholds(spark, sf_dir):
    t = tele(spark, sf_dir)
    thr = L.quantile_thresholds(t, RULE4, 0.95)
    return finish(L.thresholds_frame(spark, thr, 0.95))


@register("label_2of4", f"""
WITH {TELE_SQL},
thr AS (SELECT quantile_cont(vibration, 0.95) AS v, quantile_cont(speed, 0.95) AS s,
               quantile_cont(energy, 0.95) AS e, quantile_cont(revolutions, 0.95) AS r FROM tele)
SELECT row_id, asset,
       CAST((CAST(coalesce(vibration > v, false) AS INTEGER) + CAST(coalesce(speed > s, false) AS INTEGER)
           + CAST(coalesce(energy > e, false) AS INTEGER) + CAST(coalesce(revolutions > r, false) AS INTEGER)) >= 2
            AS INTEGER) AS label_fault
FROM tele CROSS JOIN thr
""")
def q_label_2of4(spark, sf_dir):
    t = tele(spark, sf_dir)
    return L.k_of_n(t, RULE4, q=0.95, k=2, op=">").select("row_id", "asset", "label_fault")


@register("events_run", f"""
WITH {EV_LAB_SQL},
{islands_sql("ev_lab", "600000000.0")}
{events_agg_sql("isl")}
""")
def q_events_run(spark, sf_dir):
    ev = E.fault_events(ev_labelled(spark, sf_dir), gap_sec=600.0)
    return finish(ev)


@register("top_events", f"""
WITH {EV_LAB_SQL},
{islands_sql("ev_lab", "600000000.0")},
evs AS ({events_agg_sql("isl")})
SELECT * FROM evs ORDER BY duration_s DESC NULLS LAST, event_id LIMIT 10
""")
def q_top_events(spark, sf_dir):
    ev = E.fault_events(ev_labelled(spark, sf_dir), gap_sec=600.0)
    return finish(E.top_events(ev, 10))
