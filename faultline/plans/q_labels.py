"""Labelling queries."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import labels as L
from ..operators import series as D
from ..sources import tele
from .catalog import TELE_SQL, finish, register

RULE4 = ["vibration", "speed", "energy", "revolutions"]
# C7 literal cut-offs sized for the tele fixture (the reference's own file
# used 0.9 for every column on its unit-scaled data).
ABS_THRESHOLDS = {"acceleration": 0.0, "speed": 0.05, "energy": 0.04, "vibration": 25.0}
MANUAL_P = {"vibration": 0.90, "revolutions": 0.85, "speed": 0.85}

TELE_ACC_SQL = TELE_SQL + """,
tele_acc AS (SELECT *, coalesce(speed - lag(speed) OVER (PARTITION BY asset ORDER BY ts ASC NULLS LAST, row_id), 0)
             AS acceleration FROM tele)"""


def _flag(expr):
    return f"CAST(coalesce({expr}, false) AS INTEGER)"


def tele_acc(spark, sf_dir):
    return D.first_difference(tele(spark, sf_dir), "speed", "acceleration", keys=["asset"])


@register("threshold_ladder", f"""
WITH {TELE_SQL},
q AS (SELECT quantile_cont(vibration, 0.9) AS a, quantile_cont(vibration, 0.925) AS b,
             quantile_cont(vibration, 0.95) AS c, quantile_cont(vibration, 0.975) AS d FROM tele)
SELECT row_id, {_flag('vibration >= a')} AS Fault_900, {_flag('vibration >= b')} AS Fault_925,
       {_flag('vibration >= c')} AS Fault_950, {_flag('vibration >= d')} AS Fault_975
FROM tele CROSS JOIN q""")
def q_threshold_ladder(spark, sf_dir):
    t = L.threshold_ladder(tele(spark, sf_dir), "vibration")
    return t.select("row_id", *L.LADDER_NAMES)


@register("label_2of3_abs", f"""
WITH {TELE_SQL},
q AS (SELECT quantile_cont(vibration, 0.9) AS v, quantile_cont(revolutions, 0.85) AS r,
             quantile_cont(abs(speed), 0.85) AS s FROM tele)
SELECT row_id, CAST(({_flag('vibration >= v')} + {_flag('revolutions >= r')} + {_flag('abs(speed) >= s')}) >= 2 AS INTEGER)
       AS Fault_Combo2of3 FROM tele CROSS JOIN q""")
def q_label_2of3_abs(spark, sf_dir):
    """C4 (manual-percentile mode): 2-of-3, >=, per-column percentile, |speed|."""
    t = L.k_of_n(tele(spark, sf_dir), ["vibration", "revolutions", "speed"], q=MANUAL_P, k=2, op=">=",
                 abs_cols=["speed"], label="Fault_Combo2of3")
    return t.select("row_id", "Fault_Combo2of3")


@register("label_2of3", f"""
WITH {TELE_SQL},
q AS (SELECT quantile_cont(vibration, 0.95) AS v, quantile_cont(speed, 0.95) AS s,
             quantile_cont(revolutions, 0.95) AS r FROM tele)
SELECT row_id, CAST(({_flag('vibration > v')} + {_flag('speed > s')} + {_flag('revolutions > r')}) >= 2 AS INTEGER)
       AS label_fault FROM tele CROSS JOIN q""")
def q_label_2of3(spark, sf_dir):
    """The prose rule, P95, strict >, signed."""
    t = L.k_of_n(tele(spark, sf_dir), ["vibration", "speed", "revolutions"], q=0.95, k=2, op=">")
    return t.select("row_id", "label_fault")


def _autotune_sql(exact: bool = False):
    """The 125 combinations rated by SQL; ``exact``: over an outer view
    ``tele`` and unrounded, for use inside another query."""
    six = (lambda e: e) if exact else (lambda e: f"round({e}, 6)")
    rows, idx = [], 0
    for i, pv in enumerate(L.TUNE_VIB_GRID):
        for j, pr in enumerate(L.TUNE_REV_GRID):
            for m, ps in enumerate(L.TUNE_SPD_GRID):
                rows.append(f"({idx}, {pv}, {pr}, {ps}, {i + 1}, {j + 1}, {m + 1})")
                idx += 1
    lst = lambda g: "[" + ", ".join(str(x) for x in g) + "]"
    return f"""
WITH {"" if exact else TELE_SQL + ","}
thr AS (SELECT quantile_cont(vibration, {lst(L.TUNE_VIB_GRID)}) AS tv,
               quantile_cont(revolutions, {lst(L.TUNE_REV_GRID)}) AS tr,
               quantile_cont(abs(speed), {lst(L.TUNE_SPD_GRID)}) AS tsp FROM tele),
grid AS (SELECT * FROM (VALUES {", ".join(rows)}) g(combo, vib_p, rev_p, spd_p, i, j, m)),
cand AS (SELECT g.combo, CAST(g.vib_p AS DOUBLE) AS vib_p, CAST(g.rev_p AS DOUBLE) AS rev_p,
                CAST(g.spd_p AS DOUBLE) AS spd_p, t.tv[g.i] AS thr_vibration, t.tr[g.j] AS thr_revolutions,
                t.tsp[g.m] AS thr_speed_abs FROM grid g CROSS JOIN thr t),
rated AS (SELECT c.*, (SELECT CAST(sum(CASE WHEN ({_flag('x.vibration >= c.thr_vibration')}
                              + {_flag('x.revolutions >= c.thr_revolutions')}
                              + {_flag('abs(x.speed) >= c.thr_speed_abs')}) >= 2 THEN 1 ELSE 0 END) AS DOUBLE)
                              / count(*) FROM tele x) AS rate FROM cand c)
SELECT vib_p, rev_p, spd_p, {six("rate")} AS rate, {six("thr_vibration")} AS thr_vibration,
       {six("thr_revolutions")} AS thr_revolutions, {six("thr_speed_abs")} AS thr_speed_abs
FROM rated ORDER BY abs(rate - CAST(0.08 AS DOUBLE)), combo LIMIT 1"""


@register("autotune_combo", _autotune_sql())
def q_autotune_combo(spark, sf_dir):
    """Single-pass grade histogram search over the 5x5x5 grid."""
    return finish(L.autotune(tele(spark, sf_dir)))


@register("label_absolute", f"""
WITH {TELE_ACC_SQL}
SELECT row_id, CAST(({_flag('acceleration >= 0.0')} + {_flag('speed >= 0.05')} + {_flag('energy >= 0.04')}
       + {_flag('vibration >= 25.0')}) >= 2 AS INTEGER) AS Fault_Combo FROM tele_acc""")
def q_label_absolute(spark, sf_dir):
    """Literal cut-offs, 2-of-4, >=, with acceleration (D1 per asset)."""
    t = L.k_of_n(tele_acc(spark, sf_dir), list(ABS_THRESHOLDS), k=2, op=">=", thresholds=ABS_THRESHOLDS,
                 label="Fault_Combo")
    return t.select("row_id", "Fault_Combo")


@register("label_flags", f"""
WITH {TELE_ACC_SQL},
q AS (SELECT quantile_cont(vibration, 0.9) AS v, quantile_cont(revolutions, 0.9) AS r,
             quantile_cont(acceleration, 0.9) AS a, quantile_cont(speed, 0.9) AS s FROM tele_acc),
f AS (SELECT row_id, {_flag('vibration >= v')} AS vibration_fault, {_flag('revolutions >= r')} AS revolutions_fault,
             {_flag('acceleration >= a')} AS acceleration_fault, {_flag('speed >= s')} AS speed_fault
      FROM tele_acc CROSS JOIN q)
SELECT *, CAST(vibration_fault + revolutions_fault + acceleration_fault + speed_fault >= 2 AS INTEGER) AS Fault_Combo FROM f""")
def q_label_flags(spark, sf_dir):
    """2-of-4 at P90 with acceleration, keeping one flag per sensor."""
    cols = ["vibration", "revolutions", "acceleration", "speed"]
    t = L.k_of_n(tele_acc(spark, sf_dir), cols, q=0.90, k=2, op=">=", keep_flags=True, label="Fault_Combo")
    return t.select("row_id", *[f"{c}_fault" for c in cols], "Fault_Combo")


@register("threshold_stress", f"""
WITH {TELE_SQL},
q AS (SELECT quantile_cont(vibration, 0.95) AS v, quantile_cont(speed, 0.95) AS s,
             quantile_cont(energy, 0.95) AS e, quantile_cont(revolutions, 0.95) AS r FROM tele),
f AS (SELECT CAST(x AS DOUBLE) AS factor FROM (VALUES (0.8), (0.9), (1.0), (1.1), (1.2)) v(x))
SELECT f.factor, round(avg(CASE WHEN ({_flag('vibration > v * f.factor')} + {_flag('speed > s * f.factor')}
       + {_flag('energy > e * f.factor')} + {_flag('revolutions > r * f.factor')}) >= 2 THEN 1.0 ELSE 0.0 END), 6) AS fault_rate
FROM tele CROSS JOIN q CROSS JOIN f GROUP BY f.factor""")
def q_threshold_stress(spark, sf_dir):
    """Fault rate per threshold factor, one aggregate."""
    return finish(L.threshold_stress(tele(spark, sf_dir), RULE4))


def _rule4_sql(name="label_fault"):
    return (f"CAST(({_flag('vibration > v')} + {_flag('speed > s')} + {_flag('energy > e')} "
            f"+ {_flag('revolutions > r')}) >= 2 AS INTEGER) AS {name}")


Q4_SQL = """q4 AS (SELECT quantile_cont(vibration, 0.95) AS v, quantile_cont(speed, 0.95) AS s,
             quantile_cont(energy, 0.95) AS e, quantile_cont(revolutions, 0.95) AS r,
             quantile_cont(vibration, 0.9) AS p90 FROM tele)"""


@register("class_balance", f"""
WITH {TELE_SQL}, {Q4_SQL},
lab AS (SELECT {_rule4_sql()}, {_flag('vibration >= p90')} AS Fault_900 FROM tele CROSS JOIN q4),
dom AS (SELECT * FROM (VALUES (0), (1)) d(value)),
c AS (SELECT 'label_fault' AS label, d.value, (SELECT count(*) FROM lab WHERE label_fault = d.value) AS count FROM dom d
      UNION ALL
      SELECT 'Fault_900', d.value, (SELECT count(*) FROM lab WHERE Fault_900 = d.value) FROM dom d)
SELECT label, CAST(value AS INTEGER) AS value, CAST(count AS BIGINT) AS count,
       round(CAST(count AS DOUBLE) / (SELECT count(*) FROM lab), 6) AS share FROM c""")
def q_class_balance(spark, sf_dir):
    """Counts and shares per class (zero-filled), several labels at once."""
    t = L.threshold_ladder(L.k_of_n(tele(spark, sf_dir), RULE4), "vibration", qs=[0.90], names=["Fault_900"])
    return finish(L.class_balance(t, ["label_fault", "Fault_900"]))


@register("ladder_counts", f"""
WITH {TELE_SQL},
q AS (SELECT quantile_cont(vibration, 0.9) AS a, quantile_cont(vibration, 0.925) AS b,
             quantile_cont(vibration, 0.95) AS c, quantile_cont(vibration, 0.975) AS d FROM tele),
l AS (SELECT {_flag('vibration >= a')} AS f1, {_flag('vibration >= b')} AS f2, {_flag('vibration >= c')} AS f3,
             {_flag('vibration >= d')} AS f4 FROM tele CROSS JOIN q)
SELECT 'Fault_900' AS label, CAST(sum(f1) AS BIGINT) AS count, round(sum(f1) * 100.0 / count(*), 6) AS pct FROM l
UNION ALL SELECT 'Fault_925', CAST(sum(f2) AS BIGINT), round(sum(f2) * 100.0 / count(*), 6) FROM l
UNION ALL SELECT 'Fault_950', CAST(sum(f3) AS BIGINT), round(sum(f3) * 100.0 / count(*), 6) FROM l
UNION ALL SELECT 'Fault_975', CAST(sum(f4) AS BIGINT), round(sum(f4) * 100.0 / count(*), 6) FROM l""")
def q_ladder_counts(spark, sf_dir):
    """C11: positives per ladder label with percentage of rows."""
    t = L.threshold_ladder(tele(spark, sf_dir), "vibration")
    return finish(L.ladder_counts(t))
