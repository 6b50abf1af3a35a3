"""The processed table (raw columns -> difference, fill, ladder, tuned label, fixed order)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.preprocess import processed_table
from ..sources import tele
from ..sources.io import PROCESSED_COLUMNS
from .catalog import TELE_SQL, finish, register
from .q_labels import _autotune_sql

_SENSORS = [c for c in PROCESSED_COLUMNS[1:10] if c != "acceleration"]
_O = "ORDER BY ts ASC NULLS LAST, row_id"
_FILL = ", ".join(
    f"coalesce(last_value({c} IGNORE NULLS) OVER ({_O} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
    f"first_value({c} IGNORE NULLS) OVER ({_O} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {c}"
    for c in _SENSORS)
_RULE = ("CAST(coalesce(vibration >= thr_vibration, false) AS INTEGER) "
         "+ CAST(coalesce(revolutions >= thr_revolutions, false) AS INTEGER) "
         "+ CAST(coalesce(abs(speed) >= thr_speed_abs, false) AS INTEGER) >= 2")


@register("processed_table", f"""
WITH base AS (SELECT * FROM (WITH {TELE_SQL} SELECT * FROM tele)),
keyed AS (
  SELECT strftime(l_shipdate, '%Y%m%d') || '-' || lpad(CAST(l_orderkey AS VARCHAR), 12, '0') || '-'
         || lpad(CAST(l_linenumber AS VARCHAR), 3, '0') || '-' || lpad(CAST(l_partkey AS VARCHAR), 12, '0') AS row_id,
         CAST(l_tax AS DOUBLE) * 100.0 AS temperature, CAST(l_partkey AS DOUBLE) AS signal_strength,
         CAST(l_suppkey AS DOUBLE) AS motor_cycles, l_orderkey AS k FROM lineitem),
raw AS (
  SELECT row_id, ts, temperature, CASE WHEN k % 13 = 0 THEN NULL ELSE speed END AS speed, humidity,
         CASE WHEN k % 11 = 0 THEN NULL ELSE vibration END AS vibration, revolutions, signal_strength, energy, motor_cycles
  FROM base JOIN keyed USING (row_id)),
tele AS (SELECT row_id, ts, coalesce(speed - lag(speed) OVER ({_O}), 0.0) AS acceleration, {_FILL} FROM raw),
tuned AS ({_autotune_sql(exact=True)}),
lad AS (SELECT quantile_cont(vibration, 0.9) AS v900, quantile_cont(vibration, 0.925) AS v925,
               quantile_cont(vibration, 0.95) AS v950, quantile_cont(vibration, 0.975) AS v975 FROM tele)
SELECT row_id, ts AS timestamp, {", ".join(f"round({c}, 6) AS {c}" for c in PROCESSED_COLUMNS[1:10])},
       {", ".join(f'CAST(coalesce(vibration >= v{n}, false) AS INTEGER) AS "Fault_{n}"' for n in ("900", "925", "950", "975"))},
       CAST({_RULE} AS INTEGER) AS "Fault_Combo2of3_TUNED"
FROM tele, tuned, lad""")
def q_processed_table(spark, sf_dir):
    """Processed layout of lineitem as raw sensor columns, with gaps in speed and vibration."""
    t = tele(spark, sf_dir)
    k = F.split("row_id", "-")[1].cast("bigint")
    li = t.select("row_id", "ts", "speed", "humidity", "vibration", "revolutions", "energy",
                  (F.col("energy") * 100.0).alias("temperature"),
                  F.split("row_id", "-")[3].cast("double").alias("signal_strength"),
                  F.col("asset").cast("double").alias("motor_cycles"))
    li = li.withColumn("speed", F.when(k % 13 != 0, F.col("speed"))) \
           .withColumn("vibration", F.when(k % 11 != 0, F.col("vibration")))
    return finish(processed_table(li, keep=["row_id"]))
