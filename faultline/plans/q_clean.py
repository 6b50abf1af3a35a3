"""Sources, sinks, schema and cleaning queries."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import clean as C
from ..operators import labels as L
from ..operators import schema as S
from ..session import scratch_path
from ..sources import io as IO
from ..sources import read_table, tele, tele_ev
from .catalog import TELE_EV_SQL, TELE_SQL, finish, register, tele_ev_sql

RULE4 = ["vibration", "speed", "energy", "revolutions"]
TELE_COLS = ["row_id", "ts", "asset", "vibration", "revolutions", "speed", "energy", "humidity"]


def _scratch(spark, name):
    """A path of this run alone: the returned frame reads it lazily."""
    return scratch_path(spark, f"faultline-{name}-{uuid.uuid4().hex[:12]}")


@register("scan_telemetry", f"WITH {TELE_SQL} SELECT * FROM tele")
def q_scan_telemetry(spark, sf_dir):
    """A1: header CSV with an explicit schema (written from tele, read back)."""
    t = tele(spark, sf_dir)
    path = _scratch(spark, "scan_csv")
    IO.write_table(t, path, fmt="csv")
    back = IO.read_telemetry(spark, path, schema=t.schema, fmt="csv")
    return finish(back)


@register("scan_positional", """
SELECT l_orderkey AS "ID", CAST(l_extendedprice AS DOUBLE) AS revolutions,
       round(CAST(l_quantity AS DOUBLE) * CAST(l_tax AS DOUBLE), 6) AS humidity,
       CAST(l_quantity AS DOUBLE) AS vibration, round(CAST(l_tax AS DOUBLE) * 100.0, 6) AS temperature,
       CAST(l_discount AS DOUBLE) AS speed, CAST(l_partkey AS DOUBLE) AS signal_strength,
       CAST(l_tax AS DOUBLE) AS energy, CAST(l_suppkey AS DOUBLE) AS motor_cycles
FROM lineitem""")
def q_scan_positional(spark, sf_dir):
    """A2 + B3: nine unnamed columns -> positional names -> semantic names."""
    li = read_table(spark, sf_dir, "lineitem")
    raw = li.select(F.col("l_orderkey").alias("c0"), F.col("l_extendedprice").alias("c1"),
                    (F.col("l_quantity") * F.col("l_tax")).alias("c2"), F.col("l_quantity").alias("c3"),
                    (F.col("l_tax") * 100.0).alias("c4"), F.col("l_discount").alias("c5"),
                    F.col("l_partkey").alias("c6"), F.col("l_tax").alias("c7"), F.col("l_suppkey").alias("c8"))
    path = _scratch(spark, "raw9")
    IO.write_table(raw, path, fmt="csv")
    df = S.semantic_rename(IO.read_raw_positional(spark, path))
    return finish(df)


@register("roundtrip_write", f"WITH {TELE_SQL} SELECT ts, asset, speed, humidity, vibration, revolutions, energy, row_id FROM tele")
def q_roundtrip_write(spark, sf_dir):
    """A3: write in a fixed column order, read back."""
    order = ["ts", "asset", "speed", "humidity", "vibration", "revolutions", "energy", "row_id"]
    path = _scratch(spark, "roundtrip")
    IO.write_table(tele(spark, sf_dir), path, cols=order)
    back = spark.read.parquet(path)
    assert back.columns == order
    return finish(back)


@register("shuffle_rows", f"WITH {TELE_EV_SQL} SELECT * FROM tele_ev")
def q_shuffle_rows(spark, sf_dir):
    """A4: seeded permutation written and read back (same multiset)."""
    path = _scratch(spark, "shuffled")
    IO.write_shuffled(tele_ev(spark, sf_dir), path, seed=42)
    return finish(spark.read.parquet(path))


@register("run_metadata", f"""
WITH {TELE_SQL}
SELECT f.feature, round(f.threshold, 6) AS threshold, 'random' AS split, 'ts' AS time_col,
       CAST(NULL AS DOUBLE) AS event_gap_minutes, false AS leakage_guard, CAST(2 AS BIGINT) AS n_features
FROM (SELECT 'vibration' AS feature, quantile_cont(vibration, 0.95) AS threshold FROM tele
      UNION ALL SELECT 'speed', quantile_cont(speed, 0.95) FROM tele
      UNION ALL SELECT 'energy', quantile_cont(energy, 0.95) FROM tele
      UNION ALL SELECT 'revolutions', quantile_cont(revolutions, 0.95) FROM tele) f
""")
def q_run_metadata(spark, sf_dir):
    """A5: run metadata written as JSON and read back, one row per threshold."""
    t = tele(spark, sf_dir)
    thr = L.quantile_thresholds(t, RULE4, 0.95)
    feats = S.leakage_guard(S.numeric_features(t), RULE4)
    meta = IO.metadata_frame(spark, thr, feats, "random", "ts", None, False)
    path = _scratch(spark, "meta")
    IO.write_metadata(meta, path)
    back = spark.read.schema(meta.schema).json(path)
    out = back.select(F.explode("thresholds").alias("feature", "threshold"), "split", "time_col",
                      "event_gap_minutes", "leakage_guard", F.size("features_used").cast("long").alias("n_features"))
    return finish(out)


@register("resolve_alias", """
SELECT CAST(l_discount AS DOUBLE) AS speed, CAST(l_quantity AS DOUBLE) AS vibration, CAST(l_tax AS DOUBLE) AS energy
FROM lineitem""")
def q_resolve_alias(spark, sf_dir):
    """B1/B2: exact (Speed), substring (VIBRATION_raw), exact (x5) and
    unresolved (revolutions) roles."""
    li = read_table(spark, sf_dir, "lineitem").select(
        F.col("l_discount").alias("Speed"), F.col("l_quantity").alias("VIBRATION_raw"),
        F.col("l_tax").alias("x5"))
    roles = {r: S.ROLE_ALIASES[r] for r in ["speed", "vibration", "energy", "revolutions"]}
    res = S.resolve_roles(li, roles)
    assert res["revolutions"] is None
    return finish(S.project_roles(li, {k: v for k, v in res.items() if v is not None}))


@register("coerce_numeric", """
SELECT event_id AS row_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
       TRY_CAST(event_type AS DOUBLE) AS event_type
FROM events""")
def q_coerce_numeric(spark, sf_dir):
    """Strings to double, bad values to NULL."""
    ev = read_table(spark, sf_dir, "events").select(
        F.col("event_id").alias("row_id"), F.get_json_object("props", "$.k").alias("k"), "event_type")
    return finish(C.coerce_numeric(ev, ["k", "event_type"]))


@register("parse_ts", """
SELECT row_id, ts FROM (
  SELECT event_id AS row_id,
         TRY_CAST(CASE WHEN event_id % 13 = 0 THEN 'not a time' ELSE CAST(ts AS VARCHAR) END AS TIMESTAMP) AS ts
  FROM events) WHERE ts IS NOT NULL""")
def q_parse_ts(spark, sf_dir):
    """Parse text timestamps, unparsable -> NULL -> dropped."""
    ev = read_table(spark, sf_dir, "events").select(
        F.col("event_id").alias("row_id"),
        F.when(F.col("event_id") % 13 == 0, F.lit("not a time")).otherwise(F.col("ts").cast("string")).alias("ts"))
    return C.parse_ts(ev, "ts")


@register("sort_time", f"""
WITH {TELE_EV_SQL}
SELECT row_id, ts, CAST(row_number() OVER (ORDER BY ts ASC NULLS LAST, row_id) AS BIGINT) AS pos FROM tele_ev""")
def q_sort_time(spark, sf_dir):
    """Global time order as a position (segmented scan, no single task)."""
    t = tele_ev(spark, sf_dir).select("row_id", "ts")
    return C.sort_time(t)


@register("dropna_subset", f"""
WITH {tele_ev_sql(7)}
SELECT row_id, vibration, k FROM tele_ev WHERE vibration IS NOT NULL AND k IS NOT NULL""")
def q_dropna_subset(spark, sf_dir):
    """B8."""
    t = tele_ev(spark, sf_dir, null_every=7).select("row_id", "vibration", "k")
    return finish(C.dropna_subset(t, ["vibration", "k"]))


@register("ffill_bfill", f"""
WITH {tele_ev_sql(7)}
SELECT row_id, round(coalesce(
   last_value(vibration IGNORE NULLS) OVER (ORDER BY ts ASC NULLS LAST, row_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
   first_value(vibration IGNORE NULLS) OVER (ORDER BY ts ASC NULLS LAST, row_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 6) AS vibration
FROM tele_ev""")
def q_ffill_bfill(spark, sf_dir):
    """Forward then backward fill in global time order."""
    t = tele_ev(spark, sf_dir, null_every=7).select("row_id", "ts", "vibration")
    return finish(C.ffill_bfill(t, ["vibration"]).select("row_id", "vibration"))


@register("ffill_bfill_by_asset", f"""
WITH {tele_ev_sql(7)}
SELECT row_id, asset, round(coalesce(
   last_value(vibration IGNORE NULLS) OVER (PARTITION BY asset ORDER BY ts ASC NULLS LAST, row_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
   first_value(vibration IGNORE NULLS) OVER (PARTITION BY asset ORDER BY ts ASC NULLS LAST, row_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 6) AS vibration
FROM tele_ev""")
def q_ffill_bfill_by_asset(spark, sf_dir):
    """B9 per asset (segmented scan keyed by asset)."""
    t = tele_ev(spark, sf_dir, null_every=7).select("row_id", "asset", "ts", "vibration")
    return finish(C.ffill_bfill(t, ["vibration"], keys=["asset"]).select("row_id", "asset", "vibration"))


@register("median_impute", f"""
WITH {tele_ev_sql(7)}
SELECT row_id, round(coalesce(vibration, (SELECT quantile_cont(vibration, 0.5) FROM tele_ev)), 6) AS vibration FROM tele_ev""")
def q_median_impute(spark, sf_dir):
    """Exact median imputation."""
    t = tele_ev(spark, sf_dir, null_every=7).select("row_id", "vibration")
    return finish(C.median_impute(t, ["vibration"]))


@register("null_profile", f"""
WITH {tele_ev_sql(7)},
filled AS (SELECT coalesce(
   last_value(vibration IGNORE NULLS) OVER (ORDER BY ts ASC NULLS LAST, row_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
   first_value(vibration IGNORE NULLS) OVER (ORDER BY ts ASC NULLS LAST, row_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS vibration,
   k FROM tele_ev)
SELECT 'vibration' AS "column", (SELECT count(*) FROM tele_ev WHERE vibration IS NULL) AS nulls_before,
       (SELECT count(*) FROM filled WHERE vibration IS NULL) AS nulls_after
UNION ALL
SELECT 'k', (SELECT count(*) FROM tele_ev WHERE k IS NULL), (SELECT count(*) FROM filled WHERE k IS NULL)""")
def q_null_profile(spark, sf_dir):
    """NULL counts before and after the fill."""
    t = tele_ev(spark, sf_dir, null_every=7).select("row_id", "ts", "vibration", "k")
    after = C.ffill_bfill(t, ["vibration"])
    return C.null_profile(t, after, ["vibration", "k"])


@register("feature_select", f"WITH {TELE_SQL} SELECT asset, vibration, revolutions, speed, energy, humidity FROM tele")
def q_feature_select(spark, sf_dir):
    """Numeric columns minus labels and fault_* flags."""
    t = L.threshold_ladder(L.k_of_n(tele(spark, sf_dir), RULE4), "vibration")
    return finish(t.select(*S.numeric_features(t)))


@register("leakage_guard", f"WITH {TELE_SQL} SELECT asset, humidity FROM tele")
def q_leakage_guard(spark, sf_dir):
    """Drop exactly the rule's own columns."""
    t = L.k_of_n(tele(spark, sf_dir), RULE4)
    return finish(t.select(*S.leakage_guard(S.numeric_features(t), RULE4)))


@register("pick_label", f"""
WITH {TELE_SQL}
SELECT row_id, CAST(coalesce(vibration >= (SELECT quantile_cont(vibration, 0.9) FROM tele), false) AS INTEGER) AS label
FROM tele""")
def q_pick_label(spark, sf_dir):
    """First available label of the preference list (here Fault_900)."""
    t = L.threshold_ladder(tele(spark, sf_dir), "vibration")
    lab = S.pick_label(t)
    return t.select("row_id", F.col(lab).alias("label"))


@register("shape_profile", f"""
WITH {TELE_SQL},
thr AS (SELECT quantile_cont(vibration, 0.95) AS v, quantile_cont(speed, 0.95) AS s,
               quantile_cont(energy, 0.95) AS e, quantile_cont(revolutions, 0.95) AS r FROM tele)
SELECT count(*) AS n_rows,
       CAST(sum(CAST((CAST(coalesce(vibration > v, false) AS INTEGER) + CAST(coalesce(speed > s, false) AS INTEGER)
           + CAST(coalesce(energy > e, false) AS INTEGER) + CAST(coalesce(revolutions > r, false) AS INTEGER)) >= 2
            AS INTEGER)) AS BIGINT) AS n_positive,
       CAST(9 AS BIGINT) AS n_cols
FROM tele CROSS JOIN thr""")
def q_shape_profile(spark, sf_dir):
    """Rows, columns and positives of the labelled table."""
    t = L.k_of_n(tele(spark, sf_dir), RULE4)
    return C.shape_profile(t, "label_fault")
