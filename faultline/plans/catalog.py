"""

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs the operator over the
whole driver tables (through the ``tele`` / ``tele_ev`` views);
``ORACLE[name]`` is the same computation as DuckDB SQL over the raw
tables.  Doubles are rounded to 6 places on both sides; counts are bigint.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..sources import tele, tele_ev

QUERIES: dict = {}
ORACLE: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = same_rounding(sql.strip())
        return fn
    return deco


def r6(c):
    """Round half up to 6 decimals with plain double arithmetic.  Spark's
    ``round`` goes through the decimal string of a double and DuckDB's
    through binary scaling, so the two disagree on values whose shortest
    decimal ends in 5 at the 7th place; the explicit formula is the same
    IEEE computation in both engines."""
    return F.floor(c * F.lit(1000000.0) + F.lit(0.5)) / F.lit(1000000.0)


def finish(df: DataFrame) -> DataFrame:
    """Round every double column to 6 places (the oracle does the same)."""
    return df.select(*[r6(F.col(f.name)).alias(f.name)
                       if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


def same_rounding(sql: str) -> str:
    """Rewrite every ``round(expr, 6)`` of an oracle query into the formula
    used by :func:`r6`."""
    out, i = [], 0
    low = sql.lower()
    while True:
        j = low.find("round(", i)
        if j < 0 or (j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k, last_comma = 0, j + 6, None
        while True:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                if depth == 0:
                    break
                depth -= 1
            elif ch == "," and depth == 0:
                last_comma = k
            k += 1
        inner = sql[j + 6:k]
        if last_comma is not None and sql[last_comma + 1:k].strip() == "6":
            expr = same_rounding(sql[j + 6:last_comma])
            out.append(sql[i:j] + f"(floor(({expr}) * 1000000.0 + 0.5) / 1000000.0)")
        else:
            out.append(sql[i:j] + "round(" + same_rounding(inner) + ")")
        i = k + 1


# ---------------------------------------------------------------- SQL views
TELE_SQL = """tele AS (
  SELECT strftime(l_shipdate, '%Y%m%d') || '-' || lpad(CAST(l_orderkey AS VARCHAR), 12, '0') || '-'
         || lpad(CAST(l_linenumber AS VARCHAR), 3, '0') || '-' || lpad(CAST(l_partkey AS VARCHAR), 12, '0') AS row_id,
         CAST(l_shipdate AS TIMESTAMP) AS ts, l_suppkey AS asset,
         CAST(l_quantity AS DOUBLE) AS vibration, CAST(l_extendedprice AS DOUBLE) AS revolutions,
         CAST(l_discount AS DOUBLE) AS speed, CAST(l_tax AS DOUBLE) AS energy,
         CAST(l_quantity AS DOUBLE) * CAST(l_tax AS DOUBLE) AS humidity
  FROM lineitem)"""

def tele_ev_sql(null_every: int | None = None, name: str = "tele_ev") -> str:
    vib = "CAST(value AS DOUBLE)"
    if null_every:
        vib = f"CASE WHEN event_id % {null_every} = 0 THEN NULL ELSE {vib} END"
    return f"""{name} AS (
  SELECT event_id AS row_id, CAST(ts AS TIMESTAMP) AS ts, user_id AS asset, {vib} AS vibration,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
         CAST(event_type = 'error' AS INTEGER) AS is_error,
         least(CAST(value AS DOUBLE) / 200.0, 1.0) AS score
  FROM events)"""


TELE_EV_SQL = """tele_ev AS (
  SELECT event_id AS row_id, CAST(ts AS TIMESTAMP) AS ts, user_id AS asset, CAST(value AS DOUBLE) AS vibration,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
         CAST(event_type = 'error' AS INTEGER) AS is_error,
         least(CAST(value AS DOUBLE) / 200.0, 1.0) AS score
  FROM events)"""

# tele_ev with fault = vibration > P95 (the event fixtures)
EV_LAB_SQL = TELE_EV_SQL + """,
ev_thr AS (SELECT quantile_cont(vibration, 0.95) AS p FROM tele_ev),
ev_lab AS (SELECT e.*, CASE WHEN e.vibration > t.p THEN 1 ELSE 0 END AS label_fault
           FROM tele_ev e CROSS JOIN ev_thr t)"""


def islands_sql(src: str, gap_us: str, partition: str = "", null_splits: bool = True,
                name: str = "isl") -> str:
    """Gaps-and-islands over ``src`` (row_id, ts, label_fault) as DuckDB SQL."""
    part = f"PARTITION BY {partition} " if partition else ""
    w = f"({part}ORDER BY ts ASC NULLS LAST, row_id)"
    split = (f"NOT coalesce(us - pus <= {gap_us}, false)" if null_splits
             else f"coalesce(us - pus > {gap_us}, false)")
    return f"""{name}_a AS (
  SELECT *, epoch_us(ts) AS us, lag(label_fault) OVER {w} AS py, lag(epoch_us(ts)) OVER {w} AS pus FROM {src}),
{name}_b AS (
  SELECT *, CASE WHEN label_fault = 1 AND (py IS NULL OR py <> 1 OR {split}) THEN 1 ELSE 0 END AS is_start
  FROM {name}_a),
{name} AS (
  SELECT *, CAST(sum(is_start) OVER ({part}ORDER BY ts ASC NULLS LAST, row_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS event_no
  FROM {name}_b)"""


def events_agg_sql(src: str, keys: str = "") -> str:
    k = f"{keys}, " if keys else ""
    return f"""SELECT {k}event_no AS event_id, min(ts) AS start, max(ts) AS "end",
       round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0, 6) AS duration_s,
       count(*) AS n_rows,
       round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0 / 60.0, 6) AS duration_min,
       CAST(hour(min(ts)) AS INTEGER) AS hour, date_trunc('day', min(ts)) AS day,
       date_trunc('week', min(ts)) AS week, date_trunc('month', min(ts)) AS month
FROM {src} WHERE label_fault = 1 GROUP BY {k}event_no"""


def load_all() -> None:
    """Import every query module (each registers its queries)."""
    from . import q_core, q_clean, q_labels, q_series, q_events, q_splits, q_eval, q_linalg, q_models, q_checks, q_processed, q_planted, q_stream  # noqa: F401
