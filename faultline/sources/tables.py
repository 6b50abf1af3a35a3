"""Readers for the driver tables and the two telemetry views built on them.

``tele``    (from ``lineitem``): one row per reading, ``asset = l_suppkey``.
``tele_ev`` (from ``events``):   one row per reading, ``asset = user_id``.

Both are plain projections, so Catalyst prunes the Parquet scan to the
columns a query touches and pushes filters into it.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import nan_to_null, to_ntz
from ..session import pin_utc

TELE_FEATURES = ["vibration", "revolutions", "speed", "energy", "humidity"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of a driver table."""
    pin_utc(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _maybe_null(c, row_key, null_every):
    if not null_every:
        return c
    return F.when(row_key % F.lit(null_every) == 0, F.lit(None).cast("double")).otherwise(c)


def tele(spark: SparkSession, sf_dir: str, null_every: int | None = None) -> DataFrame:
    """lineitem as telemetry.  ``row_id`` sorts like (shipdate, orderkey,
    linenumber, partkey) and is unique at every scale."""
    li = read_table(spark, sf_dir, "lineitem")
    row_id = F.concat_ws(
        "-",
        F.date_format("l_shipdate", "yyyyMMdd"),
        F.lpad(F.col("l_orderkey").cast("string"), 12, "0"),
        F.lpad(F.col("l_linenumber").cast("string"), 3, "0"),
        F.lpad(F.col("l_partkey").cast("string"), 12, "0"),
    )
    vib = _maybe_null(nan_to_null("l_quantity"), F.col("l_orderkey"), null_every)
    return li.select(
        row_id.alias("row_id"),
        to_ntz("l_shipdate").alias("ts"),
        F.col("l_suppkey").alias("asset"),
        vib.alias("vibration"),
        nan_to_null("l_extendedprice").alias("revolutions"),
        nan_to_null("l_discount").alias("speed"),
        nan_to_null("l_tax").alias("energy"),
        (nan_to_null("l_quantity") * nan_to_null("l_tax")).alias("humidity"),
    )


def tele_ev(spark: SparkSession, sf_dir: str, null_every: int | None = None) -> DataFrame:
    """events as telemetry: ``vibration = value``, second sensor ``k`` from
    the JSON props, ``is_error``/``score`` for evaluation queries."""
    ev = read_table(spark, sf_dir, "events")
    vib = _maybe_null(nan_to_null("value"), F.col("event_id"), null_every)
    return ev.select(
        F.col("event_id").alias("row_id"),
        to_ntz("ts").alias("ts"),
        F.col("user_id").alias("asset"),
        vib.alias("vibration"),
        F.get_json_object("props", "$.k").cast("double").alias("k"),
        (F.col("event_type") == "error").cast("int").alias("is_error"),
        F.least(F.col("value") / 200.0, F.lit(1.0)).alias("score"),
    )
