"""Cleaning (B4-B11, B15): coercion, timestamp parsing, ordering, NULL
handling, imputation and profiles.  Profiles are single aggregates."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import nan_to_null, to_ntz
from ..plans.order import fill_forward_backward, position
from ..plans.quantile import quantiles


def coerce_numeric(df: DataFrame, cols) -> DataFrame:
    """Bad values become NULL (``try_cast``); NaN normalised to NULL."""
    return df.withColumns({c: nan_to_null(F.expr(f"try_cast(`{c}` AS DOUBLE)")) for c in cols})


def parse_ts(df: DataFrame, col: str, fmt: str | None = None, drop_null: bool = True) -> DataFrame:
    """Parse to TIMESTAMP_NTZ, unparsable -> NULL; optionally drop them."""
    s = F.col(col).cast("string")
    parsed = F.try_to_timestamp(s, F.lit(fmt)) if fmt else F.try_to_timestamp(s)
    out = df.withColumn(col, to_ntz(parsed))
    return out.dropna(subset=[col]) if drop_null else out


def sort_time(df: DataFrame, ts: str = "ts", row_id: str = "row_id", keys=(), strategy="auto",
              pos: str = "pos") -> DataFrame:
    """Global (or per-key) time order with ties broken by ``row_id``;
    materialised as a 1-based position, computed without a single-task
    window.  To write sorted files use ``write_sorted``."""
    d = position(df, keys, [ts, row_id], strategy=strategy, pos=pos, total="_n")
    return d.drop("_seg", "_rn", "_n")


def write_sorted(df: DataFrame, path: str, ts: str = "ts", row_id: str = "row_id", fmt: str = "parquet"):
    """B7 for files: range-partition on time, sort inside partitions."""
    (df.repartitionByRange(F.col(ts).asc_nulls_last(), F.col(row_id))
       .sortWithinPartitions(F.col(ts).asc_nulls_last(), row_id)
       .write.mode("overwrite").format(fmt).save(path))


def dropna_subset(df: DataFrame, cols) -> DataFrame:
    """B8."""
    return df.dropna(subset=list(cols))


def ffill_bfill(df: DataFrame, cols, ts: str = "ts", row_id: str = "row_id", keys=(),
                strategy="auto") -> DataFrame:
    """Forward then backward fill in time order (per key if given)."""
    return fill_forward_backward(df, keys, [ts, row_id], cols, strategy).drop("_seg", "_rn")


def medians(df: DataFrame, cols) -> dict:
    qv = quantiles(df, cols, [0.5])
    return {c: qv[(c, 0.5)] for c in cols}


def median_impute(df: DataFrame, cols, med: dict | None = None) -> DataFrame:
    """Exact medians (not ``ml.Imputer``, whose median is approximate)."""
    med = med or medians(df, cols)
    return df.na.fill({c: v for c, v in med.items() if v is not None})


def null_profile(before: DataFrame, after: DataFrame, cols) -> DataFrame:
    """NULL count per column before and after cleaning (one aggregate
    per frame, unpivoted)."""
    b = before.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    a = after.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    bl = b.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("long").alias("nulls_before"))
                                     for c in cols])))
    al = a.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("long").alias("nulls_after"))
                                     for c in cols])))
    return bl.join(al, "column")


def shape_profile(df: DataFrame, label: str | None = None) -> DataFrame:
    """Rows, columns and (optionally) positives of a label."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    if label:
        aggs.append(F.coalesce(F.sum(F.col(label).cast("long")), F.lit(0)).cast("long").alias("n_positive"))
    return df.agg(*aggs).withColumn("n_cols", F.lit(len(df.columns)).cast("long"))
