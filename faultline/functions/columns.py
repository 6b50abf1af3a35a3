"""Column expressions shared by the operators (all JVM-side, codegen-able)."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "col", "EPOCH", "to_ntz", "epoch_us", "us_to_ts", "nan_to_null", "flag", "cmp",
    "day_key", "week_key", "month_key", "safe_div", "US_PER_S",
]

US_PER_S = 1_000_000


def EPOCH() -> Column:
    """The epoch as a TIMESTAMP_NTZ literal (built lazily: needs a session)."""
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_ntz(c) -> Column:
    """Timestamps are handled as TIMESTAMP_NTZ (wall clock, UTC)."""
    return col(c).cast("timestamp_ntz")


def epoch_us(c) -> Column:
    """Microseconds since the epoch as bigint; integer arithmetic keeps
    gaps exact (float epochs drift in the 7th decimal)."""
    return F.timestamp_diff("MICROSECOND", EPOCH(), to_ntz(c))


def us_to_ts(c) -> Column:
    return F.timestamp_add("MICROSECOND", col(c), EPOCH())


def nan_to_null(c) -> Column:
    """pandas skips NaN; Spark orders NaN above every number.  Normalise."""
    return F.nanvl(col(c).cast("double"), F.lit(None).cast("double"))


def flag(cond: Column) -> Column:
    """0/1 int of a predicate; NULL compares as false (pandas semantics)."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def cmp(c, op: str, thr) -> Column:
    c = col(c)
    thr = thr if isinstance(thr, Column) else F.lit(thr)
    return {">": c > thr, ">=": c >= thr, "<": c < thr, "<=": c <= thr}[op]


def day_key(c) -> Column:
    return F.date_trunc("day", to_ntz(c)).cast("timestamp_ntz")


def week_key(c) -> Column:
    """Monday-start week, as pandas ``to_period('W').start_time``."""
    return F.date_trunc("week", to_ntz(c)).cast("timestamp_ntz")


def month_key(c) -> Column:
    return F.date_trunc("month", to_ntz(c)).cast("timestamp_ntz")


def safe_div(a, b) -> Column:
    """a / b, 0 on zero division (sklearn ``zero_division=0``)."""
    return F.coalesce(F.try_divide(col(a).cast("double"), col(b).cast("double")), F.lit(0.0))
