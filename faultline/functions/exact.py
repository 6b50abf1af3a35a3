"""Exact sums of doubles as mergeable integer digits.

A finite double is an integer times a power of two.  Over a column whose
absolute values span a known range of exponents (one small aggregate), every
value is cut into signed digits of ``BITS`` bits at fixed places; sums and
differences of the digits are sums of ``bigint`` columns and therefore exact
in any order, so running sums can be subtracted.  ``BITS`` leaves room for
2^43 rows.  Infinities are counted apart; NaN and NULL count as missing.
"""
from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 20
_KEEP = 5       # leading digits that reach the double: at least 80 bits


@dataclass(frozen=True)
class Digits:
    """Places of a column's digits: the lowest bit and how many digits."""
    low: int
    count: int

    def power(self, j: int) -> float:
        e = self.low + BITS * j
        return math.ldexp(1.0, e) if e < 1024 else math.inf

    def split(self, x: Column) -> list[Column]:
        """Signed digits, lowest first; zeros where x is missing or infinite."""
        x = x.cast("double")
        a = F.abs(x)
        ok = x.isNotNull() & ~F.isnan(x) & (a != F.lit(math.inf))
        sign = F.when(x < 0, -1).otherwise(1)
        # the remainder of doubles and division by a power of two are exact
        return [F.when(ok, F.floor((a % F.lit(self.power(j + 1))) / F.lit(self.power(j))).cast("bigint") * sign)
                .otherwise(F.lit(0).cast("bigint")) for j in range(self.count)]


def tallies(x: Column) -> list[Column]:
    """0/1 columns: has a value, is +infinity, is -infinity."""
    x = x.cast("double")
    one = lambda c: F.coalesce(c, F.lit(False)).cast("bigint")
    return [one(x.isNotNull() & ~F.isnan(x)), one(x == F.lit(math.inf)), one(x == F.lit(-math.inf))]


def digits_of(df: DataFrame, cols) -> dict[str, Digits]:
    """Digit places per column, from one aggregate over all rows."""
    parts = []
    for i, c in enumerate(cols):
        a = F.abs(F.col(c).cast("double"))
        fine = F.when((a > 0) & ~F.isnan(a) & (a != F.lit(math.inf)), a)
        parts += [F.min(fine).alias(f"lo{i}"), F.max(fine).alias(f"hi{i}")]
    r = df.agg(*parts).first()
    out = {}
    for i, c in enumerate(cols):
        lo, hi = r[f"lo{i}"], r[f"hi{i}"]
        if lo is None:
            out[c] = Digits(0, 1)
            continue
        low = max(-1074, math.frexp(lo)[1] - 53)    # the lowest bit that any value may have
        out[c] = Digits(low, -(-(math.frexp(hi)[1] - low) // BITS))
    return out


def mean(places: Digits, sums: list[Column], n: Column, up: Column, down: Column) -> Column:
    """The mean from exact digit sums and tallies: NULL without values, +-infinity or NaN by IEEE rules.

    The leading ``_KEEP`` non-zero digits reach the double and the division
    by ``n`` comes before the scaling, so no total can overflow.  The digits of
    many rows are carried at once, as Arrow columns inside the tasks."""
    powers = [places.power(j) for j in range(places.count + 1)]
    bits, keep = BITS, _KEEP

    def carried(digits):
        """(rest, digits from 0 to 2^bits - 1, lowest first); ``rest`` is the signed share above the highest digit."""
        rest, low = np.zeros(len(digits[0]), np.int64), []
        for d in digits:
            t = rest + d
            low.append(t & ((1 << bits) - 1))
            rest = t >> bits
        return rest, low

    def leading(n: pa.Array, *sums: pa.Array) -> pa.Array:
        missing = np.any([x.is_null().to_numpy(zero_copy_only=False) for x in (n, *sums)], axis=0)
        n, *digits = (x.fill_null(0).to_numpy(zero_copy_only=False) for x in (n, *sums))
        rest, low = carried(digits)
        negative = rest < 0
        if negative.any():
            rest, low = carried([np.where(negative, -d, d) for d in digits])
        v = np.zeros(len(n))
        used, left = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
        for d in (rest, *reversed(low)):
            go = used < keep
            v = np.where(go, v * float(1 << bits) + d, v)
            used = np.where(v != 0, used + 1, 0)
            left = np.where(go, left, left + 1)
        with np.errstate(all="ignore"):         # a window without values is told apart below
            out = v / n * np.array(powers)[left]
        return pa.array(np.where(negative, -out, out), pa.float64(), mask=missing)

    finite = F.arrow_udf(leading, "double")(n, *sums)
    return (F.when(n == 0, F.lit(None).cast("double"))
            .when((up > 0) & (down > 0), F.lit(math.nan))
            .when(up > 0, F.lit(math.inf)).when(down > 0, F.lit(-math.inf)).otherwise(finite))
