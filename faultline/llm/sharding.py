"""Sharding by Hilbert-curve order.

Several metadata dimensions are quantised to equi-depth cells (numbers at
approximate quantiles, strings at whole values by their counts), rows are
sorted by their cell's index on the Hilbert curve through that grid, and the
order is cut into runs of equal row counts.  Neighbouring cells on the curve
are neighbours in every dimension, so each shard spans a narrow range of
each of them and file statistics prune on any.

The global position of a row comes from one range exchange on (curve index,
id, ...): the sampled bounds split a hot cell too, because the id is part of
the key.  The sorted partitions are pinned with ``checkpoint()``, counted,
and each row's rank is its place in its partition plus the rows before.

Law ``rows``: shard sizes differ by at most one row.  Equal texts with equal
metadata are neighbours in the order.

Edge cases: nulls of a dimension are in its lowest cell; a dimension that the
table does not have is left out (without any the order is that of texts); a
null text counts as empty; ids may repeat or be null (rows equal in every sort key are
interchangeable); an empty table gives an empty result."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir, shuffle_partitions
from ..plans.order import running_sums
from .common import n_bytes, stored

N_SHARDS = 24
BITS = 5
DIMS = ("source", "lang", "n_chars")
ONE_TASK = 200_000  # so many distinct values of a string are ordered in one task; more in ranges


def curve_tables(n: int) -> tuple[list[int], list[int]]:
    """(digit, next state) of the n-dimensional Hilbert curve, indexed by
    state * 2^n + bits.  A state is (entry corner, direction)."""
    full = (1 << n) - 1
    rot_l = lambda x, k: ((x << k % n) | (x >> (n - k % n))) & full if k % n else x
    rot_r = lambda x, k: rot_l(x, n - k % n)

    def ungray(g):
        out = 0
        while g:
            out ^= g
            g >>= 1
        return out

    gray = lambda i: i ^ (i >> 1)
    entry = lambda w: 0 if w == 0 else gray(2 * ((w - 1) // 2))
    ones = lambda i: (~i & (i + 1)).bit_length() - 1  # noqa: E731  trailing set bits
    turn = lambda w: 0 if w == 0 else (ones(w - 1) if w % 2 == 0 else ones(w)) % n
    digit, nxt = [], []
    for e in range(1 << n):
        for d in range(n):
            for bits in range(1 << n):
                w = ungray(rot_r(bits ^ e, d + 1))
                digit.append(w)
                nxt.append((e ^ rot_l(entry(w), d + 1)) * n + (d + turn(w) + 1) % n)
    return digit, nxt


def hilbert_index(cells: list[Column], bits: int) -> Column:
    """Curve index of a grid cell: one table look-up per bit level."""
    n = len(cells)
    digit, nxt = curve_tables(n)
    digits, states = F.array(*map(F.lit, digit)), F.array(*map(F.lit, nxt))
    state, index = F.lit(0), F.lit(0).cast("bigint")
    for b in range(bits - 1, -1, -1):
        key = state * F.lit(1 << n)
        for i, c in enumerate(cells):
            key = key + F.shiftleft(F.shiftright(c, b).bitwiseAND(F.lit(1)), i)
        key = key.cast("int")
        index = index * F.lit(1 << n) + F.get(digits, key)
        state = F.get(states, key)
    return index


def _ordinal(docs: DataFrame, name: str) -> Column:
    """Order-preserving number of a dimension that is no string; null below all."""
    kind = dict(docs.dtypes)[name]
    c = F.col(f"`{name}`")
    if kind in ("date", "timestamp"):
        c = F.unix_micros(c.cast("timestamp"))
    elif kind == "timestamp_ntz":
        c = F.unix_micros(F.to_utc_timestamp(c, "UTC"))
    return F.coalesce(c.cast("double"), F.lit(float("-inf")))


def _number_edges(docs: DataFrame, names, cells: int) -> dict:
    """Approximate quantiles of the numeric dimensions, from one aggregate."""
    if not names:
        return {}
    share = [k / cells for k in range(1, cells)]
    r = docs.select(*[_ordinal(docs, d).alias(f"o{i}") for i, d in enumerate(names)]).agg(
        *[F.percentile_approx(f"o{i}", share, 10_000).alias(f"e{i}") for i in range(len(names))]).first()
    return {d: sorted(set(r[f"e{i}"] or [])) for i, d in enumerate(names)}


def _string_edges(docs: DataFrame, name: str, cells: int) -> list[str]:
    """Exact equi-depth edges of a string dimension: whole values, by the running count of the distinct ones."""
    values = stored(docs.select(F.col(f"`{name}`").alias("v")).groupBy("v").agg(F.count("*").alias("n")), "shard-values")
    how = "window" if values.count() <= ONE_TASK else "ranged"
    run = running_sums(values.withColumn("some", F.col("v").isNotNull()), [], ["some", "v"], ["n"], strategy=how)
    last = F.floor(F.col("cum_n") * cells / F.col("tot_n"))  # a value ends the cells that its last row ends
    first = F.floor((F.col("cum_n") - F.col("n")) * cells / F.col("tot_n"))
    got = run.where((last > first) & (last <= cells) & F.col("v").isNotNull()).select("v").collect()  # at most `cells`
    return sorted({r["v"] for r in got}, key=lambda v: v.encode("utf-8", "surrogatepass"))


def with_curve_index(docs: DataFrame, dims=DIMS, bits: int = BITS, out: str = "__curve") -> DataFrame:
    """Add the Hilbert index; a cell is the number of edges (at most 2^bits a dimension) below the value."""
    kinds, n = dict(docs.dtypes), 1 << bits
    dims = [d for d in dims if d in kinds]
    if not dims:
        return docs.withColumn(out, F.lit(0).cast("bigint"))
    edges = _number_edges(docs, [d for d in dims if kinds[d] != "string"], n)
    cells = []
    for d in dims:
        text = kinds[d] == "string"
        value = F.col(f"`{d}`") if text else _ordinal(docs, d)
        cell = F.lit(0)
        for e in (_string_edges(docs, d, n) if text else edges[d])[:n - 1]:
            cell = cell + F.when(value > F.lit(e), F.lit(1)).otherwise(F.lit(0))  # a null string is above nothing
        cells.append(cell)
    tmp = docs.select("*", *[c.alias(f"__cell{i}") for i, c in enumerate(cells)])
    return tmp.withColumn(out, hilbert_index([F.col(f"__cell{i}") for i in range(len(dims))], bits)) \
        .drop(*[f"__cell{i}" for i in range(len(dims))])


def shard(docs: DataFrame, n_shards: int = N_SHARDS, dims=DIMS, bits: int = BITS,
          id_col: str = "doc_id", text_col: str = "text", carry: bool = True) -> DataFrame:
    """Columns of ``docs`` (``carry=False``: the id only) plus size,
    text_crc32, law, shard, slot, grown_shard."""
    spark = docs.sparkSession
    cols = docs.columns if carry else [id_col]
    t = with_curve_index(docs, dims, bits)
    text = F.coalesce(F.col(text_col), F.lit(""))
    t = t.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("__row"), F.col(id_col).alias("__id"),
                 (n_bytes(F.col(text_col)) + 8).alias("__size"),
                 F.crc32(text.cast("binary")).alias("__crc"), "__curve")
    checkpoint_dir(spark)
    keys = ["__curve", "__crc", "__size", "__id"]
    t = t.repartitionByRange(shuffle_partitions(spark), *keys).sortWithinPartitions(*keys)
    t = t.withColumn("__pid", F.spark_partition_id()) \
        .withColumn("__pos", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))) \
        .checkpoint()
    counts = {r["__pid"]: r["n"] for r in t.groupBy("__pid").agg(F.count("*").alias("n")).collect()}
    total, before, run = sum(counts.values()), {}, 0
    for p in sorted(counts):
        before[p], run = run, run + counts[p]
    offsets = F.array(*[F.lit(before.get(p, 0)).cast("bigint") for p in range(max(before, default=-1) + 1)] or
                      [F.lit(0).cast("bigint")])
    rank = F.get(offsets, F.col("__pid")) + F.col("__pos")
    # the first total % n shards hold one row more
    small, larger = divmod(total, n_shards)
    head = larger * (small + 1)
    shard_no = F.when(F.col("__rank") < head, F.floor(F.col("__rank") / F.lit(small + 1))) \
        .otherwise(F.lit(larger) + F.floor((F.col("__rank") - head) / F.lit(max(small, 1))))
    slot = F.when(F.col("__rank") < head, F.col("__rank") % F.lit(small + 1)) \
        .otherwise((F.col("__rank") - head) % F.lit(max(small, 1)))
    t = t.withColumn("__rank", rank)
    added = {"size": F.col("__size"), "text_crc32": F.col("__crc"), "law": F.lit("rows"),
             "shard": shard_no.cast("int"), "slot": slot.cast("bigint"), "grown_shard": F.lit(None).cast("int")}
    return t.select(*[F.col("__row").getField(c).alias(c) for c in cols if c not in added],
                    *[c.alias(k) for k, c in added.items()])


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows in curve order; a large shard is several files."""
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot") \
        .write.partitionBy("shard").parquet(path)
