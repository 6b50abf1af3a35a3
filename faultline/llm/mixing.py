"""Mixing sources to target weights.

Tokens (words) are summed per source, a repetition rate = target / size is
derived per source, and each document is emitted floor(rate) times plus one
hash-seeded Bernoulli copy with probability equal to the fraction.

The draw of a document is a 32-bit uniform number from md5(seed, id), for a
row without an id from its text.  For each source 64 rotations of that number
are rated in the same one-pass aggregate and the one whose total lies closest
to the target is used.  Every rotation by itself is the same Bernoulli draw,
but choosing among them selects: which documents get the extra copy depends a
little on all sizes of the source, so draws within a source are not quite
independent.  In return sources with few documents also come near their
target.

Sources may be very many (hosts): their sizes, targets and rates stay a
table that is joined to the rows; Spark broadcasts it where it is measured to
be small and splits a hot source where it isn't.  Only the water level, one
number, reaches the driver.

Edge cases: a null text has size 0; a null source is a source of its own,
last in order; a source of size 0 has target and rate 0; repeated rows share
their draw; an empty table gives an empty result; columns of the input with
clashing names are kept as they are by ``mix``."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.order import position, running_sums
from .common import n_words, stored

WEIGHT_CYCLE = (3, 1, 2)
SHARE = 1.5
MAX_RATE = 2.0
SEED = "mix-1"
N_ROTATIONS = 64
_GOLDEN = 2654435769  # 2^32 / golden ratio: consecutive rotations spread evenly
_M = 1 << 32


ONE_TASK = 200_000  # so many sources are ordered in one task; more in ranges


def targets(sources: DataFrame, cycle=WEIGHT_CYCLE, share=SHARE, max_rate=MAX_RATE) -> DataFrame:
    """(source, size) with weight and target: ``share`` of all sizes by
    weight, none above ``max_rate`` times its source, the excess reshared
    among the others.

    That is target_i = min(max_rate * size_i, level * weight_i).  In the
    order in which sources reach their limit, the level is what the earlier
    ones leave to a unit of weight, at the first source it does not stop."""
    how = "window" if sources.count() <= ONE_TASK else "ranged"
    s = position(sources.select("source", "size"), [], ["source"], strategy=how, pos="__at", total="__n")
    weight = F.element_at(F.array(*map(F.lit, cycle)), (F.pmod(F.col("__at") - 1, F.lit(len(cycle))) + 1).cast("int"))
    s = s.select("source", "size", weight.cast("bigint").alias("weight"))
    s = s.withColumn("stop", F.lit(max_rate) * F.col("size") / F.col("weight"))
    s = running_sums(s, [], ["stop", "source"], ["size", "weight"], strategy=how)
    left = F.lit(share) * F.col("tot_size") - F.lit(max_rate) * (F.col("cum_size") - F.col("size"))
    level = left / (F.col("tot_weight") - (F.col("cum_weight") - F.col("weight")))
    s = s.select("source", "size", "weight", "stop", level.alias("level"))
    r = s.where("level <= stop").agg(F.min_by("level", F.struct("stop", F.col("source").isNull(), "source"))).first()
    full = F.lit(max_rate) * F.col("size")
    target = full if r[0] is None else F.least(full, F.lit(r[0]) * F.col("weight"))
    return s.select("source", "size", "weight",
                    F.when(F.col("size") == 0, 0.0).otherwise(target).cast("double").alias("target"))


def draw(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """Uniform integer in [0, 2^32) of an id (without one, of the text), the same in every run."""
    own = F.coalesce(doc_id.cast("string"), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), own)), 1, 8), 16, 10).cast("bigint")


def _turned(drawn: Column, turn: Column) -> Column:
    return (drawn + turn) % F.lit(_M)


def plan_mixture(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source",
                 cycle=WEIGHT_CYCLE, share=SHARE, max_rate=MAX_RATE, seed=SEED):
    """(sizes, rates), both stored: ``sizes`` has doc_id, source, size, draw per row, ``rates`` per source its
    size, target, whole copies (``base``), and which draws get one more (turned by ``turn``, below ``cut``)."""
    sizes = stored(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                               n_words(F.col(text_col)).alias("size"),
                               draw(F.col(id_col), F.col(text_col), seed).alias("draw")), "mix-sizes")
    total = stored(sizes.groupBy("source").agg(F.sum("size").alias("size")), "mix-sources")
    t = targets(total, cycle, share, max_rate)
    rate = F.when(F.col("size") == 0, 0.0).otherwise(F.col("target") / F.col("size"))
    t = t.select("source", F.col("size").alias("source_size"), "target", rate.alias("rate"))
    t = stored(t.select("*", F.floor("rate").cast("bigint").alias("base"),
                        F.floor((F.col("rate") - F.floor("rate")) * _M).cast("bigint").alias("cut")), "mix-targets")
    turns = [k * _GOLDEN % _M for k in range(N_ROTATIONS)]
    more = [F.sum(F.when(_turned(F.col("draw"), F.lit(x)) < F.col("cut"), F.col("size")).otherwise(0)).alias(f"k{k}")
            for k, x in enumerate(turns)]
    got = _with_rates(sizes, t.select("source", "cut")).groupBy("source").agg(*more)
    want = F.col("target") - F.col("base") * F.col("source_size")
    best = F.least(*[F.struct(F.abs(F.col(f"k{k}") - want).alias("off"), F.lit(k).alias("k"),
                              F.lit(x).cast("bigint").alias("turn")) for k, x in enumerate(turns)],
                   F.struct(F.lit(float("inf")).alias("off"), F.lit(N_ROTATIONS).alias("k"),
                            F.lit(0).cast("bigint").alias("turn")))
    rates = _with_rates(t, got).select("source", "source_size", "target", "base", "cut", best["turn"].alias("turn"))
    return sizes, stored(rates, "mix-rates")


def _with_rates(rows: DataFrame, rates: DataFrame) -> DataFrame:
    """Rows with their source's columns (null is a source too)."""
    r = rates.withColumnRenamed("source", "__source")
    return rows.join(r, rows["source"].eqNullSafe(r["__source"])).drop("__source")


def _copies(drawn: Column) -> Column:
    return F.col("base") + F.when(_turned(drawn, F.col("turn")) < F.col("cut"), 1).otherwise(0)


def mixture_table(docs: DataFrame, **kw) -> DataFrame:
    """Per document: doc_id, size, source_size, target of its source, copies, taken."""
    sizes, rates = plan_mixture(docs, **kw)
    copies = _copies(F.col("draw"))
    return _with_rates(sizes, rates).select("doc_id", "size", "source_size", "target", copies.alias("copies"),
                                            (F.col("size") * copies).alias("taken"))


def mix(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", seed=SEED, **kw) -> DataFrame:
    """The mixture itself: each input row as often as the plan says, columns unchanged."""
    _, rates = plan_mixture(docs, id_col, text_col, source_col, seed=seed, **kw)
    cols = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("__row"),
                       F.col(source_col).cast("string").alias("source"), draw(F.col(id_col), F.col(text_col), seed).alias("draw"))
    times = F.array_repeat(F.lit(True), _copies(F.col("draw")).cast("int"))
    out = _with_rates(rows, rates).select("__row", F.explode(times).alias("__copy"))
    return out.select(*[F.col("__row").getField(c).alias(c) for c in cols])
