"""Connected components by alternating large-star and small-star steps.

Each step is one aggregation (the least neighbour of a node, combined before
the shuffle) and one join back; a node's neighbours are never gathered, so a
hub is only a skewed join key, which adaptive execution splits.  Every step
is written to the shared folder, which cuts the lineage."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _large_star(e: DataFrame) -> DataFrame:
    """(v, m) for neighbours v > u, m the least of u and its neighbours."""
    both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m"))
    return both.where("v > u").join(low, "u") \
        .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """(v, m) for the lesser neighbours v of u and for u itself, m their least."""
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    near = down.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.union(low.select("u", F.col("m").alias("v"))).distinct()


def _state(e: DataFrame):
    r = e.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")).first()
    return r["n"], r["h"]


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): every node of an edge (u, v) with the least node of its component.

    Self loops and repeated edges are allowed, null ends are ignored; no
    edges give no rows."""
    e = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
               .distinct(), "edges")
    state = _state(e)
    while state[0]:
        large = stored(_large_star(e), "large-star", [e])
        e = stored(_small_star(large), "small-star", [large])
        now = _state(e)
        if now == state:
            break
        state = now
    roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
