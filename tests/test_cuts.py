"""Cuts by rank: the one-scan interval and the histogram rounds give the same rows."""
import hashlib

import pytest
from pyspark.sql import functions as F

from faultline.operators import splits as G


def _ranked(n, s=None):
    ids = [i for i in range(n) if s is None or i % 3 == s]
    return sorted(ids, key=lambda i: (hashlib.md5(f"{i}-42".encode()).hexdigest(), i))


@pytest.mark.parametrize("small", [100_000, 300, 20])
def test_cuts_of_strata(spark, small):
    n = 3000
    d = G.with_hash(spark.range(n).withColumnRenamed("id", "row_id").withColumn("s", F.col("row_id") % 3))
    wanted = {0: [1, 500, 999], 1: [10], 2: [0, 1000, 5000]}
    cuts = G.rank_cuts(d, "s", None, wanted, small=small)
    for s, ks in wanted.items():
        for k in ks:
            got = {r[0] for r in d.where((F.col("s") == s) & cuts[(s, k)]).select("row_id").collect()}
            assert got == set(_ranked(n, s)[:k]), (s, k)


def test_a_missed_interval_falls_back(spark, monkeypatch):
    monkeypatch.setattr(G, "SIGMAS", -1000)
    d = spark.range(2000).withColumnRenamed("id", "row_id")
    got = {r[0] for r in G.sample_n(d, 700).select("row_id").collect()}
    assert got == set(_ranked(2000)[:700])


def test_equal_keys_at_a_cut_are_refused(spark):
    d = spark.range(100).select(F.lit(7).alias("row_id"), F.col("id"))
    with pytest.raises(ValueError, match="equal 'row_id'"):
        G.sample_n(d, 30)
