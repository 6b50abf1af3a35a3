"""Bounded fit samples: the rows drawn, and the scan that draws them."""
from pyspark.sql import functions as F

from faultline.operators import models as M


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_fit_sample_scans_in_all_tasks(spark):
    df = spark.range(0, 4000, 1, 8).select(F.col("id").alias("row_id"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    s = M.fit_sample(df, "y", 500)
    assert "Coalesce" not in plan(s)        # a coalesced scan is one task over the whole table
    got = [r["row_id"] for r in s.collect()]
    assert s.rdd.getNumPartitions() == 1 and len(got) == 500 and got == sorted(got)
    assert s.where("y = 1").count() == 50
    assert M.fit_sample(df, "y", 20_000).rdd.getNumPartitions() == 2
