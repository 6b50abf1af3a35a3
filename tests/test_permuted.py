"""Permuted copies (I9) against a plain sort, and without stored copies."""
import pytest
from pyspark.sql import functions as F

from faultline.operators import models as M


@pytest.fixture(scope="module")
def rows(spark):
    data = [(f"r{i}", None if i % 50 == 3 else float(i), float(i % 7), int(i % 3 == 0)) for i in range(400)]
    return spark.createDataFrame(data, "row_id string, a double, b double, y int").repartition(5)


def test_copies_follow_the_hash_order(rows):
    c = M._permuted_copies(rows, ["a", "b"], 2, 42, "row_id", "y")
    got = {(r["copy"], r["row_id"]): r for r in c.collect()}
    for copy in range(4):
        name = "a" if copy < 2 else "b"
        line = rows.select("row_id", name, F.xxhash64("row_id", F.lit(copy), F.lit(42)).alias("h")).orderBy("h", "row_id").collect()
        for prev, r in zip(line[-1:] + line[:-1], line, strict=True):
            assert got[copy, r["row_id"]][name] == prev[name]


def test_importance_stores_no_copies(spark, rows, monkeypatch):
    monkeypatch.setattr("pyspark.sql.DataFrame.checkpoint", lambda *a, **k: pytest.fail("a copy of all rows was stored"))
    monkeypatch.setattr("pyspark.sql.classic.dataframe.DataFrame.checkpoint", lambda *a, **k: pytest.fail("a copy of all rows was stored"))
    d = rows.fillna(0.0)
    m = M.fit(d, ["a", "b"], "y", "tree", {"maxDepth": 4}, weighted=False)
    got = {r["feature"]: r["importance_mean"] for r in M.permutation_importance(m, d, ["a", "b"], "y", repeats=2).collect()}
    assert set(got) == {"a", "b"} and all(-1 <= v <= 1 for v in got.values())
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
