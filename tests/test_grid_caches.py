"""A grid search (I7) keeps its caller's cached rows and scores the validation rows once."""
from pyspark.sql import functions as F

from faultline.operators import models as M


def test_search_keeps_the_callers_cache(spark):
    rows = spark.range(400).select(F.concat(F.lit("r"), "id").alias("row_id"), (F.col("id") % 10).cast("double").alias("x"),
                                   (F.col("id") % 10 > 6).cast("int").alias("y"), (F.col("id") % 4 == 0).alias("held"))
    train, val = rows.where("not held").cache(), rows.where("held")
    train.count()
    _, setting, score = M.grid_search(train, val, ["x"], "tree", grid=[{"maxDepth": 1}, {"maxDepth": 2}], label="y",
                                      scorer="avg_precision", weighted=False)
    assert setting == {"maxDepth": 1} and score == 1.0
    assert train.storageLevel.useMemory         # the search used to drop what its caller had cached
    train.unpersist()


def test_ratings_score_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)
    rows = spark.range(300).select((F.col("id") % 10).cast("double").alias("x"), (F.col("id") % 10 > 6).cast("int").alias("y"))
    model = M.fit(rows, ["x"], "y", "tree", {"maxDepth": 1}, weighted=False)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    counted = rows.mapInArrow(count, rows.schema)
    assert M.rate_settings([model, model], counted, "y", "avg_precision") == [1.0, 1.0]
    assert seen.value == 600                    # once per setting; measuring them for hot keys read them again


def test_forests_are_searched_side_by_side(spark):
    rows = spark.range(400).select((F.col("id") % 10).cast("double").alias("x"), (F.col("id") % 10 > 6).cast("int").alias("y"),
                                   (F.col("id") % 4 == 0).alias("held")).cache()
    train, val = rows.where("not held"), rows.where("held")

    def search():
        _, setting, score = M.grid_search(train, val, ["x"], "rf", grid=[{"maxDepth": 2}, {"maxDepth": 3}], label="y", num_trees=3)
        forest = M.fit(train, ["x"], "y", "rf", {"maxDepth": 2}, num_trees=3).stages[-1]
        return setting, score, M.tree_rule_table(forest, ["x"]).count() > 0

    assert M.side_by_side(spark, [search, search]) == [({"maxDepth": 2}, 1.0, True)] * 2    # no session was active in the threads
    rows.unpersist()
