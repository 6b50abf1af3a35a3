"""Whole texts reach the Python workers in small batches."""
import pyarrow as pa
from pyspark.sql import functions as F

from faultline.llm import decontaminate
from faultline.llm.common import TEXT_ROWS

NAME = "spark.sql.execution.arrow.maxRecordsPerBatch"


def test_texts_come_in_small_batches(spark):
    docs = spark.range(0, 3000, 1, 1).select(F.col("id").alias("doc_id"), F.lit("some words of a text").alias("text"))
    items = spark.createDataFrame([(1, "Who wrote it? An old man from the north.")], "item_id bigint, text string")
    sizes = docs.mapInArrow(lambda bs: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in bs), "n bigint")
    before = spark.conf.get(NAME)
    try:
        spark.conf.unset(NAME)
        assert decontaminate.remove(docs, items).count() == 3000
        assert sizes.agg(F.max("n")).first()[0] <= TEXT_ROWS
        spark.conf.set(NAME, "2500")                # the session's own choice stays
        decontaminate.remove(docs, items)
        assert spark.conf.get(NAME) == "2500"
    finally:
        spark.conf.set(NAME, before)
