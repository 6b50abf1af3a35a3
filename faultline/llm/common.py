"""Helpers shared by the training-data operators."""
from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: ASCII white space; a word is a maximal run of anything else.
SPACE_CLASS = r"\x20\x09-\x0D"
WORD_RE = rf"[^{SPACE_CLASS}]+"
NUM = "bigint"


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in this application's own folder under the shared checkpoint folder."""
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def run_folder(spark: SparkSession) -> str:
    """All intermediate tables of an application are below this folder; nothing else is.

    It may be removed as soon as the application's results are stored
    (:func:`clear`, or by whoever cleans up after ended applications)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{spark.sparkContext.applicationId}"


def _remove(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def clear(spark: SparkSession) -> None:
    """Remove this application's intermediate tables.  Only frames that are stored elsewhere stay readable."""
    _remove(spark, run_folder(spark))


def stored(df: DataFrame, name: str, instead_of=()) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts the
    lineage and survives lost executors.  Stored frames that only ``df`` was
    made from (``instead_of``) are removed once it is written."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    for old in instead_of:
        if at := getattr(old, "_stored_at", None):
            _remove(spark, at)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def held_out(doc_id: Column | str) -> Column:
    """The labels contract's fold: crc32(doc_id as text) mod 5 = 0 (a null id is never held out)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def is_train(doc_id: int | None) -> bool:
    import zlib
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 != 0


def words(text: Column) -> Column:
    """Words of a text as an array; null and blank texts give an empty array."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({WORD_RE})"), F.lit(1))


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD_RE)).cast(NUM)


def n_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast(NUM)


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package (once per application), however the driver came by it."""
    import os
    import tempfile
    import zipfile
    sc = spark.sparkContext
    if getattr(sc, "_shipped_package", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(), os.path.basename(root) + ".zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(archive)  # Spark's own file service hands it out
    sc._shipped_package = True


#: Rows of an Arrow batch of whole texts; Spark's default is 10,000.
TEXT_ROWS = 1000


def text_batches(spark: SparkSession) -> None:
    """Whole texts go to the Python workers in batches of at most ``TEXT_ROWS`` rows, unless the session says otherwise.

    A batch is held by the executor's JVM and by the worker, in and out, for every task."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, str(TEXT_ROWS))


FILTER_WORDS = 1 << 18


def maybe_in(docs: DataFrame, key: Column, ids: DataFrame, out: str = "__maybe") -> DataFrame:
    """Add a boolean: false only if ``key`` is surely not among ``ids`` (one column).

    A bitmap of hashed ids, about sixteen bits an id and at most
    ``FILTER_WORDS`` 64-bit words whatever their number, is broadcast; so a
    join with few ids moves few rows, and with very many ids merely all."""
    node = F.col(ids.columns[0])
    n = max(1, min(FILTER_WORDS, ids.count() // 4 + 1))
    h = lambda c: F.xxhash64(F.lit("filter"), c.cast("bigint"))
    word = lambda c: F.pmod(F.shiftright(h(c), 6), F.lit(n))
    bit = lambda c: F.call_function("shiftleft", F.lit(1).cast("bigint"),
                                    h(c).bitwiseAND(F.lit(63)).cast("int"))
    bits = ids.groupBy(word(node).alias("__word")).agg(F.bit_or(bit(node)).alias("__bits"))
    got = docs.withColumn("__at", word(key)).join(F.broadcast(bits), F.col("__at") == F.col("__word"), "left")
    return got.withColumn(out, F.coalesce(F.col("__bits").bitwiseAND(bit(key)) != 0, F.lit(False))) \
        .drop("__at", "__word", "__bits")
