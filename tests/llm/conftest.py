import random

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

SCHEMA = StructType([StructField("doc_id", LongType()), StructField("text", StringType()),
                     StructField("lang", StringType()), StructField("source", StringType()),
                     StructField("n_chars", LongType()), StructField("size", StringType()),
                     StructField("component_id", StringType())])


def odd_rows():
    """Nulls in every column, empty, blank, very long and repeated texts, ties; two columns clash with outputs."""
    r = random.Random(5)
    vocab = ["the", "of", "Thér", "and", "in", "to", "ab,", "x.", "für", "Wörter!"] + [f"w{i}" for i in range(200)]
    text = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    base = text(120)
    rows = [(1, None, "en", "a", None, "s", None), (2, "", "en", "a", 0, "s", None),
            (3, " \n\t ", None, None, 4, None, None), (None, base, None, None, None, None, None),
            (4, base, "en", "b", len(base), "s", "c"), (5, base, "de", "b", len(base), "s", "c"),
            (6, base.replace("w1", "q1", 2), "de", "b", 1, "s", "c"), (7, text(30_000), "fr", "c", 9, "s", "c"),
            (8, "one two", "fr", "c", 9, "s", "c"), (9, "ONE TWO", "fr", "c", 9, "s", "c"),
            (10, "a b\x0bc\x1cd ▁e <s> <|endoftext|> <|ENDOFTEXT|>", "fr", "c", 9, "s", "c"),
            (11, "same line here\nsame line here\nother line\n\n", "fr", "c", 9, "s", "c")]
    rows += [(11, "same line here\nsame line here\nother line\n\n", "fr", "c", 9, "s", "c")] * 2
    rows += [(100 + i, text(r.randint(1, 80)), "en", "d" if i % 3 else "e", i, "s", "c") for i in range(60)]
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


def tables(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con
