"""Quality rules: a threshold table compiled into one Spark projection.

Everything is a built-in column expression over one row; no shuffle and no
user function.  Intermediate arrays are separate projected columns so that
array access inside lambdas is O(1); the only super-linear step is the sort
of the 5-word windows of texts that repeat some window.

Edge cases: a null, empty or blank text has zero of everything and fails the
base rule; other columns of the input pass through untouched or, for
``apply_rules``, are dropped; repeated rows are judged one by one.
5-word windows are compared by a 64-bit hash of their words (two different
windows of one text agree by chance with probability below n^2/2^65)."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NUM, words

#: Stop words of the languages the corpus is written in.
STOP_WORDS = {
    "en": "the of and to in a is that it was for on with as are be this by at from or an".split(),
    "de": "der die das und in zu den ist von mit nicht ein eine sich des auf für dem im auch als".split(),
    "fr": "le la les de des du et en un une est que qui dans pour par sur pas au avec il elle".split(),
    "es": "el la los las de del y en un una que es se por con para su al lo como no".split(),
}

#: The threshold table: metric, comparison a kept text must meet, threshold.
#: ``ratio:a/b`` is a divided by b, 0 where b is 0; ``a+1`` adds one, so that
#: a few words without a stop word pass.
RULES = [
    ("n_words", ">=", 10),
    ("n_words", "<=", 1_000_000),
    ("ratio:word_chars/n_words", ">=", 2.0),
    ("ratio:word_chars/n_words", "<=", 20.0),
    ("ratio:n_symbols/n_words", "<=", 0.1),
    ("ratio:n_bangs/n_words", "<=", 0.3),
    ("ratio:n_bullet_lines/n_lines", "<=", 0.9),
    ("ratio:n_ellipsis_lines/n_lines", "<=", 0.3),
    ("ratio:n_dup_lines/n_lines", "<=", 0.5),
    ("ratio:n_adjacent/n_words", "<=", 0.2),
    ("ratio:n_stop_words+1/n_words", ">=", 0.02),
]
BASE_MIN_WORDS = 10
BASE_MAX_REPEAT_PCT = 20


def _metric(name: str):
    if name.startswith("ratio:"):
        a, b = name[6:].split("/")
        a, _, more = a.partition("+")
        return F.when(F.col(b) > 0, (F.col(a) + int(more or 0)) / F.col(b)).otherwise(F.lit(0.0))
    return F.col(name)


def compile_rules(rules=RULES):
    """One boolean column: every row of the threshold table holds."""
    ok = F.lit(True)
    for name, op, limit in rules:
        m = _metric(name)
        ok = ok & ((m >= F.lit(limit)) if op == ">=" else (m <= F.lit(limit)))
    return ok


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stop_words=None) -> DataFrame:
    """Per row: the id and every metric of the threshold table (longs)."""
    stops = sorted({w for ws in (stop_words or STOP_WORDS).values() for w in ws})
    t = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("__t"))
    t = t.withColumn("__w", words(F.col("__t")))
    has_word = lambda x: x.rlike(r"[^\x20\x09-\x0D]")
    t = t.withColumn("__l", F.filter(F.split("__t", "\n", -1), has_word))
    t = t.withColumn("__h", F.transform("__w", lambda w: F.xxhash64(w)))
    at = lambda i: F.get(F.col("__h"), i)
    t = t.withColumn("__g", F.when(
        F.size("__h") >= 5,
        F.transform(F.slice("__h", F.lit(1), F.greatest(F.size("__h") - 4, F.lit(0))),
                    lambda h, i: F.coalesce(F.xxhash64(h, at(i + 1), at(i + 2), at(i + 3), at(i + 4)), F.lit(0)))))
    # positions of repeated windows, for texts that have any
    t = t.withColumn("__p", F.when(
        F.size(F.array_distinct("__g")) < F.size("__g"),
        F.sort_array(F.transform("__g", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))))
    g_at = lambda k: F.get(F.col("__p"), k).getField("g")
    same = lambda p, k: F.coalesce((F.when(k > 0, g_at(k - 1)) == p["g"]) | (g_at(k + 1) == p["g"])
                                   , (F.when(k > 0, g_at(k - 1)) == p["g"]), (g_at(k + 1) == p["g"]), F.lit(False))
    t = t.withColumn("__q", F.sort_array(F.transform(F.filter("__p", same), lambda p: p["i"])))
    covered = F.aggregate(
        F.transform("__q", lambda q, k: F.least(F.coalesce(F.get(F.col("__q"), k + 1) - q, F.lit(5)), F.lit(5))),
        F.lit(0), lambda a, x: a + x)
    count = lambda pattern: F.regexp_count("__t", F.lit(pattern)).cast(NUM)
    out = t.select(
        "doc_id",
        F.size("__w").cast(NUM).alias("n_words"),
        F.length(F.array_join("__w", "")).cast(NUM).alias("word_chars"),
        count(r"[#*$%&|<>]").alias("n_symbols"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast(NUM).alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast(NUM).alias("n_repeat_words"),
        count("!").alias("n_bangs"),
        F.size("__l").cast(NUM).alias("n_lines"),
        F.size(F.filter("__l", lambda x: x.rlike(r"^[\x20\x09-\x0D]*[-*•]"))).cast(NUM).alias("n_bullet_lines"),
        F.size(F.filter("__l", lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$"))).cast(NUM).alias("n_ellipsis_lines"),
        F.size(F.filter("__h", lambda h, i: h == at(i - 1))).cast(NUM).alias("n_adjacent"),
        F.size(F.filter("__w", lambda w: F.lower(w).isin(stops))).cast(NUM).alias("n_stop_words"),
    )
    # a row count that the optimizer doesn't push filters through: a later
    # filter on a metric would else repeat the array expressions inside lambdas
    return out.observe(f"quality-rules-{uuid.uuid4().hex}", F.count(F.lit(1)).alias("rows"))


def apply_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                rules=RULES, stop_words=None) -> DataFrame:
    """Metrics plus ``base_failed`` and ``kept`` (false when the base fails, else the table's verdict)."""
    m = measure(docs, id_col, text_col, stop_words)
    m = m.withColumn("base_failed", (F.col("n_words") < BASE_MIN_WORDS)
                     | (100 * F.col("n_repeat_words") > BASE_MAX_REPEAT_PCT * F.col("n_words")))
    return m.withColumn("kept", ~F.col("base_failed") & compile_rules(rules))
