"""Exact digit sums against rational arithmetic."""
import math
import random
from fractions import Fraction

from pyspark.sql import functions as F

from faultline.functions.exact import digits_of, mean, tallies
from faultline.operators import series as D


def _means(spark, groups):
    rows = [(g, x) for g, xs in groups.items() for x in xs]
    df = spark.createDataFrame(rows, "g int, x double")
    places = digits_of(df, ["x"])["x"]
    parts = [*tallies(F.col("x")), *places.split(F.col("x"))]
    sums = df.groupBy("g").agg(*[F.sum(p).alias(f"s{i}") for i, p in enumerate(parts)])
    n, up, down, *digits = [F.col(f"s{i}") for i in range(len(parts))]
    return {r["g"]: r["m"] for r in sums.select("g", mean(places, digits, n, up, down).alias("m")).collect()}


def test_mean_is_exact_over_many_decades(spark):
    r = random.Random(3)
    groups = {i: [r.choice([-1, 1]) * r.random() * 10.0 ** r.randint(-300, 300) for _ in range(r.randint(1, 9))]
              for i in range(60)}
    groups[100] = [1e27, 1.0, -1e27]                    # cancels in doubles, not here
    groups[101] = [1.7e308, 1.7e308]                    # the total is no double, the mean is
    groups[102] = [5e-324, 1.5e-323]
    groups[103] = [-0.0, 0.0]
    got = _means(spark, groups)
    for g, xs in groups.items():
        want = float(sum(map(Fraction, xs)) / len(xs))
        assert got[g] == want or abs(got[g] - want) <= 4 * math.ulp(want), (g, xs, got[g], want)


def test_missing_and_infinite_values(spark):
    inf, nan = math.inf, math.nan
    got = _means(spark, {1: [1.0, inf], 2: [-inf, 2.0], 3: [inf, -inf], 4: [None, nan], 5: [nan, 3.0]})
    assert got[1] == inf and got[2] == -inf and math.isnan(got[3]) and got[4] is None and got[5] == 3.0


def test_rolling_mean_of_any_doubles_in_both_plans(spark):
    r = random.Random(4)
    rows = []
    for i in range(120):
        v = r.choice([1e-14, 3e-14, 1e27, -1e27, 5.0, None, math.nan, math.inf])
        rows.append((i, r.choice([1, 1, None]), r.choice([None, *range(0, 400, 40)]), v))
    df = spark.createDataFrame(rows, "row_id long, k int, s long, v double") \
        .withColumn("ts", F.timestamp_seconds("s").cast("timestamp_ntz"))

    def key(x):
        return (x[2], x[0])

    want = {}
    for row in rows:
        i, k, s, v = row
        win = [v] if s is None else [x[3] for x in rows if x[1] == k and x[2] is not None and s - 100 < x[2]
                                     and key(x) <= key(row)]
        win = [x for x in win if x is not None and not math.isnan(x)]
        if not win:
            want[i] = None
        elif math.inf in win:
            want[i] = math.inf
        else:
            want[i] = float(sum(map(Fraction, win)) / len(win))
    for strategy in ("window", "ranged"):
        got = {x["row_id"]: x["v"] for x in D.rolling_time_mean(
            df, ["v"], 100.0, keys=["k"], fill=False, strategy=strategy).collect()}
        assert len(got) == len(want)
        for i, w in want.items():
            assert got[i] == w or abs(got[i] - w) <= 4 * math.ulp(w), (strategy, i, got[i], w)


def test_mean_is_evaluated_once_per_row(spark):
    """Nested lambdas over the digits evaluated one another again, some dozen times a row."""
    df = spark.createDataFrame([(1, 1e-14), (1, 1e27)], "g int, x double")
    places = digits_of(df, ["x"])["x"]
    parts = [*tallies(F.col("x")), *places.split(F.col("x"))]
    rows = df.select(*[p.alias(f"s{i}") for i, p in enumerate(parts)])
    n, up, down, *digits = [F.col(c) for c in rows.columns]
    plan = rows.select(mean(places, digits, n, up, down).alias("m"))._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan and plan.count("ArrowEvalPython") == 1
