"""Quality rules, mixing and shards."""
import re
import zlib
from collections import Counter

import pytest

from faultline.llm import mixing, quality_rules, queries, sharding

from .conftest import odd_rows, tables

WORD = re.compile("[^\x20\x09-\x0d]+")


@pytest.mark.parametrize("name", ["op3_quality_rules", "op4_mix_sources"])
def test_oracle(spark, sf, name):
    df = queries.QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted(tuple(r[c] for c in cols) for r in df.collect())
    sql = tables(sf).sql(queries.ORACLE[name])
    at = [sql.columns.index(c) for c in cols]
    assert got == sorted(tuple(r[i] for i in at) for r in sql.fetchall())


def brute_rules(text):
    t = text or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    seen = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {i + k for i in range(len(w) - 4) if seen[tuple(w[i:i + 5])] > 1 for k in range(5)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))


def test_rules_on_odd_rows(odd):
    got = quality_rules.apply_rules(odd).collect()
    cols = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted((tuple(r[c] for c in cols) for r in got), key=key) == \
        sorted(((r[0], *brute_rules(r[1])) for r in odd_rows()), key=key)
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])


def test_rules_empty_and_no_python(none, odd):
    out = quality_rules.apply_rules(none)
    assert out.count() == 0
    plan = quality_rules.apply_rules(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def brute_targets(sizes, cycle=(3, 1, 2)):
    order = sorted((s for s, _ in sizes if s is not None), key=lambda s: s.encode()) + \
        [None] * any(s is None for s, _ in sizes)
    size, w = dict(sizes), {s: cycle[i % 3] for i, s in enumerate(order)}
    full, total = {}, 1.5 * sum(size.values())
    while True:
        free = [s for s in order if s not in full]
        left = total - sum(full.values())
        t = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if t[s] > 2 * size[s]]
        if not over:
            return {**full, **t}
        full |= {s: 2.0 * size[s] for s in over}


def test_targets_match_repeated_resharing(spark, monkeypatch):
    import random
    r = random.Random(2)
    for k in range(8):
        monkeypatch.setattr(mixing, "ONE_TASK", 0 if k % 4 == 3 else 100)
        sizes = [(f"s{i}", r.choice([1, 5, 50, 1000, r.randint(1, 9999)])) for i in range(r.randint(1, 12))]
        if r.random() < .5:
            sizes.append((None, r.randint(1, 500)))
        frame = spark.createDataFrame(sizes, "source string, size bigint")
        want, got = brute_targets(sizes), {x["source"]: x["target"] for x in mixing.targets(frame).collect()}
        assert all(abs(want[s] - got[s]) < 1e-6 * max(1, want[s]) for s in want)


def test_mixture_of_many_sources(spark):
    """Sources are rows of a table, not literals of a plan."""
    from pyspark.sql import functions as F
    d = spark.range(60_000).select(F.col("id").alias("doc_id"), F.lit("one two three").alias("text"),
                                   F.concat(F.lit("host-"), F.col("id") % 20_000).alias("source"))
    t = mixing.mixture_table(d)
    assert len(t._jdf.queryExecution().optimizedPlan().toString()) < 20_000
    r = t.agg(F.sum("taken"), F.sum("size"), F.max(F.abs(F.col("source_size") - 9))).first()
    assert abs(r[0] - 1.5 * r[1]) < 0.1 * r[1] and r[2] == 0


def test_mixture(odd, none, spark, sf):
    rows = mixing.mixture_table(odd).collect()
    assert len(rows) == len(odd_rows())
    sizes = Counter()
    for _, t, _, s, *_ in odd_rows():
        sizes[s] += len(WORD.findall(t or ""))
    assert {r["source_size"] for r in rows} == set(sizes.values())
    assert all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in rows)
    assert mixing.mixture_table(none).count() == 0 and mixing.mix(none).count() == 0
    plan = {r["doc_id"]: r["copies"] for r in rows if r["doc_id"] not in (None, 11)}
    mixed = mixing.mix(odd)
    assert mixed.schema == odd.schema
    emitted = Counter(r["doc_id"] for r in mixed.collect())
    assert all(emitted[d] == c for d, c in plan.items())
    big = queries.QUERIES["op4_mix_sources"](spark, "/root/testdata/sf0.01").toPandas()
    for (size, target), g in big.groupby(["source_size", "target"]):
        assert abs(g.taken.sum() - target) <= 0.02 * size


def test_curve_is_continuous():
    digit, nxt = sharding.curve_tables(3)
    cells = {}
    for c in range(8 ** 3):
        x, y, z = c & 7, c >> 3 & 7, c >> 6
        state = h = 0
        for b in (2, 1, 0):
            k = state * 8 + (x >> b & 1) + (y >> b & 1) * 2 + (z >> b & 1) * 4
            h, state = h * 8 + digit[k], nxt[k]
        cells[h] = (x, y, z)
    assert len(cells) == 512
    assert all(sum(abs(p - q) for p, q in zip(cells[i], cells[i + 1])) == 1 for i in range(511))


def test_shards(odd, none, tmp_path):
    out = sharding.shard(odd, n_shards=7)
    assert [c for c in out.columns if c == "size"] == ["size"] and "component_id" in out.columns
    rows = out.collect()
    sizes = Counter(r["shard"] for r in rows)
    assert len(rows) == len(odd_rows()) and max(sizes.values()) - min(sizes[s] for s in range(7)) <= 1
    for s, n in sizes.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(n))
    for r in rows:
        raw = (r["text"] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 8, zlib.crc32(raw)) and r["grown_shard"] is None
    assert sharding.shard(none).count() == 0
    few = sharding.shard(odd.limit(3), n_shards=24, carry=False).collect()
    assert sorted(r["shard"] for r in few) == [0, 1, 2]
    sharding.write_shards(out, str(tmp_path / "shards"))
    assert out.sparkSession.read.parquet(str(tmp_path / "shards")).count() == len(rows)


def test_shards_prune_on_strings_that_start_alike(spark):
    """Each shard spans few of many long-prefixed sources, and the order is that of the curve index."""
    from pyspark.sql import functions as F
    d = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("https://common-crawl.example/"), F.pmod(F.xxhash64("id"), F.lit(200))).alias("source"),
        F.element_at(F.array(F.lit("de"), F.lit("en")), (F.col("id") % 2 + 1).cast("int")).alias("lang"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(9000)).alias("n_chars"), F.lit("x").alias("text"))
    out = sharding.shard(d)
    spans = out.groupBy("shard").agg(F.min("source").alias("a"), F.max("source").alias("b")).collect()
    values = sorted(r[0] for r in d.select("source").distinct().collect())
    width = [values.index(r["b"]) - values.index(r["a"]) for r in spans]
    assert sum(width) / len(width) < 0.6 * len(values)
    # a plain sort by the curve index cuts the same runs
    plain = sharding.with_curve_index(d).select("doc_id", "__curve").collect()
    curve = {r["doc_id"]: r["__curve"] for r in plain}
    rows = sorted(out.select("doc_id", "shard", "slot").collect(), key=lambda r: (r["shard"], r["slot"]))
    at = [curve[r["doc_id"]] for r in rows]
    assert at == sorted(at) and [r["shard"] for r in rows] == [i // 250 for i in range(6000)]
    assert len(set(at)) > 1500  # of 6000 rows: cells are rarely shared


def test_shards_without_dimensions(spark):
    d = spark.createDataFrame([(i, "t") for i in range(30)], "doc_id bigint, text string")
    assert Counter(r["shard"] for r in sharding.shard(d, n_shards=3).collect()) == {0: 10, 1: 10, 2: 10}
