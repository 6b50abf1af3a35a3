"""Near-duplicates, components and benchmark leaks against brute force."""
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from faultline.llm import decontaminate as D
from faultline.llm import near_dedup as N
from faultline.llm import queries
from faultline.llm.components import connected_components

from .conftest import odd_rows


def union_find(nodes, pairs):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute_components(rows):
    sets = {}
    for d, t in rows:
        w = (t or "").encode().lower().split()
        sets[d] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    ids = sorted(d for d in sets if d is not None)
    pairs = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:]
             if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    return {d: (len(s), union_find(ids, pairs).get(d)) for d, s in sets.items()}


def check(spark, rows):
    got = N.components(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    want = brute_components(rows)
    assert len(got) == len(rows)
    for r in got:
        n, c = want[r["doc_id"]]
        assert (r["n_shingles"], r["component_id"], r["kept"]) == (n, c, r["doc_id"] == c or r["doc_id"] is None)


def test_graph_components(spark):
    r = random.Random(4)
    chain = [(i, i + 1) for i in range(0, 40)]
    hub = [(1000, 1000 + i) for i in range(1, 80)]
    rand = [(r.randint(2000, 2120), r.randint(2000, 2120)) for _ in range(90)]
    edges = chain + hub + rand + [(5, 5), (7, 6), (7, 6)]
    r.shuffle(edges)
    df = spark.createDataFrame([*edges, (None, 3), (4, None)], "u bigint, v bigint")
    got = {x["node"]: x["component"] for x in connected_components(df).collect()}
    loops = {a for a, b in edges if a == b}
    want = union_find({x for e in edges for x in e}, edges)
    assert got == {n: c for n, c in want.items() if n in got} and set(want) - set(got) <= loops
    assert connected_components(df.limit(0)).count() == 0


def test_group_with_members_that_only_reach_others(spark, monkeypatch):
    """A hot group: noisy copies of one text, many below the threshold with most others."""
    monkeypatch.setattr(N, "BLOCK_ROWS", 16)
    r = random.Random(6)
    base = [f"b{i}" for i in range(160)]
    rows = []
    for d in range(150):
        w = list(base)
        for k in r.sample(range(160), r.randint(0, 9)):
            w[k] = f"n{d}_{k}"
        rows.append((d, " ".join(w)))
    rows += [(500 + i, " ".join(f"u{r.randint(0, 900)}" for _ in range(100))) for i in range(40)]
    rows += [(600, rows[3][1].upper()), (601, rows[3][1])]
    check(spark, rows)


def test_exact_threshold():
    a = np.arange(80, dtype=np.uint64)
    assert N.similar(a[:75], np.arange(100, dtype=np.uint64)) and not N.similar(a[:74], np.arange(99, dtype=np.uint64))
    assert not N.similar(a[:0], a[:0])


def test_odd_rows(spark, odd, none):
    check(spark, [r[:2] for r in odd_rows() if r[0] is not None] + [(None, odd_rows()[3][1])])
    out = N.components(odd)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    kept = N.keep_first(odd)
    assert kept.schema == odd.schema and {5, 9} & {r["doc_id"] for r in kept.collect()} == set()
    assert N.components(none).count() == 0 and N.keep_first(none).count() == 0


def test_whole_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = brute_components(rows)
    for r in queries.QUERIES["op9_minhash_near_dedup"](spark, sf).collect():
        assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]


def test_one_stray_node_deals_few_rows(spark):
    from pyspark.sql import functions as F
    n = 40_000
    b = spark.range(n + 1).select(F.lit(1).cast("bigint").alias("key"), F.col("id").alias("node"),
                                  F.when(F.col("id") < n, 0).otherwise(F.col("id")).alias("component"),
                                  F.lit(100).alias("n"), F.lit(b"x" * 288).alias("sig"))
    dealt = N._blocks(b, F.lit(320))
    assert dealt.count() < 100_000
    cells = dealt.groupBy("pair").agg(F.count("*").alias("m"), F.sum((F.col("side") == 1).cast("int")).alias("v"))
    r = cells.agg(F.max("m"), F.min("v"), F.sum(F.col("m") - F.col("v"))).first()
    assert r[0] < 2 * N.BLOCK_ROWS and r[1] == 1 and r[2] == n + 1


def test_each_pair_of_other_components_meets_once(spark, monkeypatch):
    from pyspark.sql import functions as F
    monkeypatch.setattr(N, "BLOCK_ROWS", 4)
    b = spark.range(40).select(F.lit(1).cast("bigint").alias("key"), F.col("id").alias("node"),
                               F.when(F.col("id") < 25, 0).otherwise(F.floor(F.col("id") / 3)).alias("component"),
                               F.lit(1).alias("n"), F.lit(b"s").alias("sig"))
    rows = N._blocks(b, F.lit(0)).collect()
    cells = defaultdict(list)
    for r in rows:
        cells[r["pair"]].append(r)
    met = Counter()
    for c in cells.values():
        comp, node = np.array([r["component"] for r in c]), np.array([r["node"] for r in c])
        side, sig = np.array([r["side"] for r in c]), np.zeros((len(c), 288), np.uint8)
        for i, at in N.block_pairs(comp, np.ones(len(c)), side, sig, node):
            met.update(frozenset((int(node[i]), int(node[k]))) for k in at)
    comp = {r["node"]: r["component"] for r in rows}
    want = {frozenset((a, c)) for a in comp for c in comp if comp[a] != comp[c]}
    assert set(met) == want and set(met.values()) == {1}


def test_one_id_with_two_texts_joins_nothing_else(spark):
    r = random.Random(4)
    text = [" ".join(f"q{r.randrange(10**6)}" for _ in range(60)) for _ in range(2)]
    rows = [(1, text[0]), (1, text[1]), (2, text[0]), (3, text[1]), (4, None), (4, "one two")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = [(x["doc_id"], x["component_id"]) for x in N.components(df).collect()]
    assert len(got) == 6 and len({c for d, c in got if d == 1}) == 1
    comp = dict(got)
    # document 1 is one of its texts, so exactly one of 2 and 3 is its copy
    assert sorted((comp[2] == 1, comp[3] == 1)) == [False, True] and comp[4] == 4
    left = sorted(x["doc_id"] for x in N.keep_first(df).collect())
    assert left in ([1, 1, 2, 4, 4], [1, 1, 3, 4, 4])


def plain_grams(words):
    n = min(D.GRAM, len(words))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if n else set()


def brute_leaks(docs, items):
    out, where, size = set(), defaultdict(set), {}
    for i, t in items:
        size[i] = [plain_grams(D.tokens(p)) for p in D.parts(t, None, False)]
        for x in set().union(*size[i]):
            where[x].add(i)
    lens = {len(x) for x in where}
    for d, t in docs:
        w = D.tokens(t)
        have = {tuple(w[i:i + n]) for n in lens for i in range(len(w) - n + 1)}
        hit = Counter(i for x in have for i in where.get(x, ()))
        for i in hit:
            q, a = size[i]
            if len(q & have) + len(a & have) >= 0.5 * (len(q) + len(a)):
                out.add((d, i))
    return out


def test_leaks_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    got = {(r["doc_id"], r["item_id"]) for r in queries.QUERIES["op8_benchmark_leaks"](spark, sf).collect()}
    assert got and got == brute_leaks([tuple(r) for r in docs.select("doc_id", "text").collect()],
                                      [tuple(r) for r in items.collect()])
    bad = {d for d, _ in got}
    left = D.remove(docs, items)
    assert left.schema == docs.schema
    assert {r["doc_id"] for r in left.collect()} == {r["doc_id"] for r in docs.collect()} - bad


def test_bounds_lose_nothing():
    """Everything above the threshold by plain scoring is retrieved."""
    r = random.Random(8)
    vocab = [f"v{i}" for i in range(300)]
    items = [(i, " ".join(r.choice(vocab) for _ in range(r.randint(5, 90))), "") for i in range(70)]
    ix = D.Index(items)
    texts = []
    for _ in range(60):
        w = [r.choice(vocab) for _ in range(r.randint(0, 400))]
        if r.random() < .6:
            src = r.choice(items)[1].split()
            at = r.randint(0, len(w))
            w[at:at] = src[:r.randint(1, len(src))]
        texts.append(np.array([ix.terms.get(x.encode(), -1) for x in w], np.int64))
    got = {(x, c, i): s for x, c, i, s in zip(*(v.tolist() for v in ix.candidates(texts)))}
    impact = {(k // ix.n, k % ix.n): v for k, v in zip(ix.post_key.tolist(), ix.post_impact.tolist())}
    want = {}
    for x, t in enumerate(texts):
        for c in range(-(-len(t) // ix.chunk)):
            have = {k for k in t[c * ix.chunk:(c + 2) * ix.chunk].tolist() if k >= 0}
            for i in range(len(items)):
                v = sum(impact.get((k, i), 0) for k in have)
                if v >= D.RETRIEVE * D.UNIT:
                    want[x, c, i] = v
    assert got == want and len(want) > 20


def test_scores_do_not_depend_on_parts(spark):
    r = random.Random(9)
    vocab = [f"v{i}" for i in range(120)]
    items = [(i, " ".join(r.choice(vocab) for _ in range(r.randint(8, 60))) + ". " + r.choice(vocab)) for i in range(200)]
    rows = []
    for k in range(60):
        w = items[r.randrange(200)][1].split()
        rows.append((k, " ".join(r.choice(vocab) for _ in range(r.randint(0, 90))) + " " + " ".join(
            x if r.random() < .9 else r.choice(vocab) for x in w)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    size = sum(len(t) for _, t in items)
    found = [sorted(tuple(x) for x in D.contaminated(docs, bench, part_bytes=-(-size // n)).collect()) for n in (1, 5, 20)]
    assert found[0] == found[1] == found[2] and len(found[0]) > 20


def test_leaks_odd(spark, odd, none):
    leak = " ".join(f"z{i}" for i in range(40))
    rows = [(900, "lead in words " + leak.upper().replace(" ", ", ") + " and on"), (901, leak[:60]), (902, None)]
    docs = spark.createDataFrame(rows + [rows[0]], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, leak, "tail"), (2, leak, None), (3, None, None), (4, "", None), (None, "q", None)],
                                  "item_id bigint, text string, answer string")
    want = [(900, 1), (900, 1), (900, 2), (900, 2)]
    pairs = lambda df: sorted((r["doc_id"], r["item_id"]) for r in df.collect())
    assert pairs(D.contaminated(docs, items)) == want
    assert {r["doc_id"] for r in D.remove(docs, items).collect()} == {901, 902}
    got = D.contaminated(docs, items, answer_col="answer").collect()
    assert {r["answer_overlap"] for r in got if r["item_id"] == 1} == {0.0}
    assert pairs(D.contaminated(docs, items, part_bytes=64)) == want
    assert D.contaminated(odd, items.limit(0)).count() == 0 and D.contaminated(none, items).count() == 0
    assert D.remove(odd, items).schema == odd.schema


def test_pipeline_stages(spark, sf):
    pytest.importorskip("corpus_pipeline")
    import corpus_pipeline as C
    docs = start = queries.read(spark, sf, "documents")
    from faultline.llm.common import stored
    seen = []
    for name, stage in C.STAGES:
        out = stored(stage(spark, docs, sf), f"t-{name}")
        if name != "shards":
            assert out.schema == start.schema
        seen.append((name, docs, out))
        docs = out
    ids = lambda df: Counter(r[0] for r in df.select("doc_id").collect())
    (_, a, b), (_, _, c), (_, _, d), (_, _, e), (_, _, f) = seen
    assert 0 < b.count() <= a.count()
    comp = brute_components([tuple(r) for r in b.select("doc_id", "text").collect()])
    assert set(ids(c)) == {i for i, (_, k) in comp.items() if i == k}
    items = [tuple(r) for r in queries.read(spark, sf, "benchmark").collect()]
    leaks = brute_leaks([tuple(r) for r in c.select("doc_id", "text").collect()], items)
    assert set(ids(d)) == set(ids(c)) - {x for x, _ in leaks}
    assert set(ids(e)) <= set(ids(d)) and max(ids(e).values()) <= 2
    rows = f.collect()
    assert ids(f) == ids(e)
    sizes = Counter(r["shard"] for r in rows)
    assert max(sizes.values()) - min(sizes.get(k, 0) for k in range(24)) <= 1


def test_bitmap_never_loses_a_member(spark, monkeypatch):
    from pyspark.sql import functions as F

    from faultline.llm import common
    docs = spark.range(6000).withColumn("text", F.lit("x"))
    ids = spark.range(0, 6000, 13).withColumnRenamed("id", "node")
    for words in (common.FILTER_WORDS, 2):
        monkeypatch.setattr(common, "FILTER_WORDS", words)
        got = common.maybe_in(docs, F.col("id"), ids)
        assert got.columns == ["id", "text", "__maybe"] and got.count() == 6000
        assert got.where("id % 13 = 0 and not __maybe").count() == 0
        if words > 2:
            assert got.where("id % 13 <> 0 and __maybe").count() < 1200
    assert common.maybe_in(docs, F.col("id"), ids.limit(0)).where("__maybe").count() == 0
