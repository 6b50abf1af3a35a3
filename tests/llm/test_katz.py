"""Katz backoff model against a plain evaluation, and its exact normalisation."""
import collections
import math
import random
import zlib

import numpy as np

from faultline.llm import katz as K


def out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


def brute(rows):
    """Expected rows (doc_id, held_out, n_tokens, n_known, N, base, score) and the largest error of a context's total."""
    def toks(t):
        return [*K.words(t), "</s>"]

    u, b, ctx = collections.Counter(), collections.Counter(), collections.Counter()
    for i, t in rows:
        if not out(i):
            x = toks(t)
            u.update(x)
            prev = ["<s>", *x[:-1]]
            b.update(zip(prev, x))
            ctx.update(prev)
    n, v = sum(u.values()), len(u)
    d1, d2 = (K.discounts([sum(1 for k in c.values() if k == r) for r in range(1, 7)]) for c in (u, b))

    def dis(d, c):
        return d[c - 1] * c if c <= 5 else c

    left = sum(c - dis(d1, c) for c in u.values())
    n1, unknown = (n, left / n) if left > 0 else (n + 1, 1 / (n + 1))
    after = collections.defaultdict(dict)
    for (p, w), c in b.items():
        after[p][w] = c

    def p1(w):
        return dis(d1, u[w]) / n1 if w in u else unknown

    weights = {}
    for p, f in after.items():
        kept, more = sum(c - dis(d2, c) for c in f.values()), 0
        if kept == 0:
            kept, more = 1, 1
        weights[p] = kept / (ctx[p] + more) / (1 - sum(p1(w) for w in f)), ctx[p] + more

    def prob(p, w):
        if p not in after:
            return p1(w)
        back, total = weights[p]
        return dis(d2, after[p][w]) / total if w in after[p] else back * p1(w)

    res = []
    for i, t in rows:
        x = toks(t)
        res.append((i, out(i), len(x), sum(w in u for w in x), n,
                    sum(math.log10((u[w] + .5) / (n + .5 * (v + 1))) for w in x),
                    sum(math.log10(prob(p, w)) for p, w in zip(["<s>", *x[:-1]], x))))
    off = max((abs(sum(prob(p, w) for w in u) + prob(p, None) - 1) for p in list(after)[:200]), default=0)
    return res, off


def same(got, want):
    def key(r):
        return r[0] is None, r[0], r[2], round(r[5], 6)
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want, strict=True):
        assert abs(g[5] - w[5]) < 1e-9 * max(1, abs(w[5])) and abs(g[6] - w[6]) < 1e-9 * max(1, abs(w[6]))


def odd_texts():
    r = random.Random(2)
    voc = ["a", "B", "b", "É", "x" * 50] + [f"w{i}" for i in range(40)]
    rows = [(r.choice([i, i, i, None]), r.choice([None, "", " \n", " ".join(
        r.choices(voc, range(len(voc), 0, -1), k=r.randint(1, 60)))])) for i in range(300)]
    return rows + [(1000 + i, "same text all over Again") for i in range(40)] + [(5, "q " * 20_000)]


def test_scores_and_totals(spark):
    rows = odd_texts()
    want, off = brute(rows)
    assert off < 1e-12
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, score string")
    # words, pairs, chunks and buckets at their bounds change nothing
    for bounds in ({}, {"frequent": 10, "frequent_pairs": 20, "chunk": 200, "least_buckets": 7}):
        got = K.fit_and_score(df, **bounds)
        assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        same(got.collect(), want)


def test_query_beats_its_base_on_held_out_texts(spark, sf):
    from faultline.llm import queries
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = queries.QUERIES["op11_katz_backoff"](spark, sf).collect()
    want, _ = brute([tuple(r) for r in docs])
    same(got, want)
    assert sum(r["score"] for r in got if r["held_out"]) > sum(r["base_score"] for r in got if r["held_out"])


def test_few_texts(spark):
    schema = "doc_id bigint, text string"
    assert K.fit_and_score(spark.createDataFrame([], schema)).count() == 0
    held = next(i for i in range(50) if out(i))
    r = K.fit_and_score(spark.createDataFrame([(held, "never learnt")], schema)).first()
    assert (r["train_tokens"], r["n_known"], r["n_tokens"], r["base_score"], r["score"]) == (0, 0, 3, 0.0, 0.0)


def test_discounts_fall_back():
    d = K.discounts([1000, 300, 130, 70, 45, 30])
    assert all(0 < x < 1 for x in d)
    for n in ([5, 0, 0, 0, 0, 0], [0, 3, 1, 1, 1, 1], [1, 9, 9, 9, 9, 9]):
        assert all(0 < x < 1 for x in K.discounts(n))


def test_packed_columns_round_trip():
    r = np.random.default_rng(1)
    a = r.integers(-(1 << 62), 1 << 62, 1000)
    assert (K.unrising(K.rising(a)) == a).all() and (K.unsqueeze(K.squeeze(a), np.int64) == a).all()
    assert len(K.unrising(K.rising(a[:0]))) == 0
