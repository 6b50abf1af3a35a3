"""Conversation trie and hard negatives against brute force."""
import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest

from faultline.llm import hard_negatives as H
from faultline.llm import prefix_trie as P
from faultline.llm import queries


def brute_trie(rows):
    convs = collections.defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            convs[c].append(((t is not None, t or 0), r or "", x or ""))
    convs = {c: [(r, x) for _, r, x in sorted(v)] for c, v in convs.items()}
    whole = {}
    for c, v in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = convs.get(c - int(math.fmod(c, 100)), [])[:h] + v[h:]
    nodes, kids, leaves, saved = collections.defaultdict(list), collections.Counter(), collections.Counter(), collections.Counter()
    for c, s in whole.items():
        for d in range(len(s) + 1):
            nodes[tuple(s[:d])].append(c)
    kids.update(s[:-1] for s in nodes if s)
    for s, m in nodes.items():
        for d in range(len(s) + 1):
            saved[s[:d]] += (len(m) - 1) * len(s[-1][1]) if s else 0
            leaves[s[:d]] += not kids[s]
    out = []
    for s, m in nodes.items():
        ends = ",".join(map(str, sorted(c for c in m if len(whole[c]) == len(s))))
        out.append((min(m), len(s), min(nodes[s[:-1]]) if s else None, len(m), kids[s], leaves[s], saved[s],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[:2])


SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def odd_conversations():
    r = random.Random(1)
    rows = []
    for c in [*range(0, 50), 100, *range(150, 165), -5, -100, -150, None]:
        for t in range(r.choice([0, 1, 2, 3, 9, 13, 30]) + 1):
            rows.append((c, r.choice([t, t, t, t, None, t + 1]), r.choice(["u", "a", None]), r.choice(["x", "yy", "", None, "xx"])))
    return rows + rows[:30]


@pytest.mark.parametrize("block", [4, 1, 7])
def test_trie_of_odd_conversations(spark, block):
    rows = odd_conversations()
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", depth int")
    assert rows_of(P.conversation_trie(df, block=block)) == brute_trie(rows)


def test_trie_edges(spark, monkeypatch):
    assert P.conversation_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert P.conversation_trie(spark.createDataFrame([(None, 1, "u", "x")], SCHEMA)).count() == 0
    # one text shared by very many conversations: ids are hashed piece by piece
    monkeypatch.setattr(P, "PIECE", 7)
    rows = [(c, t, "u", "same") for c in range(1, 90) for t in range(8)]
    got = rows_of(P.conversation_trie(spark.createDataFrame(rows, SCHEMA)))
    assert got == brute_trie(rows)


def test_trie_of_a_long_conversation(spark):
    """One conversation with most of the rows is scanned in ranges."""
    rows = [(c, t, "u", f"t{t}") for c, n in ((1, 900), (2, 5), (3, 905)) for t in range(n)]
    assert rows_of(P.conversation_trie(spark.createDataFrame(rows, SCHEMA))) == brute_trie(rows)


def test_trie_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(queries.QUERIES["op13_prefix_trie"](spark, sf)) == brute_trie(rows)


def brute_negatives(rows, every):
    ok = [(i, (lab + 1) - 10 * int((lab + 1) / 10) if i % 7 == 0 else lab, [math.floor(256 * float(x)) for x in v])
          for i, v, lab in rows if i is not None and lab is not None and v is not None
          and all(x is not None and math.isfinite(x) for x in v)]

    def dot(a, b):
        return max(-2**63, min(2**63 - 1, sum(x * y for x, y in zip(a, b))))

    out = []
    for a, lab, v in {(i, k, tuple(v)) for i, k, v in ok if i % every == 0}:
        s = sorted((-dot(v, w), j, m) for j, m, w in ok)
        for ps, p, _ in [t for t in s if t[2] == lab and t[1] != a][:5]:
            hard = [(ns, j) for ns, j, m in s if m != lab and 80 * -ps <= 100 * -ns <= 100 * -ps][:5]
            out += [(a, p, k + 1, j, -ps, -ns) for k, (ns, j) in enumerate(hard)]
    return sorted(out)


@pytest.mark.parametrize("scale", [1, 1e6, 1e12, 1e30])
def test_negatives_of_odd_vectors(spark, scale):
    r = random.Random(1)
    rows = [(r.choice([i, i, i, None]) if i > 5 else i,
             [r.choice([r.uniform(-1, 1) * scale] * 30 + [None, float("nan"), float("inf")]) for _ in range(r.choice([4, 4, 4, 3, 0, 6]))]
             if r.random() > .05 else None, r.choice([0, 1, 2, None, -4])) for i in range(250)]
    rows += rows[:40] + [(7, [0.5] * 4, 9), (0, [0.5] * 4, 1), (0, [0.5] * 4, 1)]
    df = spark.createDataFrame([(*x, "c") for x in rows], "vec_id bigint, embedding array<double>, label int, rank string")
    want = brute_negatives(rows, 10)
    for block in (H.ANCHORS, 7):
        assert sorted(tuple(x) for x in H.mine(df, every=10, block=block).collect()) == want


def test_negatives_query_and_empty(spark):
    sf = "/root/testdata/sf0.01"
    e = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label")
    got = sorted(tuple(x) for x in queries.QUERIES["op12_hard_negatives"](spark, sf).collect())
    assert got == brute_negatives([tuple(x) for x in e.collect()], 100) and len(got) > 100
    assert H.mine(e.limit(0)).count() == 0


def test_packed_products_are_exact():
    r = np.random.default_rng(2)
    for low, high in ((-150, 150), (-(1 << 20), 1 << 20), (-(1 << 40), 1 << 40), (0, 1), (-9, -3)):
        c, a = (r.integers(low, high + 1, (37, 16)) for _ in range(2))
        bias = max(0, -int(a.min()))
        p = H.Packed(c, bias, int(a.max()) + bias)
        want = np.clip(a.astype(object) @ c.astype(object).T, -(1 << 63), (1 << 63) - 1).astype(np.int64)
        assert (p.scores(a) == want).all()
        assert p.fields >= 2 or high > 1000
