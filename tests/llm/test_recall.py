"""Recall at 10,000 documents: every document whose id is divisible by 20 against all rows, by brute force."""
from collections import Counter, defaultdict

from faultline.llm import decontaminate as D
from faultline.llm import queries

SF = "/root/testdata/sf0.1"


def shingle_set(text):
    w = [x.decode("utf-8", "surrogatepass") for x in (text or "").encode("utf-8", "surrogatepass").lower().split()]
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_near_duplicates(spark, capsys):
    docs = [tuple(r) for r in queries.read(spark, SF, "documents").select("doc_id", "text").collect()]
    asked = {d: shingle_set(t) for d, t in docs if d % 20 == 0}
    where = defaultdict(list)
    for d, s in asked.items():
        for x in s:
            where[x].append(d)
    linked = []
    for d, t in docs:
        s = shingle_set(t)
        hit = Counter(q for x in s for q in where.get(x, ()))
        for q, k in hit.items():
            if q != d and 100 * k >= 75 * (len(s) + len(asked[q]) - k):
                linked.append((q, d))
    comp = {r["doc_id"]: r["component_id"] for r in queries.QUERIES["op9_minhash_near_dedup"](spark, SF).collect()}
    found = sum(comp[a] == comp[b] for a, b in linked)
    with capsys.disabled():
        print(f"\nop9 recall: {found} of {len(linked)} links of {len(asked)} documents")
    assert len(linked) > 30 and found == len(linked)


def test_benchmark_leaks(spark, capsys):
    docs = [tuple(r) for r in queries.read(spark, SF, "documents").where("doc_id % 20 = 0").select("doc_id", "text").collect()]

    def grams(w):
        n = min(D.GRAM, len(w))
        return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if n else set()

    items, where = {}, defaultdict(set)
    for r in queries.read(spark, SF, "benchmark").collect():
        q, a = (grams(D.tokens(p)) for p in D.parts(r["text"], None, False))
        items[r["item_id"]] = len(q) + len(a)
        for k, g in enumerate((q, a)):
            for x in g:
                where[x].add((r["item_id"], k))
    sizes = {len(x) for x in where}
    want = set()
    for d, t in docs:
        w = D.tokens(t)
        have = {tuple(w[i:i + n]) for n in sizes for i in range(len(w) - n + 1)}
        hit = Counter(i for x in have for i, _ in where.get(x, ()))
        want |= {(d, i) for i, k in hit.items() if 2 * k >= items[i]}
    got = {(r["doc_id"], r["item_id"]) for r in queries.QUERIES["op8_benchmark_leaks"](spark, SF).where("doc_id % 20 = 0").collect()}
    with capsys.disabled():
        print(f"\nop8 recall: {len(want & got)} of {len(want)} leaks of {len(docs)} documents, {len(got - want)} others")
    assert len(want) >= 5 and len(want & got) >= 0.9 * len(want) and not got - want
