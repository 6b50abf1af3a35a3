"""Quality classifier and toxicity grammar."""
import numpy as np

from faultline.llm import quality_pu, toxicity
from faultline.llm.common import is_train

from .conftest import odd_rows

SF = "/root/testdata/sf0.01"


def held_out_scores(spark, scored, label):
    y = spark.read.parquet(f"{SF}/labels.parquet")
    p = scored.join(y, "doc_id").toPandas()
    assert all(h != is_train(int(d)) for h, d in zip(p.held_out, p.doc_id))
    assert p.score.between(0, 1).all()
    p = p[p.held_out]
    return p[label], p.predicted


def test_quality_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    m = quality_pu.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert 0.7 < m.prior < 0.95
    y, p = held_out_scores(spark, quality_pu.score(docs, m), "quality")
    assert (y == p).mean() > 0.95


def test_prior_estimate():
    r = np.random.default_rng(0)
    pos, neg = r.normal(3, 1, 4000), r.normal(-3, 1, 4000)
    for share in (0.3, 0.6, 0.9):
        unl = np.concatenate([r.normal(3, 1, int(4000 * share)), neg[:int(4000 * (1 - share))]])
        assert abs(quality_pu.estimate_prior(pos, unl) - share) < 0.06


def test_nonnegative_risk_separates():
    r = np.random.default_rng(1)
    pos = r.normal(1, 1, (800, 3))
    bad = r.normal(-2, 1, (600, 3))
    m = quality_pu.PUModel().fit(pos, np.concatenate([r.normal(1, 1, (900, 3)), bad]))
    assert m.score(r.normal(1, 1, (500, 3))).mean() > 0.8 and m.score(bad).mean() < 0.3


def test_quality_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(4, 1), (6, 1), (7, 1), (8, 0), (None, 1), (9, None)] +
                                   [(100 + i, 1) for i in range(30)], "doc_id bigint, quality int")
    for lab in (labels, labels.limit(0)):
        got = quality_pu.score(odd, quality_pu.fit(odd, lab)).collect()
        assert len(got) == len(odd_rows()) and all(0 <= r["score"] <= 1 for r in got)
        assert len({r["score"] for r in got if r["doc_id"] == 11}) == 1
    assert quality_pu.score(none, quality_pu.fit(none, labels)).count() == 0


def test_machine_marks_clauses():
    g = toxicity.Grammar({"=idiot": 3.0, "^trash": 2.0})
    kind = lambda t: {k: v for k, v in zip(toxicity.KINDS, g.sums(t)) if v}
    assert kind("an idiot here") == {"plain": 3.0}
    assert kind("you are an idiot.") == {"directed": 3.0}
    assert kind("he is not an idiot") == {"negated": 3.0}
    assert kind("she said idiot") == {"reported": 3.0}
    assert kind("not now. an idiot") == {"plain": 3.0}
    assert kind("Trashy; you TRASH\nidiotic") == {"plain": 2.0, "directed": 2.0}
    assert kind("i will kill it") == {"threat": 2.0} and kind("you i will kill") == {"threat_directed": 2.0}
    assert kind("skills overkill") == {} == kind("") == kind(None)
    a, b = g.score(np.array([g.sums("you idiot"), g.sums("no idiot")]))
    assert a > b


def test_toxicity_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    g = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert {"=idiot", "=scum"} <= set(g.insults)
    y, p = held_out_scores(spark, toxicity.score(docs, g), "toxic")
    assert (y == p).mean() > 0.95
    kept = toxicity.reject(docs, g)
    assert kept.schema == docs.schema
    bad = toxicity.score(docs, g).where("predicted = 1").count()
    assert bad and kept.count() == docs.count() - bad


def test_copies_lend_no_support(spark):
    one = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau"
    rows = [(i, one + (f" extra{i}" if i else ""), 1) for i in range(30)] + \
        [(100 + i, f"clean words number {i} and {i * 7} others {i * 13}", 0) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, y int")
    kept = {r["doc_id"] for r in toxicity.without_copies(df).collect()}
    assert 0 in kept and len([d for d in kept if d < 100]) <= 5


def test_toxicity_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(4, 1), (6, 1), (7, 1), (8, 0), (None, 1), (9, None)] +
                                   [(100 + i, int(i < 8)) for i in range(30)], "doc_id bigint, toxic int")
    for lab in (labels, labels.limit(0)):
        g = toxicity.fit(odd, lab)
        got = toxicity.score(odd, g).collect()
        assert len(got) == len(odd_rows()) and all(0 <= r["score"] <= 1 for r in got)
        assert toxicity.reject(odd, g).columns == odd.columns
    assert toxicity.score(none, toxicity.fit(none, labels)).count() == 0


def test_quality_risk_gradient():
    """The followed gradient is that of the non-negative risk, by finite differences on both sides of the clamp."""
    import numpy as np

    from faultline.llm.quality_pu import PUModel
    r = np.random.default_rng(3)
    m = PUModel(edges=[np.array([0.0, 1.0]), np.array([0.5])], weights=r.normal(size=5), bias=0.3)
    pos, unl = r.normal(1, 1, (40, 2)), r.normal(0, 1, (70, 2))
    bp, bu = m._bins(pos), m._bins(unl)
    for pi in (0.2, 0.95):
        for bias in (0.3, -6.0):
            m.bias = bias
            below = m.risk_parts(bp, bu, pi)[1] < 0
            f = (lambda: -m.risk_parts(bp, bu, pi)[1]) if below else (lambda: sum(m.risk_parts(bp, bu, pi)))
            g = m.risk_gradient(bp, bu, pi)
            for k in range(6):
                def at(h, k=k):
                    if k < 5:
                        m.weights[k] += h
                    else:
                        m.bias += h
                    v = f()
                    if k < 5:
                        m.weights[k] -= h
                    else:
                        m.bias -= h
                    return v
                assert abs((at(1e-5) - at(-1e-5)) / 2e-5 - g[k]) < 1e-6


def test_quality_sparse_labels(spark):
    """A few labels among very many documents all take part in the fit, and none gives a warning."""
    import random

    import pytest

    from faultline.llm import quality_pu as Q
    r = random.Random(1)
    rows = []
    for i in range(4000):
        good = i % 3 > 0
        w = ["".join(r.choices("abcdefgh", k=r.randint(2, 8))) for _ in range(40)]
        rows.append((i, " ".join(w) + "." if good else " ".join("#!%0"[r.randrange(4)] * 3 for _ in w)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(0, 50)], "doc_id bigint, quality int")
    m = Q.fit(docs, labels, fit_rows=200)
    got = Q.score(docs, m).toPandas()
    assert ((got.predicted == 1) == (got.doc_id % 3 > 0)).mean() > 0.8  # a draw of some 27 positives
    with pytest.warns(UserWarning, match="trusted positives"):
        m = Q.fit(docs, labels.where("quality = 0"))
    assert {x["score"] for x in Q.score(docs.limit(5), m).collect()} == {0.5}


def _kinds(g, clause):
    return {k for k, v in zip(toxicity.KINDS, g.sums(clause)) if v}


def test_clause_roles_in_either_order():
    g = toxicity.Grammar({"=idiot": 3.0, "=scum": 3.0})
    assert _kinds(g, "i will kill you") == _kinds(g, "you i will kill") == {"threat_directed"}
    assert _kinds(g, "idiot, you are") == _kinds(g, "you are an idiot") == {"directed"}
    assert _kinds(g, "an idiot, she said") == _kinds(g, "she said an idiot") == {"reported"}
    assert _kinds(g, "I said hello and you are an idiot") == {"directed"}
    assert _kinds(g, "you are an idiot and she said hello") == {"directed"}
    assert _kinds(g, "not an idiot") == {"negated"} and _kinds(g, "what an idiot") == {"plain"}
    assert _kinds(g, "never in all my long years an idiot") == {"plain"}  # beyond the negation's reach
    assert _kinds(g, "an idiot. you are scum") == {"plain", "directed"}


def test_machine_against_plain_rules():
    """Forward and backward machines against scopes looked up position by position."""
    import random
    r = random.Random(3)
    g = toxicity.Grammar({})

    def near(symbols, i, opener, reach, step):
        for d in range(1, reach + 1):
            j = i + step * d
            if not 0 <= j < len(symbols) or symbols[j] == "C":
                return False
            if symbols[j] == opener:
                return True
        return False

    for _ in range(300):
        c = [r.choice("ITYNRCOOOO") for _ in range(r.randint(1, 14))]
        want = []
        for i, a in enumerate(c):
            if a in "IT":
                n = near(c, i, "N", toxicity.NEGATION_REACH, -1)
                q = any(near(c, i, "R", toxicity.REPORT_REACH, s) for s in (-1, 1))
                d = any(near(c, i, "Y", toxicity.TARGET_REACH, s) for s in (-1, 1))
                a += "n" * n + "r" * q + "d" * d
            want.append(a)
        assert g.marks(c) == want, c


def test_equal_words_different_roles():
    """Pairs of clauses with the same words: a sum of word weights can't tell them apart, the grammar does."""
    import numpy as np
    names = ["well", "here", "there", "today", "now", "again", "early", "late"]
    pairs = [(f"he said {w} and you are an idiot", f"you are {w} and he said an idiot") for w in names] + \
        [(f"i am not {w} today my friends you idiot", f"i am {w} today my friends you not idiot") for w in names]
    g = toxicity.Grammar({"=idiot": 3.0})
    x = np.array([g.sums(t) for p in pairs for t in p])
    y = np.array([k for _ in pairs for k in (1.0, 0.0)])
    words = [sorted(t.split()) for p in pairs for t in p]
    assert words[::2] == words[1::2]
    g.fit_layer(x[:24], y[:24])
    assert ((g.score(x[24:]) >= 0.5) == y[24:]).all()


def test_clean_documents_left_alone(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = toxicity.score(docs, toxicity.fit(docs, labels)).where("held_out").join(labels, "doc_id").toPandas()
    y, p = got.toxic, got.predicted
    assert (p[y == 0] == 0).mean() >= 0.98 and (p[y == 1] == 1).mean() > 0.85
