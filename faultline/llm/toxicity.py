"""Toxicity by a weighted finite-state pattern grammar.

Transducers over token classes (insult, threat, target, negation, reported
speech, conjunction, other) are composed into two machines, one run over a
clause in reading order and one from its end.  They mark every insult or
threat as plain, directed at a target, negated, or reported, wherever the
target or the reporting verb stands; each reaches a bounded number of words
and no further than a conjunction.  The weights of the marked matches are
summed per kind, and a logistic layer turns the sums and the text's length
into a score (a long text meets a word beginning by chance more easily).  So
a match counts by the clause it stands in, not as an isolated word.

The function words of the grammar are fixed.  Insults are learnt from the
training labels: whole words and word beginnings that toxic documents have
and clean ones don't, by the log-likelihood ratio, first over all toxic
documents and then over those no pattern covers yet; a pattern's weight is
its smoothed log-odds.  Copies would lend the words of one document the
support of many, so of documents that share a minimum shingle hash only one
counts.  Counts are made by Spark over at most ``FIT_TOXIC``
toxic and ``FIT_CLEAN`` clean labelled documents drawn by a hash (a bound on
the fit alone); every whole text is scored, in one pass without a shuffle.

Edge cases: null and empty texts match nothing and get the score of a text
without matches; repeated rows are scored alike; null ids are never
labelled; without toxic labels only the grammar's threats remain; an empty
table gives an empty result; ``reject`` keeps all columns as they are."""
from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, ship, stored, text_batches

FIT_TOXIC = 6_000
FIT_CLEAN = 12_000
THRESHOLD = 0.5
MIN_SUPPORT = 3
MIN_SHARE = 0.02
#: Log-likelihood ratio that a pattern needs, by round; the later rounds look at uncovered documents.
LEVELS = (24.0, 15.0, 12.0)
#: How many words negation, a reporting verb and a target reach.
NEGATION_REACH, REPORT_REACH, TARGET_REACH = 3, 8, 6
PREFIXES = range(3, 8)

#: Function words of the grammar (fixed values).
TARGETS = frozenset("""you your yours yourself u he him she her they them their these those people everyone
du dich dir dein deine ihr euch sie er ihn leute tu toi te vous votre ton ta il elle ils elles eux gens
tú ti usted ustedes vosotros él ella ellos ellas gente""".split())
NEGATIONS = frozenset("""not no never none neither nor cannot isn't aren't wasn't weren't don't doesn't didn't won't
nicht kein keine keinen nie niemals ne pas jamais aucun aucune non nunca jamás ni tampoco""".split())
REPORTING = frozenset("""said says say told called calls wrote writes quoted quotes claimed claims alleged reported
according sagte sagt schrieb nannte laut zufolge dit disait écrit appelé selon dijo dice escribió llamó según""".split())
CONJUNCTIONS = frozenset("and but or so because while und aber oder denn weil et mais ou car y pero o porque".split())
THREATS = {w: 2.0 for w in """kill murder strangle stab shoot hang lynch rape töten umbringen erschießen tuer
égorger matar asesinar""".split()}

_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
_CLAUSE = re.compile(r"[^.!?;\n]+")


class Transducer:
    """Deterministic: (state, symbol) -> (state, symbol). A symbol is a class
    letter with marks; symbols without an arc pass, keeping the state."""

    def __init__(self, arcs: dict, start=0):
        self.arcs, self.start = arcs, start

    def step(self, state, symbol):
        return self.arcs.get((state, symbol), (state, symbol))

    def compose(self, other: Transducer, alphabet) -> Transducer:
        """The machine that feeds this one's output to ``other``."""
        arcs, todo, seen = {}, [(self.start, other.start)], {(self.start, other.start)}
        while todo:
            s = todo.pop()
            for a in alphabet:
                q, mid = self.step(s[0], a)
                r, out = other.step(s[1], mid)
                arcs[s, a] = ((q, r), out)
                if (q, r) not in seen:
                    seen.add((q, r))
                    todo.append((q, r))
        return Transducer(arcs, (self.start, other.start))

    def run(self, symbols):
        s, out = self.start, []
        for a in symbols:
            s, b = self.step(s, a)
            out.append(b)
        return out


_MATCH = ("I", "T")  # insult, threat; marks: n negated, r reported, d directed
_CLASSES = ("I", "T", "Y", "N", "R", "C", "O")


def _marked(symbol: str, mark: str) -> str:
    return symbol[0] + "".join(m for m in "nrd" if m in symbol[1:] or m == mark)


_SYMBOLS = [*(a + "".join(m for m, on in zip("nrd", (k & 1, k & 2, k & 4), strict=True) if on) for a in _MATCH
              for k in range(8)), "Y", "N", "R", "C", "O"]


def _near(opener: str, mark: str, reach: int, ends: str = "C") -> Transducer:
    """Marks matches at most ``reach`` words after an opener; a conjunction ends its scope."""
    arcs = {}
    for left in range(reach + 1):
        for a in _SYMBOLS:
            if a == opener:
                arcs[left, a] = (reach, a)
            elif a == ends:
                arcs[left, a] = (0, a)
            else:
                arcs[left, a] = (max(0, left - 1), _marked(a, mark) if left and a[0] in _MATCH else a)
    return Transducer(arcs)


def grammar() -> tuple[Transducer, Transducer]:
    """(forward, backward) machines: negation . reported speech . target in reading order, then reported speech .
    target from the end of the clause, for verbs and targets that come after their match."""
    spoken, target = _near("R", "r", REPORT_REACH), _near("Y", "d", TARGET_REACH)
    forward = _near("N", "n", NEGATION_REACH).compose(spoken, _SYMBOLS).compose(target, _SYMBOLS)
    return forward, spoken.compose(target, _SYMBOLS)


#: How the kinds of matches count before the data says otherwise.
KINDS = ("plain", "directed", "negated", "reported", "threat", "threat_directed")
#: Weights of the kinds, of the text's length and of a text without anything.
PRIOR = np.array([1.0, 1.3, 0.5, 0.6, 0.6, 1.5, 0.0, -4.0])


def _kind(symbol: str) -> int:
    if symbol[0] == "T":
        return 5 if symbol.endswith("d") and "n" not in symbol and "r" not in symbol else 4
    return 2 if "n" in symbol else 3 if "r" in symbol else 1 if symbol.endswith("d") else 0


class Grammar:
    """Lexicon of insults ("=word" or "^beginning" -> weight), machine and logistic layer."""

    def __init__(self, insults: dict[str, float], layer=PRIOR):
        self.insults, self.layer = insults, np.asarray(layer, float)
        self.forward, self.backward = grammar()
        self.words = {p[1:]: w for p, w in insults.items() if p[0] == "="}
        self.stems = {p[1:]: w for p, w in insults.items() if p[0] == "^"}
        self.lengths = sorted({len(p) for p in self.stems})
        alt = [re.escape(p) + r"(?![^\W_])" for p in [*self.words, *THREATS]] + [re.escape(p) for p in self.stems]
        self.any = re.compile(r"(?<![^\W_])(?:" + "|".join(sorted(alt)) + ")")

    def weight(self, word: str) -> float:
        w = self.words.get(word, 0.0)
        for k in self.lengths:
            w = max(w, self.stems.get(word[:k], 0.0))
        return w

    def _class(self, word: str) -> tuple[str, float]:
        w = self.weight(word)
        if w:
            return "I", w
        if word in THREATS:
            return "T", THREATS[word]
        return ("Y" if word in TARGETS else "N" if word in NEGATIONS or word.endswith("n't")
                else "R" if word in REPORTING else "C" if word in CONJUNCTIONS else "O"), 0.0

    def marks(self, classes: list[str]) -> list[str]:
        """Symbols of a clause: what is negated, reported or directed at a target, before or after the match."""
        return self.backward.run(self.forward.run(classes)[::-1])[::-1]

    def sums(self, text: str | None) -> np.ndarray:
        """Weight of the matches of each kind, over all clauses of the text, and the number of its words."""
        out = np.zeros(len(KINDS) + 1)
        low = (text or "").lower()
        out[-1] = len(low.split())
        at = 0
        while m := self.any.search(low, at):
            # the clause around the match
            lo = max(low.rfind(c, at, m.start()) for c in ".!?;\n") + 1
            end = _CLAUSE.match(low, m.start()).end()
            clause = [self._class(x) for x in _WORD.findall(low, max(lo, at), end)]
            for (_, w), s in zip(clause, self.marks([a for a, _ in clause]), strict=True):
                if w:
                    out[_kind(s)] += w
            at = end
        return out

    def score(self, sums: np.ndarray) -> np.ndarray:
        z = np.log1p(sums) @ self.layer[:-1] + self.layer[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def fit_layer(self, sums: np.ndarray, y: np.ndarray, pull: float = 0.0002, steps: int = 400) -> Grammar:
        """Logistic regression on the sums, pulled towards the prior weights."""
        x = np.c_[np.log1p(sums), np.ones(len(y))]
        w = PRIOR.copy()
        each = np.full(len(y), 1 / max(1, len(y)))
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            h = (x * (each * p * (1 - p))[:, None]).T @ x + pull * np.eye(len(w))
            w = w - np.linalg.solve(h, x.T @ (each * (p - y)) + pull * (w - PRIOR))
        self.layer = w
        return self


def patterns(text: str | None) -> set[str]:
    """Words and word beginnings of a text."""
    out = set()
    for w in set(_WORD.findall((text or "").lower())):
        out.add("=" + w)
        out.update("^" + w[:k] for k in PREFIXES if k < len(w))
    return out


def copy_keys(text: str | None, seeds: int = 4) -> list[int]:
    """Minimum hashes of a text's 3-word shingles under a few seeds; near copies share some."""
    words = (text or "").lower().split()
    if not words:
        return []
    grams = {" ".join(words[i:i + 3]).encode() for i in range(max(1, len(words) - 2))}
    h = np.fromiter((zlib.crc32(g) for g in grams), np.uint64, len(grams))
    out = []
    for k in range(seeds):
        mixed = (h + np.uint64(k + 1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        out.append(int(mixed.min() >> np.uint64(2)) * seeds + k & (1 << 62) - 1)
    return out


def without_copies(rows: DataFrame) -> DataFrame:
    """Rows (doc_id, text, ...) that are the first under each of their copy keys."""
    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                keys = [copy_keys(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(keys, pa.list_(pa.int64()))],
                                                 names=["doc_id", "keys"])

    kind = dict(rows.dtypes)["doc_id"]
    keys = rows.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, keys array<bigint>") \
        .select("doc_id", F.explode("keys").alias("key"))
    first = keys.groupBy("key").agg(F.min("doc_id").alias("first"))
    later = keys.join(first, "key").where(F.col("doc_id") != F.col("first")).select("doc_id").distinct()
    return rows.join(later, "doc_id", "left_anti")


def _ratio(a, b, n, m):
    """Log-likelihood ratio of a of n against b of m."""
    def term(k, e):
        return k * math.log(k / e) if k else 0.0
    p = (a + b) / (n + m)
    return 2 * (term(a, n * p) + term(n - a, n * (1 - p)) + term(b, m * p) + term(m - b, m * (1 - p)))


def choose(counts: dict[str, tuple[int, int]], n: int, m: int, level: float, had: dict[str, float]) -> dict[str, float]:
    """Patterns that pass ``level``: the strongest first, none inside another."""
    rated = []
    for p, (a, b) in counts.items():
        if a >= MIN_SUPPORT and a / n > 5 * b / max(m, 1):
            rated.append((-round(_ratio(a, b, n, m), 6), -len(p), p, a, b))
    got = dict(had)
    for neg, _, p, a, b in sorted(rated):
        if -neg < level:
            break
        if any((q[0] == "^" and p[1:].startswith(q[1:])) or (p[0] == "^" and q[1:].startswith(p[1:])) for q in got):
            continue
        got[p] = math.log((a + 0.5) / (n + 1)) - math.log((b + 0.5) / (m + 1))
    return got


def _counts(rows: DataFrame, known: Grammar | None, only: set[str] | None) -> DataFrame:
    """Documents per pattern: partial counts in each task, then one aggregation."""
    def run(batches):
        seen = Counter()
        for b in batches:
            for lo in range(0, b.num_rows, 128):
                for t in b.column(0).slice(lo, 128).to_pylist():
                    if known is None or not known.any.search((t or "").lower()):
                        seen.update(patterns(t) if only is None else patterns(t) & only)
                if len(seen) > 400_000:
                    yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()),
                                                      pa.array(seen.values(), pa.int64())], names=["p", "n"])
                    seen = Counter()
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()),
                                              pa.array(seen.values(), pa.int64())], names=["p", "n"])

    return rows.mapInArrow(run, "p string, n bigint").groupBy("p").agg(F.sum("n").alias("n"))


def _sums(rows: DataFrame, g: Grammar, keep: list[str]) -> DataFrame:
    kinds = dict(rows.dtypes)

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                x = np.array([g.sums(t) for t in part.column(len(keep)).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(len(keep))]
                    + [pa.array(x.tolist(), pa.list_(pa.float64())), pa.array(g.score(x))],
                    names=[*keep, "sums", "score"])

    schema = ", ".join(f"{c} {kinds[c]}" for c in keep) + ", sums array<double>, score double"
    return rows.select(*keep, "text").mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="toxic") -> Grammar:
    """Learn the lexicon and the layer from labels of the training fold."""
    ship(docs.sparkSession)
    text_batches(docs.sparkSession)
    y = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y")) \
        .where(F.col("y").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id")) \
        .groupBy("doc_id").agg(F.max("y").alias("y"))
    n = {r["y"]: r["n"] for r in y.groupBy("y").agg(F.count("*").alias("n")).collect()}
    share = {k: int(min(1.0, most / max(1, n.get(k, 0))) * (1 << 20)) for k, most in ((1, FIT_TOXIC), (0, FIT_CLEAN))}
    y = y.where(F.pmod(F.xxhash64(F.lit("tox"), "doc_id"), F.lit(1 << 20))
                < F.when(F.col("y") == 1, share[1]).otherwise(share[0]))
    # at most about FIT_TOXIC + FIT_CLEAN ids: a bounded side to broadcast
    rows = stored(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
                  .join(F.broadcast(y), "doc_id"), "tox-fit")
    single = stored(without_copies(rows), "tox-single")
    toxic, clean = single.where("y = 1").select("text"), single.where("y = 0").select("text")
    n_clean, lexicon = clean.count(), {}
    for level in LEVELS:
        known = Grammar(lexicon) if lexicon else None
        left = toxic.count() if known is None else _uncovered(toxic, known)
        if left < MIN_SUPPORT:
            break
        least = max(MIN_SUPPORT, int(left * MIN_SHARE))
        a = {r["p"]: r["n"] for r in _counts(toxic, known, None).where(F.col("n") >= least).toLocalIterator()}
        b = {r["p"]: r["n"] for r in _counts(clean, None, set(a)).toLocalIterator()}
        lexicon = choose({p: (k, b.get(p, 0)) for p, k in a.items()}, left, n_clean, level, lexicon)
    g = Grammar(lexicon)
    got = _sums(rows, g, ["y"]).select("y", "sums").toPandas()
    if got.y.nunique() == 2:
        g.fit_layer(np.array(got.sums.tolist()), got.y.to_numpy(float))
    return g


def _uncovered(toxic: DataFrame, known: Grammar) -> int:
    def run(batches):
        for b in batches:
            left = sum(not known.any.search((t or "").lower()) for t in b.column(0).to_pylist())
            yield pa.RecordBatch.from_pydict({"n": pa.array([left], pa.int64())})
    return toxic.mapInArrow(run, "n bigint").agg(F.sum("n")).first()[0] or 0


def score(docs: DataFrame, g: Grammar, id_col="doc_id", text_col="text", threshold: float = THRESHOLD) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    ship(docs.sparkSession)
    text_batches(docs.sparkSession)
    rows = _sums(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), g, ["doc_id"])
    return rows.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                       (F.col("score") >= threshold).cast("int").alias("predicted"))


def reject(docs: DataFrame, g: Grammar, text_col="text", threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` that the grammar does not find toxic, columns and values unchanged."""
    ship(docs.sparkSession)
    text_batches(docs.sparkSession)
    at = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                x = np.array([g.sums(t) for t in part.column(at).to_pylist()])
                yield part.filter(pa.array(g.score(x) < threshold))

    return docs.mapInArrow(run, docs.schema)
