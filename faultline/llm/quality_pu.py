"""Quality classifier by positive-unlabelled learning.

Trusted positives are training labels with quality 1; the rest of the
evidence is unlabelled text and an estimated class prior.  The classifier
minimises the non-negative unbiased risk

    prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives))

with the logistic loss; where the second term is negative its gradient is
followed the other way, which keeps a flexible model from overfitting it.
The prior is the smallest ratio, over score thresholds, of the share of
held-back unlabelled text to the share of held-back positives above it.

The border is the risk's own: nothing moves it afterwards.

Inputs of a score are statistics of the text alone (character classes, word
shapes, repetition, lines).  Each is cut at quantiles into bins and every
bin has a weight, so heavy tails and one-sided evils need no scaling.

The classifier is fitted on at most about ``POSITIVE_ROWS`` trusted positives
and ``FIT_ROWS`` unlabelled documents, each drawn by a hash of the id (bounds
on the fit alone; sparse labels all take part); every whole text is scored,
in one pass without a shuffle.

Edge cases: null and empty texts have zero for every statistic and get the
score of those bins; repeated rows are scored alike; null ids are never
labelled; with fewer than two positives the score is 0.5 for all, with a
warning; an empty table
gives an empty result; extra columns are not read."""
from __future__ import annotations

import operator
import warnings
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, ship, stored

FIT_ROWS, POSITIVE_ROWS = 30_000, 20_000
THRESHOLD = 0.3
_PUNCT = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
FEATURES = [
    "log_words", "word_len", "upper", "digit", "space", "wide", "punct", "unique", "adjacent", "top_word",
    "caps_words", "bare_words", "one_char", "dup_lines", "line_words", "pair_repeat", "ends",
] + [f"p{c}" for c in _PUNCT]
_QUANTILES = [0.005, 0.01, 0.02, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.98, 0.99, 0.995]


def features(text: str | None) -> list[float]:
    """Statistics of one whole text; all 0 for an empty one."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    if not raw:
        return [0.0] * len(FEATURES)
    hist = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n = len(raw)
    words = raw.split()
    w = max(1, len(words))
    distinct = Counter(words)
    pairs = len(set(zip(words, words[1:])))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    letters = max(1, int(hist[65:91].sum() + hist[97:123].sum()))
    punct = hist[list(_PUNCT)]
    out = [
        float(np.log1p(len(words))), sum(map(len, words)) / w, hist[65:91].sum() / letters, hist[48:58].sum() / n,
        (hist[9:14].sum() + hist[32]) / n, hist[128:].sum() / n, punct.sum() / n, len(distinct) / w,
        sum(map(operator.eq, words, words[1:])) / w, max(distinct.values(), default=0) / w,
        sum(k for x, k in distinct.items() if x.isupper() and len(x) > 1) / w,
        sum(k for x, k in distinct.items() if not x.isalnum() and x.strip(_PUNCT) == b"") / w,
        sum(k for x, k in distinct.items() if len(x) == 1) / w,
        1 - len(set(lines)) / max(1, len(lines)), len(words) / max(1, len(lines)),
        1 - pairs / max(1, len(words) - 1) if len(words) > 1 else 0.0,
        (hist[33] + hist[46] + hist[63]) / w,
    ]
    return [float(x) for x in out] + (punct / w).tolist()


def _feature_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    ship(docs.sparkSession)
    kind = dict(docs.dtypes)[id_col]

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                x = np.array([features(t) for t in part.column(1).to_pylist()], np.float64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.FixedSizeListArray.from_arrays(x.ravel(), len(FEATURES))
                     .cast(pa.list_(pa.float64()))], names=["doc_id", "x"])

    return docs.select(F.col(id_col).alias("doc_id"), text_col).mapInArrow(run, f"doc_id {kind}, x array<double>")


class PUModel:
    """Bin edges, one weight per bin and the class prior."""

    def __init__(self, edges=None, weights=None, bias=0.0, prior=0.5):
        self.edges, self.weights, self.bias, self.prior = edges or [], weights, bias, prior

    def _bins(self, x):
        at, cols = 0, []
        for j, e in enumerate(self.edges):
            cols.append(np.searchsorted(e, x[:, j]) + at)
            at += len(e) + 1
        return np.stack(cols, 1) if cols else np.zeros((len(x), 0), int)

    def logit(self, bins):
        return self.weights[bins].sum(1) + self.bias if bins.shape[1] else np.full(len(bins), self.bias)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), 0.5)
        return 1 / (1 + np.exp(-np.clip(self.logit(self._bins(x)), -30, 30)))

    def _descend(self, grad, steps, rate=0.05, decay=1e-4):
        """Adam on (weights, bias); ``grad`` gives the gradient by bins for the current logits."""
        p = np.zeros(sum(len(e) + 1 for e in self.edges) + 1)
        m, v = np.zeros_like(p), np.zeros_like(p)
        for t in range(1, steps + 1):
            self.weights, self.bias = p[:-1], p[-1]
            g = grad() + decay * p
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            p = p - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        self.weights, self.bias = p[:-1], p[-1]

    def _spread(self, bins, d):
        """Gradient of sum(d * logit) for the weights and the bias."""
        k = bins.shape[1]
        return np.append(np.bincount(bins.ravel(), np.repeat(d, k), sum(len(e) + 1 for e in self.edges)), d.sum())

    def risk_parts(self, bp, bu, pi):
        """(positive part, negative part) of the unbiased risk, by bins of positives and unlabelled rows."""
        zp, zu = self.logit(bp), self.logit(bu)
        return pi * np.logaddexp(0, -zp).mean(), np.logaddexp(0, zu).mean() - pi * np.logaddexp(0, zp).mean()

    def risk_gradient(self, bp, bu, pi):
        """The risk's gradient; where the negative part is below zero, its own one turned round."""
        sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        zp, zu = self.logit(bp), self.logit(bu)
        g_plus = self._spread(bp, pi * (sig(zp) - 1) / len(bp))
        g_minus = self._spread(bu, sig(zu) / len(bu)) - self._spread(bp, pi * sig(zp) / len(bp))
        return g_plus + g_minus if self.risk_parts(bp, bu, pi)[1] >= 0 else -g_minus

    def fit(self, pos: np.ndarray, unl: np.ndarray, steps: int = 300) -> PUModel:
        both = np.concatenate([pos, unl])
        self.edges = [np.unique(np.quantile(both[:, j], _QUANTILES)) for j in range(both.shape[1])]
        bp, bu = self._bins(pos), self._bins(unl)
        sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        # prior: P against U on the even rows, rated on the odd ones
        a, b, c, d = bp[::2], bu[::2], bp[1::2], bu[1::2]
        self._descend(lambda: self._spread(a, (sig(self.logit(a)) - 1) / len(a))
                      + self._spread(b, sig(self.logit(b)) / len(b)), steps // 3)
        self.prior = estimate_prior(self.logit(c), self.logit(d)) if len(c) and len(d) else 0.5
        pi = self.prior

        self._descend(lambda: self.risk_gradient(bp, bu, pi), steps)
        return self


def estimate_prior(pos: np.ndarray, unl: np.ndarray) -> float:
    """min over thresholds of share(unlabelled above) / share(positives above), with a margin for small shares."""
    cuts = np.unique(np.quantile(pos, np.linspace(0, 0.95, 96)))
    qp = np.array([(pos >= t).mean() for t in cuts])
    qu = np.array([(unl >= t).mean() for t in cuts])
    margin = np.sqrt(np.log(20) / 2) * (1 / np.sqrt(len(pos)) + 1 / np.sqrt(len(unl)))
    best = int(np.argmin((qu + margin) / np.maximum(qp, 1e-9)))
    return float(np.clip(qu[best] / max(qp[best], 1e-9), 0.05, 0.99))


def _drawn(rows: DataFrame, key: str, bound: int, n: int) -> DataFrame:
    """About ``bound`` of ``n`` rows, by a hash of the key; all if they are fewer."""
    if n <= bound:
        return rows
    return rows.where(F.pmod(F.xxhash64(F.lit("pu"), F.col(key)), F.lit(1 << 40)) < int(bound / n * (1 << 40)))


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, positive_rows: int = POSITIVE_ROWS,
        id_col="doc_id", text_col="text", label_col="quality") -> PUModel:
    """Fit on bounded, hash-drawn samples, each with a bound of its own: at most about ``positive_rows`` trusted
    positives of the training fold, however sparse labels are, and ``fit_rows`` unlabelled documents.

    Fewer than two positives: a warning, and a model that scores 0.5 everywhere."""
    y = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("y")).where("y is not null") \
        .groupBy("doc_id").agg(F.max("y").alias("y"))
    y = stored(y, "pu-labels")
    trusted = y.where((F.col("y") == 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    trusted = _drawn(trusted.select("doc_id"), "doc_id", positive_rows, trusted.count())
    ids = docs.withColumn("__id", F.col(id_col))
    # at most about positive_rows ids, so that no text is shuffled
    pos = ids.join(F.broadcast(trusted.select(F.col("doc_id").alias("__id"))), "__id", "left_semi").drop("__id")
    unl = _drawn(docs, id_col, fit_rows, docs.count()).withColumn("__id", F.col(id_col)) \
        .join(y.select(F.col("doc_id").alias("__id")), "__id", "left_anti").drop("__id")
    got = _feature_rows(pos, id_col, text_col).withColumn("y", F.lit(True)) \
        .unionByName(_feature_rows(unl, id_col, text_col).withColumn("y", F.lit(False)))
    t = stored(got.select("y", "x", F.xxhash64("doc_id").alias("h")), "pu-fit").toPandas().sort_values("h", kind="stable")
    pos, unl = (np.array(t.x[t.y == v].tolist(), np.float64).reshape(-1, len(FEATURES)) for v in (True, False))
    if len(pos) < 2:
        warnings.warn(f"{len(pos)} trusted positives among the training labels: no quality model is fitted", stacklevel=2)
        return PUModel()
    return PUModel().fit(pos, unl if len(unl) >= 2 else pos)


def score(docs: DataFrame, model: PUModel, id_col="doc_id", text_col="text", threshold: float = THRESHOLD) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    ship(docs.sparkSession)
    kind = dict(docs.dtypes)[id_col]

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                x = np.array([features(t) for t in part.column(1).to_pylist()], np.float64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(model.score(x))], names=["doc_id", "score"])

    got = docs.select(F.col(id_col).alias("doc_id"), text_col).mapInArrow(run, f"doc_id {kind}, score double")
    return got.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))
