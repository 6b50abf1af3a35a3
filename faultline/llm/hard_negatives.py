"""Hard negatives by Kronecker-packed integer products.

Components become integers floor(``SCALE`` x).  For the products with one
block of anchors, both sides are biased to be non-negative and the biased
components of several candidates are laid side by side as separate bit
fields of one wide integer, wide enough for the whole inner product.  One
multiplication by an anchor's component then serves all candidates of the
word, the words are added up over the components, and the fields are the
exact biased scores, from which the biases' known share is taken away.  A
machine word holds two or more candidates for components of usual size;
larger ones get one field a word, or integers of any width.

The anchors are a stated query set: they are scored against all rows in
blocks of at most ``ANCHORS`` (bounded, so one block is collected and
broadcast), and each block scans the candidates twice where they lie, without
moving them: once for every anchor's first positives, once for the negatives
within each positive's band.  A task keeps its best ``POSITIVES`` (or
``NEGATIVES``) for each anchor while it reads, so a few rows an anchor and
task are shuffled, whatever the labels' sizes.

Edge cases: rows with a null id, label or vector or any null or non-finite
component take no part; vectors of unlike length are filled up with zeros; an
empty vector scores 0; scores outside 64 bits count as the nearest 64-bit
integer; rows with the anchor's own id are not its others; a repeated row is
as many candidates, but one anchor; ties go by the smaller id; empty tables
give no rows; extra columns are ignored."""
from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, stored

SCALE = 256
ANCHORS = 16_384
CANDIDATES = 4_096
POSITIVES, NEGATIVES = 5, 5
LOW, HIGH = 80, 100
CELLS = 1 << 21
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def whole_numbers(vectors: list, width: int = 0):
    """Matrix of integers floor(SCALE x), filled up with zeros: int64, or Python integers where those don't fit."""
    width = max([width, *map(len, vectors)]) if vectors else width
    m = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        m[i, :len(v)] = v
    m = np.floor(m * SCALE)
    if m.size and np.abs(m).max() >= 2.0 ** 62:
        return np.array([[int(x) for x in r] for r in m.tolist()], dtype=object).reshape(m.shape)
    return m.astype(np.int64)


class Packed:
    """Candidates laid into bit fields of words; ``scores(anchors)`` are exact inner products."""

    def __init__(self, c: np.ndarray, anchor_bias: int, anchor_most: int):
        n, dims = c.shape
        self.n, self.dims, self.anchor_bias = n, dims, anchor_bias
        self.bias = max(0, -int(c.min())) if c.size else 0
        most = (int(c.max()) + self.bias) if c.size else 0
        self.bits = max(1, (max(1, dims) * max(1, most) * max(1, anchor_most)).bit_length())
        wide = self.bits > 64
        self.fields = 8 if wide else 64 // self.bits
        kind = object if wide else np.uint64
        biased = np.zeros((-(-n // self.fields) * self.fields, dims), dtype=kind)
        biased[:n] = (c.astype(object) if wide else c) + self.bias
        self.total = c.astype(object).sum(1) if wide or c.dtype == object else c.sum(1)
        parts = biased.reshape(-1, self.fields, dims)
        shift = [1 << (self.bits * f) if wide else np.uint64(1 << (self.bits * f)) for f in range(self.fields)]
        self.words = reduce(np.add, [parts[:, f] * shift[f] for f in range(self.fields)]).T.copy()  # dims x words

    def scores(self, a: np.ndarray) -> np.ndarray:
        """anchors x candidates; int64, beyond it clipped."""
        wide = self.words.dtype == object
        up = a.astype(object) + self.anchor_bias if wide else (a + self.anchor_bias).astype(np.uint64)
        acc = up @ self.words if self.dims else np.zeros((len(a), self.words.shape[1]), self.words.dtype)
        out = np.empty((len(a), self.words.shape[1], self.fields), object if wide else np.int64)
        mask = (1 << self.bits) - 1
        for f in range(self.fields):
            part = acc >> (self.bits * f if wide else np.uint64(self.bits * f))
            out[:, :, f] = part & (mask if wide else np.uint64(mask))
        out = out.reshape(len(a), -1)[:, :self.n]
        own = a.astype(object).sum(1) if wide else a.sum(1)
        out = out - (self.anchor_bias * self.total[None, :] + self.bias * own[:, None]
                     + self.dims * self.anchor_bias * self.bias)
        if out.dtype == object:
            return np.clip(out, _LEAST, _MOST).astype(np.int64)
        return out


class Best:
    """The best ``k`` (score, id) of each of ``n`` queries: highest scores first, ties by the smaller id."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score, self.id = np.full((n, k), _LEAST), np.zeros((n, k), np.int64)
        self.some = np.zeros((n, k), bool)

    def add(self, lo: int, score: np.ndarray, ok: np.ndarray, ids: np.ndarray):
        """Queries from ``lo``, candidates with ascending ``ids``."""
        k, m = self.k, score.shape[1]
        hi = lo + len(score)
        full = self.some[lo:hi, -1]
        ok = ok & (~full[:, None] | (score >= self.score[lo:hi, -1:]))
        rows = np.flatnonzero(ok.any(1))
        if not len(rows):
            return
        score, ok = score[rows], ok[rows]
        s = np.concatenate([self.score[lo + rows], np.where(ok, score, _LEAST)], 1)
        have = np.concatenate([self.some[lo + rows], ok], 1)
        i = np.concatenate([self.id[lo + rows], np.broadcast_to(ids, score.shape)], 1)
        if m + k > 4 * k:  # what is below the k-th score can't count
            cut = np.partition(s, -k, axis=1)[:, -k]
            have &= s >= cut[:, None]
        r, c = np.nonzero(have)
        at = np.lexsort((i[r, c], ~s[r, c], r))  # ~s falls as s grows, without overflow
        r, c = r[at], c[at]
        first = np.searchsorted(r, np.arange(len(rows)))
        rank = np.arange(len(r)) - first[r]
        top = rank < k
        r, c, rank = r[top], c[top], rank[top]
        to = lo + rows[r]
        self.some[lo + rows] = False
        self.score[to, rank], self.id[to, rank], self.some[to, rank] = s[r, c], i[r, c], True

    def rows(self):
        q, j = np.nonzero(self.some)
        return q, self.id[q, j], self.score[q, j]


def _clean(rows: DataFrame, id_col, vec_col, label_col, flip: int, classes: int) -> DataFrame:
    """(id, label, vec) of the rows that take part; labels of ids divisible by ``flip`` are shifted."""
    x, label = F.col(id_col).cast("bigint"), F.col(label_col).cast("bigint")
    if flip:
        label = F.when(x % flip == 0, (label + 1) % classes).otherwise(label)
    vec = F.col(vec_col).cast("array<double>")
    odd = F.exists(vec, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return rows.select(x.alias("id"), label.alias("label"), vec.alias("vec")) \
        .where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull() & ~odd)


def _scan(shared, n_queries: int, keep: int, choose):
    """An Arrow map: the best candidates of each query in a task; ``choose(block, score, ids, labels)``
    yields (first query, scores, mask) of some anchors."""
    def run(batches):
        block = shared.value
        a, bias = block["a"], block["bias"]
        best = Best(n_queries, keep)
        for b in batches:
            for lo in range(0, b.num_rows, CANDIDATES):
                part = b.slice(lo, CANDIDATES)
                ids = part.column(0).to_numpy(zero_copy_only=False)
                order = np.argsort(ids, kind="stable")
                ids, labels = ids[order], part.column(1).to_numpy(zero_copy_only=False)[order]
                vec = part.column(2)
                c = whole_numbers([vec[int(i)].values.to_numpy(zero_copy_only=False) for i in order], a.shape[1])
                wide = np.zeros((len(a), c.shape[1]), a.dtype)  # a candidate may be longer than any anchor
                wide[:, :a.shape[1]] = a
                packed = Packed(c, bias, block["most"])
                step = max(1, CELLS // max(1, len(ids)))
                for x in range(0, len(a), step):
                    score = packed.scores(wide[x:x + step])
                    other = ids[None, :] != block["id"][x:x + step, None]
                    same = labels[None, :] == block["label"][x:x + step, None]
                    for q, s, ok in choose(block, x, score, other, same):
                        best.add(q, s, ok, ids)
        q, i, s = best.rows()
        for lo in range(0, len(q), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(v[lo:lo + 50_000], pa.int64()) for v in (q, i, s)],
                                             names=["q", "id", "score"])
    return run


def _positives(block, x, score, other, same):
    yield x, score, other & same


def _negatives(block, x, score, other, same):
    """Queries are anchors x positives, positive by positive."""
    n = len(block["a"])
    for p in range(block["top"].shape[1]):
        top, low = (block[k][x:x + len(score), p, None] for k in ("top", "low"))
        yield p * n + x, score, ~same & (score <= top) & (score >= low) & block["has"][x:x + len(score), p, None]


def _first(found: DataFrame, keep: int) -> DataFrame:
    w = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= keep)


def _anchor_blocks(rows: DataFrame, every: int, size: int):
    """Bounded blocks of anchors, collected one after the other."""
    anchors = stored(rows.where(F.col("id") % every == 0).dropDuplicates(["id", "label", "vec"]), "anchors")
    n = max(1, -(-anchors.count() // size)) if size else 1
    for k in range(n):
        part = anchors if n == 1 else anchors.where(F.pmod(F.xxhash64("id", "vec"), F.lit(n)) == k)
        got = sorted(part.collect(), key=lambda r: (r["id"], r["label"], r["vec"]))
        if got:
            a = whole_numbers([r["vec"] for r in got])
            bias = max(0, -int(a.min())) if a.size else 0
            yield {"id": np.array([r["id"] for r in got]), "label": np.array([r["label"] for r in got]), "a": a,
                   "bias": bias, "most": int(a.max()) + bias if a.size else 0}


def mine(rows: DataFrame, id_col="vec_id", vec_col="embedding", label_col="label", every: int = 100, flip: int = 7,
         classes: int = 10, block: int = ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each anchor (id divisible
    by ``every``) and each of its first positives, the first rows of other labels whose score is at most the
    positive's and at least ``LOW`` of ``HIGH`` parts of it."""
    spark = rows.sparkSession
    ship(spark)
    sc = spark.sparkContext
    rows = _clean(rows, id_col, vec_col, label_col, flip, classes)
    schema = "q bigint, id bigint, score bigint"
    out = None
    for b in _anchor_blocks(rows, every, block):
        n = len(b["id"])
        scan = _scan(sc.broadcast(b), n, POSITIVES, _positives)
        got = _first(rows.mapInArrow(scan, schema), POSITIVES).collect()  # at most POSITIVES an anchor
        top, pos = np.zeros((n, POSITIVES), np.int64), np.zeros((n, POSITIVES), np.int64)
        has = np.zeros((n, POSITIVES), bool)
        for r in got:
            at = r["q"], r["rank"] - 1
            top[at], pos[at], has[at] = r["score"], r["id"], True
        # LOW p <= HIGH s, for whole numbers: s >= p - floor((HIGH - LOW) p / HIGH)
        low = np.array([int(p) - (HIGH - LOW) * int(p) // HIGH for p in top.ravel()], object).clip(_LEAST, _MOST)
        b |= {"top": top, "low": low.astype(np.int64).reshape(top.shape), "has": has}
        scan = _scan(sc.broadcast(b), n * POSITIVES, NEGATIVES, _negatives)
        names = spark.createDataFrame(
            [(int(p * n + i), int(b["id"][i]), int(pos[i, p]), int(top[i, p])) for i, p in zip(*np.nonzero(has), strict=True)],
            "q bigint, anchor_id bigint, positive_id bigint, positive_score bigint")
        found = _first(rows.mapInArrow(scan, schema), NEGATIVES).join(F.broadcast(names), "q").select(
            "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score"))
        out = found if out is None else out.union(found)
    if out is None:
        return spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, "
                                         "positive_score bigint, negative_score bigint")
    return out
