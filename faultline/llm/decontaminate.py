"""Benchmark decontamination with a BM25 inverted index of the test items.

The index holds the test items: for each term the postings of the items that
have it, in item order, with the BM25 impact divided by the item's score
against itself, so an item's own text scores 1 and one threshold serves items
of any length.  Postings are cut into blocks of ``BLOCK`` items; a term knows
its largest impact in every block and overall.  Impacts are whole numbers
(parts of ``UNIT``), so scores and bounds don't depend on any order of
addition.  Document frequencies, mean length and passage length are those of
the whole test set.

Every passage of a training text queries the index.  A text is cut into
chunks as long as the longest item (at least ``CHUNK`` words) and a passage
is two neighbouring chunks, so a copied item lies whole in some passage.
Block-max WAND's tests are made for many passages at once, in arrays:

1. pivot: a passage's terms are ordered by their largest impact; while these
   add up to less than the threshold an item with such terms alone can't
   reach it.  The pivot is put earlier, at ``PIVOT`` of the threshold, which
   makes the later bounds closer; the terms from it on lead.  A passage whose
   terms together stay below the threshold is left.
2. skipping: only blocks in a leading term's list are looked at, and those
   are left whose block maxima (leading terms exactly, the others first by
   their largest impact, then by their block maxima) stay below the threshold.
3. scoring: in the blocks that remain, items in a leading list get their
   leading impacts, and the others are added where that can still suffice.

The bounds are exact: everything at or above the threshold is retrieved.

A retrieved item is verified by n-grams (five words, or the whole part if it
is shorter) of its question and its answer in the passage.  Without an
answer column the last sentence of an item is its answer.  Both overlaps are
reported, and the share of all n-grams of both parts found decides: a copied
question without its answer is a leak if it is at least half of the item.

The test set is the stated query set: it is split by a hash into parts of at
most about ``PART_BYTES`` (measured first), and each part's index, a few
times that, goes to every task.  Each part reads the training rows once;
they are never shuffled, and results do not depend on the number of parts.

Words are lower-cased and ASCII punctuation separates them.  Edge cases:
null or empty texts and items match nothing; a repeated row is reported as
often as it occurs (``contaminated``) or dropped each time (``remove``);
equal items are reported each; without items all rows stay; extra columns
are ignored or passed through."""
from __future__ import annotations

import re
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, stored, text_batches

K1, B = 1.2, 0.75
CHUNK = 64
BLOCK = 8
UNIT = 1 << 30
PIVOT = 0.25
RETRIEVE = 0.4
OVERLAP = 0.5
GRAM = 5
PART_BYTES = 16 << 20
CELLS = 1 << 22

_TABLE = bytes(32 if c < 128 and not chr(c).isalnum() else c for c in range(256))
_SENTENCES = re.compile(r"(?<=[.!?])\s+|\n+")


def tokens(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_TABLE).split()


def parts(text: str | None, answer: str | None, has_answer: bool) -> tuple[str, str]:
    """(question, answer) of an item."""
    if has_answer:
        return text or "", answer or ""
    found = [s for s in _SENTENCES.split((text or "").strip()) if s and tokens(s)]
    return (" ".join(found[:-1]), found[-1]) if len(found) > 1 else (text or "", "")


def grams(ids: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of the n-grams of term numbers; none for grams with an unknown term (-1)."""
    if not n or len(ids) < n:
        return np.zeros(0, np.uint64)
    h = np.full(len(ids) - n + 1, np.uint64(n))
    known = np.ones(len(h), bool)
    for k in range(n):
        part = ids[k:k + len(h)]
        known &= part >= 0
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + (part.astype(np.uint64) + np.uint64(1)) * np.uint64(
            0xC2B2AE3D27D4EB4F)
    h = np.sort((h ^ (h >> np.uint64(32)))[known])
    return h[np.append(True, h[1:] != h[:-1])] if len(h) else h


def _spread(first: np.ndarray, count: np.ndarray):
    """(owner, position): every position first..first+count-1 with the number of its range."""
    owner = np.repeat(np.arange(len(count)), count)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)


def _at(keys: np.ndarray, wanted: np.ndarray):
    """(position, found) of wanted values among sorted keys."""
    pos = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return pos, keys[pos] == wanted


class Index:
    """Postings of one part of the test set.

    ``whole`` has n, mean, chunk and df (by term) of the whole test set;
    without it the items given are the test set."""

    def __init__(self, items: list[tuple], whole: dict | None = None):
        self.terms: dict[bytes, int] = {}
        rows = []
        for item, question, answer in items:
            q, a = ([self.terms.setdefault(w, len(self.terms)) for w in tokens(t)] for t in (question, answer))
            if q or a:
                rows.append((item, np.array(q, np.int64), np.array(a, np.int64)))
        self.items = [r[0] for r in rows]
        lengths = np.array([len(q) + len(a) for _, q, a in rows], float)
        # the n-grams of both parts, one after the other
        sizes = [(min(GRAM, len(q)), min(GRAM, len(a))) for _, q, a in rows]
        found = [grams(x, n) for (_, *qa), both in zip(rows, sizes, strict=True) for x, n in zip(qa, both, strict=True)]
        self.gram_size = np.array(sizes, np.int64).reshape(-1, 2)
        self.gram_at = np.append(0, np.cumsum([len(x) for x in found])).astype(np.int64)
        self.gram = np.concatenate([*found, np.zeros(0, np.uint64)])
        bags = [np.unique(np.concatenate([q, a]), return_counts=True) for _, q, a in rows]
        n = len(rows)
        item = np.repeat(np.arange(n), [len(t) for t, _ in bags])
        term = np.concatenate([*[t for t, _ in bags], np.zeros(0, np.int64)]).astype(np.int64)
        tf = np.concatenate([*[c for _, c in bags], np.zeros(0)])
        if whole is None:
            whole = {"n": n, "mean": lengths.mean() if n else 1.0, "chunk": max([CHUNK, *lengths.astype(int).tolist()]),
                     "df": dict(zip(self.terms, np.bincount(term, minlength=len(self.terms)).tolist(), strict=True))}
        self.chunk = whole["chunk"]
        df = np.array([whole["df"][t] for t in self.terms], float)
        idf = np.log1p((whole["n"] - df + 0.5) / (df + 0.5))
        if not n:
            return
        v = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[item] / whole["mean"]))
        impact = np.rint(v / np.bincount(item, v, n)[item] * UNIT).astype(np.int64)
        order = np.lexsort((item, term))
        term, item, impact = term[order], item[order], impact[order]
        self.n, self.n_blocks = n, -(-n // BLOCK)
        self.post_key, self.post_impact = term * n + item, impact.astype(np.int32)
        self.post_item = item.astype(np.int32)
        block_key = term * self.n_blocks + item // BLOCK
        first = np.flatnonzero(np.append(True, block_key[1:] != block_key[:-1]))
        self.block_key, self.block_first = block_key[first], np.append(first, len(term)).astype(np.int64)
        self.block_max = np.maximum.reduceat(impact, first)
        self.term_first = np.searchsorted(term[first], np.arange(len(self.terms) + 1))  # block lists by term
        self.most = np.maximum.reduceat(impact, np.searchsorted(term, np.arange(len(self.terms))))

    def candidates(self, texts: list[np.ndarray], threshold: float = RETRIEVE):
        """(text, chunk, item, score) arrays: every passage and item at or above the threshold."""
        none = np.zeros(0, np.int64)
        n = np.array([len(t) for t in texts], np.int64)
        if not self.items or not n.sum():
            return none, none, none, none
        chunks = -(-n // self.chunk)
        first = np.append(0, np.cumsum(chunks))
        ids = np.concatenate(texts)
        own, at = _spread(np.zeros(len(n), np.int64), n)
        chunk = first[own] + at // self.chunk
        known = ids >= 0
        ids, chunk, later = ids[known], chunk[known], (at >= self.chunk)[known]
        m = len(self.terms)
        # a chunk belongs to its own passage and to the one before it
        key = np.concatenate([chunk * m + ids, (chunk[later] - 1) * m + ids[later]])
        if not len(key):
            return none, none, none, none
        key.sort()
        key = key[np.append(True, key[1:] != key[:-1])]
        passage, term = key // m, key % m
        least = int(np.ceil(threshold * UNIT))
        found = []
        total = np.bincount(passage, self.most[term], first[-1])
        keep = total[passage] >= least
        passage, term = passage[keep], term[keep]
        opened, passage = np.unique(passage, return_inverse=True)
        step = max(1, CELLS // self.n_blocks)
        ends = np.searchsorted(passage, np.arange(0, len(opened) + step, step))
        for k in range(len(ends) - 1):
            part = slice(ends[k], ends[k + 1])
            if ends[k] < ends[k + 1]:
                p, i, s = self._search(passage[part] - k * step, term[part], least)
                found.append((opened[p + k * step], i, s))
        if not found:
            return none, none, none, none
        p, i, s = (np.concatenate(x) for x in zip(*found, strict=True))
        text = np.searchsorted(first, p, side="right") - 1
        return text, p - first[text], i, s

    def _search(self, passage, term, least):
        """(passage, item, score) for passages numbered from 0 with their distinct terms, in passage order."""
        n_passages = int(passage[-1]) + 1
        order = np.argsort(passage << 31 | self.most[term])  # by passage and largest impact
        passage, term = passage[order], term[order]
        most = self.most[term]
        running = np.cumsum(most)
        start = np.searchsorted(passage, np.arange(n_passages + 1))
        before = np.append(0, running)[start[:-1]]
        lead = running - before[passage] >= least * PIVOT
        rest = np.bincount(passage[~lead], most[~lead], n_passages).astype(np.int64)  # below the threshold
        pivot = start[:-1] + np.bincount(passage[~lead], minlength=n_passages)
        # blocks in the leading lists
        lp, lt = passage[lead], term[lead]
        own, pos = _spread(self.term_first[lt], self.term_first[lt + 1] - self.term_first[lt])
        block = self.block_key[pos] - lt[own] * self.n_blocks
        bound = np.bincount(lp[own] * self.n_blocks + block, self.block_max[pos], n_passages * self.n_blocks).astype(np.int64)
        cell = np.flatnonzero(bound)
        p, block = cell // self.n_blocks, cell % self.n_blocks
        keep = bound[cell] + rest[p] >= least
        cell, p, block = cell[keep], p[keep], block[keep]
        # the other terms' block maxima
        own, pos = _spread(start[p], pivot[p] - start[p])
        hit, ok = _at(self.block_key, term[pos] * self.n_blocks + block[own])
        more = np.bincount(own, np.where(ok, self.block_max[hit], 0), len(p)).astype(np.int64)
        keep = bound[cell] + more >= least
        p, block = p[keep], block[keep]
        # items of those blocks in the leading lists
        own, pos = _spread(pivot[p], start[p + 1] - pivot[p])
        hit, ok = _at(self.block_key, term[pos] * self.n_blocks + block[own])
        own, hit = own[ok], hit[ok]
        sub, at = _spread(self.block_first[hit], self.block_first[hit + 1] - self.block_first[hit])
        slot = own[sub] * BLOCK + self.post_item[at] % BLOCK
        score = np.bincount(slot, self.post_impact[at], len(p) * BLOCK).astype(np.int64)
        slot = np.flatnonzero((score > 0) & (score + np.repeat(rest[p], BLOCK) >= least))
        q, item, score = p[slot // BLOCK], block[slot // BLOCK] * BLOCK + slot % BLOCK, score[slot]
        own, pos = _spread(start[q], pivot[q] - start[q])
        hit, ok = _at(self.post_key, term[pos] * self.n + item[own])
        score = score + np.bincount(own, np.where(ok, self.post_impact[hit], 0), len(q)).astype(np.int64)
        keep = score >= least
        return q[keep], item[keep], score[keep]

    def matches(self, texts: list[str | None]):
        """(text, item id, score, question overlap, answer overlap, overlap) of verified items, best passage each."""
        get = self.terms.get
        ids = []
        for t in texts:
            found = tokens(t)
            ids.append(np.fromiter(map(get, found, repeat(-1)), np.int64, len(found)))
        best: dict[tuple[int, int], tuple] = {}
        held, have = None, {}
        for x, c, i, score in zip(*(v.tolist() for v in self.candidates(ids)), strict=True):
            if held != (x, c):
                held, have = (x, c), {}
            counts, shared = [], []
            for k in (0, 1):
                size = int(self.gram_size[i, k])
                if size not in have:
                    have[size] = grams(ids[x][c * self.chunk:(c + 2) * self.chunk], size)
                own = self.gram[self.gram_at[2 * i + k]:self.gram_at[2 * i + k + 1]]
                counts.append(len(own))
                shared.append(int(np.isin(own, have[size], assume_unique=True).sum()) if len(own) else 0)
            total = sum(shared) / sum(counts)
            if total >= OVERLAP and ((x, i) not in best or total > best[x, i][3]):
                best[x, i] = (score / UNIT, *[s / n if n else 1.0 for s, n in zip(shared, counts, strict=True)], total)
        return [(x, self.items[i], *row) for (x, i), row in sorted(best.items())]


def _whole(items: DataFrame, has_answer: bool):
    """(n, words, longest, df table (term, df)) of the whole test set."""
    def run(batches):
        for b in batches:
            term, rows = [], []
            for t, a in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                both = [tokens(x) for x in parts(t, a, has_answer)]
                if any(both):
                    rows.append(len(both[0]) + len(both[1]))
                    term += {*both[0], *both[1]}
            yield pa.RecordBatch.from_arrays(
                [pa.array([None] * len(rows) + term, pa.binary()), pa.array(rows + [None] * len(term), pa.int64())],
                names=["term", "size"])

    said = stored(items.mapInArrow(run, "term binary, size bigint"), "test-terms")
    r = said.agg(F.count("size").alias("n"), F.sum("size").alias("words"), F.max("size").alias("longest")).first()
    return r["n"], r["words"], r["longest"], said.where("term is not null").groupBy("term").agg(F.count("*").alias("df"))


def _indexes(benchmark: DataFrame, item_col, text_col, answer_col, part_bytes: int = PART_BYTES):
    """One index per bounded part of the test set, all by the statistics of the whole."""
    has_answer = answer_col is not None
    cols = [F.col(item_col).alias("i"), F.col(text_col).alias("t"),
            (F.col(answer_col) if answer_col else F.lit(None)).cast("string").alias("a")]
    items = benchmark.select(*cols).where(F.col("t").isNotNull())
    size = items.agg(F.sum(F.octet_length("t") + F.coalesce(F.octet_length("a"), F.lit(0)))).first()[0] or 0
    n_items, n_words, longest, df = _whole(items, has_answer)
    n = max(1, -(-size // part_bytes))
    df = stored(df, "test-df") if n > 1 else df
    for k in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k)
        rows = [(r["i"], *parts(r["t"], r["a"], has_answer))
                for r in sorted(part.collect(), key=lambda r: (r["i"] is None, r["i"], r["t"], r["a"] or ""))]
        mine = {w for _, q, a in rows for t in (q, a) for w in tokens(t)}  # at most the part's words
        ask = df if n == 1 else df.join(items.sparkSession.createDataFrame([(bytearray(w),) for w in mine], "term binary"), "term")
        yield Index(rows, {"n": n_items, "mean": n_words / n_items if n_items else 1.0, "chunk": max(CHUNK, longest or 0),
                           "df": {bytes(r["term"]): r["df"] for r in ask.collect()}})


SMALL = 512
MATCH = "score double, question_overlap double, answer_overlap double, overlap double"


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col="doc_id", text_col="text", item_col="item_id",
                 item_text_col="text", answer_col: str | None = None, part_bytes: int = PART_BYTES) -> DataFrame:
    """One row per document and leaked item: ids, score, question_overlap, answer_overlap, overlap."""
    ship(docs.sparkSession)
    text_batches(docs.sparkSession)
    sc = docs.sparkSession.sparkContext
    item_type = dict(benchmark.dtypes)[item_col]
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = f"doc_id {dict(docs.dtypes)[id_col]}, item_id {item_type}, {MATCH}"

    def search(shared):
        def run(batches):
            index = shared.value
            for b in batches:
                for lo in range(0, b.num_rows, SMALL):
                    part = b.slice(lo, SMALL)
                    got = index.matches(part.column(1).to_pylist())
                    if got:
                        at = pa.array([g[0] for g in got], pa.int64())
                        rest = list(zip(*[g[1:] for g in got], strict=True))
                        yield pa.RecordBatch.from_arrays(
                            [part.column(0).take(at), pa.array(rest[0]), *[pa.array(c, pa.float64()) for c in rest[1:]]],
                            names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap", "overlap"])
        return run

    found = [src.mapInArrow(search(sc.broadcast(index)), schema)
             for index in _indexes(benchmark, item_col, item_text_col, answer_col, part_bytes)]
    return reduce(DataFrame.union, found)


def remove(docs: DataFrame, benchmark: DataFrame, text_col="text", item_col="item_id", item_text_col="text",
           answer_col: str | None = None) -> DataFrame:
    """Rows of ``docs`` without a leaked item, columns and values unchanged."""
    ship(docs.sparkSession)
    text_batches(docs.sparkSession)
    sc, at = docs.sparkSession.sparkContext, docs.columns.index(text_col)

    def keep(shared):
        def run(batches):
            for b in batches:
                for lo in range(0, b.num_rows, SMALL):
                    part = b.slice(lo, SMALL)
                    bad = {m[0] for m in shared.value.matches(part.column(at).to_pylist())}
                    yield part.filter(pa.array([i not in bad for i in range(part.num_rows)], pa.bool_()))
        return run

    for index in _indexes(benchmark, item_col, item_text_col, answer_col):
        docs = docs.mapInArrow(keep(sc.broadcast(index)), docs.schema)
    return docs
