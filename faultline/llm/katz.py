"""Katz backoff language model: Good-Turing discounted bigrams over words.

p(w | b) is d_c c(b w) / c(b) for a word pair of the training texts and
alpha(b) p(w) else; p(w) is d_c c(w) / N for a training word and the mass that
the discounts leave for any other word, one class, as in the contract's base.
alpha(b) is the mass left at b divided by the unigram mass of the words not
seen after b, so every context's distribution sums to one exactly.  A text is
its words, lower-cased A-Z, and one end; the start is a context only.

Discounts are Good-Turing's up to count ``CUT`` in Katz's form.  Where counts
of counts give none between 0 and 1 the level takes absolute discounting
instead, and a level or context without any discounted count keeps one more
occurrence for what it has not seen.

Tables (``fit``), all in the shared folder:

- ``words``: word hash and count;
- ``pairs``: one row per bucket of contexts with its pairs sorted, in three
  compressed columns (differences of the context codes, word codes, counts);
- ``contexts``: per context log10 of its total and of its backoff weight.

A word's code is its rank if it is among the frequent words (at most
``FREQUENT``, a bounded broadcast), else its negated 63-bit hash.  A bucket is
a hash of the context; a context with more than its share of tokens is dealt
over several buckets by its successors, so no bucket grows with a hot word.

``score`` reads each text once: pairs among the ``FREQUENT`` most frequent
are looked up at once, the others travel, grouped by chunk of texts and
bucket, to their bucket of the tables, where unseen pairs fall back to the
context's weight and the word; rare words meet their counts in a join.  What
returns is a sum per text and bucket.  Nothing else is broadcast and no
table or text passes the driver.

Edge cases: null or empty texts are the end alone; a null id is training;
equal texts score equally and are scored once a chunk; without training
texts every token is unknown with probability 1; words are told apart by
64-bit hashes; rows without any text columns in common with the result are
ignored, extra columns too."""
from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, stored

START, END, FIRST = 0, 1, 2
CUT = 5
FREQUENT = 1 << 19
FREQUENT_PAIRS = 1 << 18
CHUNK_TOKENS, CHUNK_TEXTS = 1_000_000, 60_000
BUCKET_TOKENS = 1_500_000
LEAST_BUCKETS = 40
_SHIFT = 21  # codes of frequent words take fewer bits


def held_out(doc_id) -> F.Column:
    """crc32(doc_id as text) mod 5 = 1; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 1, F.lit(False))


def discounts(n: list[int]) -> list[float]:
    """Factors d_1..d_CUT from the numbers n_1..n_(CUT+1) of types with each count."""
    if min(n) > 0:
        a = (CUT + 1) * n[CUT] / n[0]
        if a < 1:
            d = [((r + 1) * n[r] / (r * n[r - 1]) - a) / (1 - a) for r in range(1, CUT + 1)]
            if all(0 < x < 1 for x in d):
                return d
    off = n[0] / (n[0] + 2 * n[1]) if n[0] and n[1] else 0.5
    return [(r - off) / r for r in range(1, CUT + 1)]


# ---- words and codes -------------------------------------------------------

class _Numbers(dict):
    """word -> number in order of appearance."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def codes_of(vocabulary, hashes: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Codes of words: ranks of the frequent ones (by their sorted hashes), negated hashes of the others."""
    h = np.fromiter(map(xxhash.xxh64_intdigest, vocabulary), np.uint64, len(vocabulary))
    h = (h >> np.uint64(1)).astype(np.int64)
    if not len(hashes):
        return -h - 1
    at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
    return np.where(hashes[at] == h, ranks[at].astype(np.int64), -h - 1)


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def squeeze(a: np.ndarray) -> bytes:
    """Bytes of an array, compressed; integers that rise by their differences, plane by plane of bytes."""
    planes = np.frombuffer(np.ascontiguousarray(a).tobytes(), np.uint8).reshape(len(a), a.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unsqueeze(b: bytes, kind) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8)
    size = np.dtype(kind).itemsize
    return np.frombuffer(np.ascontiguousarray(raw.reshape(size, -1).T).tobytes(), kind)


def rising(a):
    return squeeze(np.diff(a, prepend=np.int64(0)))


def unrising(b):
    return np.cumsum(unsqueeze(b, np.int64))


def _mixed(x):
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bucket_of(b: np.ndarray, w: np.ndarray, salts: np.ndarray, n: int) -> np.ndarray:
    """Bucket of each pair; ``salts`` has the number of buckets of each frequent context."""
    s = np.where(b >= 0, salts[np.maximum(b, 0)], 1).astype(np.uint64)
    return bucket_at(b, _mixed(w.view(np.uint64)) % s, n)


def bucket_at(b, salt, n):
    return (_mixed(_mixed(b.view(np.uint64) + np.uint64(1)) + salt.astype(np.uint64)) % np.uint64(n)).astype(np.int64)


class Keys:
    """Pairs of codes as one sortable integer each: frequent codes stand for
    themselves, the rare ones at hand are numbered behind them in the order
    of their unsigned codes.  So keys sort like (b, w) taken as unsigned."""

    def __init__(self, *codes: np.ndarray):
        every = np.concatenate(codes)
        self.rare = np.unique(every[every < 0])
        most = max(int(every.max(initial=0)) + 1, FIRST)
        self.base = most
        self.width = (most + len(self.rare)).bit_length()

    def local(self, c: np.ndarray) -> np.ndarray:
        out = c.copy()
        i = np.flatnonzero(c < 0)
        out[i] = self.base + np.searchsorted(self.rare, c[i])
        return out

    def pack(self, b: np.ndarray, w: np.ndarray) -> np.ndarray:
        return self.local(b) << self.width | self.local(w)

    def _code(self, x):
        far = x >= self.base
        out = x.copy()
        out[far] = self.rare[x[far] - self.base]
        return out

    def unpack(self, key: np.ndarray):
        return self._code(key >> self.width), self._code(key & ((1 << self.width) - 1))


def _starts(key: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)


def counted(b: np.ndarray, w: np.ndarray, c: np.ndarray):
    """Distinct pairs of codes in order with the sums of their counts."""
    keys = Keys(b, w)
    key = keys.pack(b, w)
    order = np.argsort(key)
    key = key[order]
    at = _starts(key)
    return *keys.unpack(key[at]), np.add.reduceat(c[order], at)


def _chunks(batches, tokens: int = CHUNK_TOKENS):
    """Lists of rows (text, ...): texts of about ``tokens`` tokens together, or one text."""
    rows, size = [], 0
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for row in zip(*columns, strict=True):
            n = len(row[0] or "") // 6 + 1
            if rows and (size + n > tokens or len(rows) >= CHUNK_TEXTS):
                yield rows
                rows, size = [], 0
            rows.append(row)
            size += n
    if rows:
        yield rows


@dataclass
class Pairs:
    """The pairs of some texts: ``codes`` of the words at hand, in unsigned order, and per token the numbers of
    context and word in it and of its text."""
    codes: np.ndarray
    b: np.ndarray
    w: np.ndarray
    text: np.ndarray
    n_texts: int

    @property
    def width(self) -> int:
        return len(self.codes).bit_length()

    def _unpacked(self, key):
        return key >> self.width, key & ((1 << self.width) - 1)

    def counted(self):
        """(b, w, count): the numbers of distinct pairs, in order."""
        key = self.b << self.width | self.w
        key.sort()
        at = _starts(key)
        return *self._unpacked(key[at]), np.diff(np.append(at, len(key)))

    def grouped(self):
        """(b, w, starts, texts): distinct pairs in order, where each starts, and the text of every occurrence."""
        bits = max(0, self.n_texts - 1).bit_length()
        key = self.b << self.width | self.w
        if 2 * self.width + bits <= 63:
            key = key << bits | self.text
            key.sort()
            text, key = key & ((1 << bits) - 1), key >> bits
        else:
            order = np.argsort(key, kind="stable")
            text, key = self.text[order], key[order]
        at = _starts(key)
        return *self._unpacked(key[at]), at, text


def _read(texts: list[str], m: dict) -> Pairs:
    numbers, w, lengths = _Numbers(), [], np.empty(len(texts), np.int64)
    end = np.array([-1], np.int64)
    for i, t in enumerate(texts):
        found = words(t)
        lengths[i] = len(found) + 1
        w += [np.fromiter(map(numbers.__getitem__, found), np.int64, len(found)), end]
    codes = np.append(codes_of(numbers, m["hashes"], m["ranks"]), [START, END])
    order = np.argsort(codes.view(np.uint64))
    rank = np.empty(len(codes), np.int64)
    rank[order] = np.arange(len(codes))
    w = rank[np.concatenate(w)]  # -1 is the end, the last one
    b = np.empty_like(w)
    b[1:] = w[:-1]
    b[np.append(0, np.cumsum(lengths)[:-1])] = rank[-2]
    return Pairs(codes[order], b, w, np.repeat(np.arange(len(texts), dtype=np.int64), lengths), len(texts))


# ---- the model --------------------------------------------------------------

@dataclass
class Model:
    """Stored tables, and the small parameters that every task gets."""
    words: DataFrame      # h, c
    pairs: DataFrame      # bucket, b, w, c (compressed)
    contexts: DataFrame   # b, total, back (log10)
    shared: dict
    train_tokens: int


def unigrams(m: dict) -> np.ndarray:
    """Discounted probability of each frequent word, by code (the end is unknown without training texts)."""
    c = m["counts"]
    p = np.where(c <= CUT, np.array([0.0, *m["d1"]])[np.minimum(c, CUT)], 1.0) * c / max(m["n1"], 1)
    return np.where(c == 0, m["unknown"], p)


def salts(m: dict) -> np.ndarray:
    """Number of buckets of each frequent context, by code: twice its share of tokens in buckets."""
    return np.maximum(1, -(-2 * m["counts"] * m["buckets"] // max(m["n"], 1))).astype(np.int64)


def _word_counts(train: DataFrame) -> DataFrame:
    def run(batches):
        for rows in _chunks(batches):
            found = Counter()
            for r in rows:
                found.update(words(r[0]))
            h = np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found)) >> np.uint64(1)
            h = np.append(h.astype(np.int64), -END)
            c = np.append(np.fromiter(found.values(), np.int64, len(found)), len(rows))
            for lo in range(0, len(h), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(h[lo:lo + 100_000]), pa.array(c[lo:lo + 100_000])],
                                                 names=["h", "c"])
    return train.mapInArrow(run, "h bigint, c bigint").groupBy("h").agg(F.sum("c").alias("c"))


def _least_count(counts: DataFrame, most: int) -> int:
    """The least count that at most ``most`` rows (c, n) reach, by a histogram of at most some hundred bins."""
    # counts up to 64 by themselves, then an eighth of a doubling a bin
    bin_ = F.when(F.col("c") <= 64, F.col("c")).otherwise(64 + F.floor((F.log2("c") - 6) * 8)).cast("int")
    got = counts.groupBy(bin_.alias("bin")).agg(F.sum("n").alias("n"), F.min("c").alias("least"), F.max("c").alias("most"))
    total, cut = 0, None
    for r in sorted(got.collect(), key=lambda r: -r["bin"]):
        total += r["n"]
        if total > most:
            break
        cut = r["least"]
    return cut if cut is not None else 1 << 62


def _top_words(table: DataFrame, most: int):
    """Frequent words: sorted hashes, their codes, and counts by code (END's too)."""
    cut = _least_count(table.select("c", F.lit(1).alias("n")).where(f"h <> {-END}"), most)
    top = table.where((F.col("c") >= cut) & (F.col("h") != -END)).toPandas()
    h, c = top["h"].to_numpy(np.int64), top["c"].to_numpy(np.int64)
    order = np.lexsort((h, -c))
    h, c = h[order], c[order]
    by_hash = np.argsort(h)
    return h[by_hash], (by_hash + FIRST).astype(np.int32), np.concatenate([[0, 0], c]).astype(np.int64)


def _pair_blobs(train: DataFrame, shared) -> DataFrame:
    """(bucket, b, w, c): pairs of each chunk with their counts."""
    def run(batches):
        m = shared.value
        for rows in _chunks(batches, m["chunk"]):
            pairs = _read([r[0] for r in rows], m)
            b, w, c = pairs.counted()
            b, w = pairs.codes[b], pairs.codes[w]
            k = bucket_of(b, w, salts(m), m["buckets"])
            yield from _dealt(k, m["buckets"], lambda i, b=b, w=w, c=c: (rising(b[i]), squeeze(w[i]),
                                                                          squeeze(c[i].astype(np.uint32))), ["b", "w", "c"])
    return train.mapInArrow(run, "bucket int, b binary, w binary, c binary")


def _dealt(bucket: np.ndarray, n: int, columns, names):
    """Record batches with one row per bucket; ``columns(positions)`` gives its values."""
    bucket = bucket.astype(np.uint16 if n <= 1 << 16 else np.int64)  # a short key sorts by radix
    order = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(n + 1))
    rows = [(k, *columns(order[ends[k]:ends[k + 1]])) for k in range(n) if ends[k] < ends[k + 1]]
    for lo in range(0, len(rows), 64):
        part = list(zip(*rows[lo:lo + 64], strict=True))
        yield pa.RecordBatch.from_arrays(
            [pa.array(part[0], pa.int32()), *[pa.array(p, pa.binary()) for p in part[1:]]], names=["bucket", *names])


def _merged(table: pa.Table) -> pa.Table:
    """Pairs of one bucket, counts of all chunks added up."""
    get = lambda name, f: np.concatenate([f(x.as_py()) for x in table.column(name)])
    b, w = get("b", unrising), get("w", lambda x: unsqueeze(x, np.int64))
    c = get("c", lambda x: unsqueeze(x, np.uint32)).astype(np.int64)
    b, w, c = counted(b, w, c)
    return pa.table({"bucket": pa.array([table.column("bucket")[0].as_py()], pa.int32()), "b": [rising(b)],
                     "w": [squeeze(w)], "c": [squeeze(c)]})


def _read_pairs(batch: pa.RecordBatch):
    for b, w, c in zip(*[batch.column(n).to_pylist() for n in "bwc"], strict=True):
        yield unrising(b), unsqueeze(w, np.int64), unsqueeze(c, np.int64)


_SEEN = [f"m{r}" for r in range(1, CUT + 2)]


def _context_parts(pairs: DataFrame, shared) -> DataFrame:
    """(b, c, m1.., s): totals, types by count and frequent successors' unigram mass, per context and bucket."""
    def run(batches):
        p1 = unigrams(shared.value)
        for batch in batches:
            for b, w, c in _read_pairs(batch):
                at = np.flatnonzero(np.append(True, b[1:] != b[:-1]))
                mass = np.where(w >= 0, p1[np.maximum(w, 0)], 0.0)
                cols = [b[at], np.add.reduceat(c, at), *[np.add.reduceat((c == r).astype(np.int64), at)
                                                         for r in range(1, CUT + 2)], np.add.reduceat(mass, at)]
                for lo in range(0, len(at), 50_000):
                    yield pa.RecordBatch.from_arrays([pa.array(x[lo:lo + 50_000]) for x in cols],
                                                     names=["b", "c", *_SEEN, "s"])
    return pairs.mapInArrow(run, "b bigint, c bigint, " + ", ".join(f"{m} bigint" for m in _SEEN) + ", s double")


def _rare_after(pairs: DataFrame) -> DataFrame:
    """(b, h): pairs whose second word is a rare one, by its hash."""
    def run(batches):
        for batch in batches:
            for b, w, _ in _read_pairs(batch):
                i = np.flatnonzero(w < 0)
                for lo in range(0, len(i), 50_000):
                    j = i[lo:lo + 50_000]
                    yield pa.RecordBatch.from_arrays([pa.array(b[j]), pa.array(-(w[j] + 1))], names=["b", "h"])
    return pairs.mapInArrow(run, "b bigint, h bigint")


def _pair_sizes(pairs: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            for _, _, c in _read_pairs(batch):
                c, n = np.unique(c, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(c), pa.array(n)], names=["c", "n"])
    return pairs.mapInArrow(run, "c bigint, n bigint")


def _top_pairs(pairs: DataFrame, cut: int):
    """Frequent pairs of frequent words as sorted keys and counts."""
    def run(batches):
        for batch in batches:
            for b, w, c in _read_pairs(batch):
                i = (c >= cut) & (b >= 0) & (w >= 0)
                yield pa.RecordBatch.from_arrays([pa.array(b[i] << _SHIFT | w[i]), pa.array(c[i])], names=["k", "c"])
    got = pairs.mapInArrow(run, "k bigint, c bigint").toPandas().sort_values("k")
    return got["k"].to_numpy(np.int64), got["c"].to_numpy(np.int64)


def _lower_prob(c, m) -> F.Column:
    """Unigram probability of a word with count column ``c`` (null: unknown)."""
    d = F.lit(1.0)
    for r, x in enumerate(m["d1"], 1):
        d = F.when(c == r, x).otherwise(d)
    return F.when(c.isNull(), m["unknown"]).otherwise(d * c / m["n1"])


def fit(docs: DataFrame, text_col="text", frequent: int = FREQUENT, frequent_pairs: int = FREQUENT_PAIRS,
        chunk: int = CHUNK_TOKENS, least_buckets: int = LEAST_BUCKETS) -> Model:
    """Counts, discounts and backoff weights of all texts of ``docs``.  The parameters bound the broadcast
    words and pairs, a chunk's tokens and the number of buckets; no result depends on them."""
    spark = docs.sparkSession
    ship(spark)
    train = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    table = stored(_word_counts(train), "katz-words")
    n, v, *low = table.agg(F.sum("c"), F.count("*"), *[F.count(F.when(F.col("c") == r, 1)) for r in range(1, CUT + 2)]).first()
    n = n or 0
    ends = table.where(f"h = {-END}").first()
    texts = ends["c"] if ends else 0
    hashes, ranks, counts = _top_words(table, frequent)
    counts[START], counts[END] = texts, texts
    d1 = discounts(low)
    left = sum(r * x * (1 - d) for r, (x, d) in enumerate(zip(low, d1), 1))
    n1, unknown = (n, left / n) if left else (n + 1, 1 / (n + 1))
    buckets = max(least_buckets, -(-n // BUCKET_TOKENS))
    m = {"hashes": hashes, "ranks": ranks, "counts": counts, "d1": d1, "n1": n1, "unknown": unknown,
         "n": n, "v": v, "chunk": chunk, "buckets": buckets}
    shared = spark.sparkContext.broadcast(m)
    pairs = stored(_pair_blobs(train, shared).groupBy("bucket")
                   .applyInArrow(_merged, "bucket int, b binary, w binary, c binary"), "katz-pairs")
    rare = _rare_after(pairs).join(table, "h").groupBy("b").agg(F.sum(_lower_prob(F.col("c"), m)).alias("s"))
    zero = [F.lit(0).cast("bigint").alias(x) for x in ("c", *_SEEN)]
    parts = _context_parts(pairs, shared).union(rare.select("b", *zero, "s"))
    ctx = stored(parts.groupBy("b").agg(*[F.sum(x).alias(x) for x in ("c", *_SEEN, "s")]), "katz-context-counts")
    types = [x or 0 for x in ctx.agg(*[F.sum(x) for x in _SEEN]).first()]
    d2 = discounts(types)
    kept = sum((F.lit(r * (1 - d)) * F.col(f"m{r}") for r, d in enumerate(d2, 1)), F.lit(0.0))
    more = F.when(kept == 0, 1).otherwise(0)
    spare = F.greatest(1 - F.col("s"), F.lit(unknown))  # an unknown word has been seen nowhere
    contexts = ctx.select("b", F.log10(F.col("c") + more).alias("total"),
                          F.log10((kept + more) / (F.col("c") + more) / spare).alias("back"))
    cut = _least_count(_pair_sizes(pairs), frequent_pairs)
    keys, sizes = _top_pairs(pairs, cut)
    totals = np.log10(np.maximum(counts, 1))  # a frequent context occurs as often as its word
    spared = ctx.where((F.col("b") >= 0) & (kept == 0)).select("b").toPandas()["b"].to_numpy(np.int64)
    totals[spared] = np.log10(counts[spared] + 1)
    m = m | {"d2": d2, "keys": keys, "log_keys": _log_discounted(sizes, d2) - totals[keys >> _SHIFT]}
    return Model(table, pairs, contexts, m, n)


def _log_discounted(c: np.ndarray, d: list[float]) -> np.ndarray:
    factor = np.array([1.0, *d])
    return np.log10(np.where(c <= CUT, factor[np.minimum(c, CUT)], 1.0) * np.maximum(c, 1))


# ---- scoring ------------------------------------------------------------------

_PART = "kind int, chunk bigint, i int, h1 bigint, h2 bigint, n bigint, known bigint, base double, score double, " \
        "h bigint, k bigint, bucket int, b binary, w binary, c binary, at binary"
_TEXT, _RARE, _BLOB = 0, 1, 2


def _part(size, kind, schema, **columns):
    given = {"kind": pa.array(np.full(size, kind, np.int32)), **columns}
    return pa.RecordBatch.from_arrays([given[f.name] if f.name in given else pa.nulls(size, f.type) for f in schema],
                                      schema=schema)


def _parts_schema():
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "binary": pa.binary()}
    return pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in _PART.split(", ")])


def _read_texts(docs: DataFrame, shared) -> DataFrame:
    """What the texts say by themselves: a row per text, its rare words, and its other pairs by bucket."""
    def run(batches):
        m = shared.value
        schema = _parts_schema()
        base = np.log10((m["counts"] + 0.5) / (m["n"] + 0.5 * (m["v"] + 1)))
        for rows in _chunks(batches, m["chunk"]):
            texts = list({r[1:]: r[0] for r in rows}.items())
            chunk = np.int64(xxhash.xxh64_intdigest(np.array([x[0] for x in texts], np.int64).tobytes()) >> 1)
            pairs = _read([x[1] for x in texts], m)
            k, codes = pairs.n_texts, pairs.codes
            often = codes >= 0
            own_base = np.where(often, base[np.maximum(codes, 0)], 0.0)
            own_known = often & (m["counts"][np.maximum(codes, 0)] > 0)
            plain = np.bincount(pairs.text, own_base[pairs.w], k)
            seen = np.bincount(pairs.text, own_known[pairs.w], k).astype(np.int64)
            size = np.bincount(pairs.text, minlength=k).astype(np.int64)
            far = np.flatnonzero(~often[pairs.w])
            rare, i, count = counted(codes[pairs.w[far]], pairs.text[far], np.ones(len(far), np.int64))
            b, w, starts, at = pairs.grouped()
            b, w, n = codes[b], codes[w], np.diff(np.append(starts, len(at)))
            hit, score = np.zeros(len(b), bool), np.zeros(k)
            if len(m["keys"]):
                key = np.where((b >= 0) & (w >= 0), b << _SHIFT | w, -1)
                pos = np.minimum(np.searchsorted(m["keys"], key), len(m["keys"]) - 1)
                hit = m["keys"][pos] == key
                score = np.bincount(at, np.repeat(np.where(hit, m["log_keys"][pos], 0.0), n), k)
            h = np.array([x[0] for x in texts], np.int64).reshape(-1, 2)
            yield _part(k, _TEXT, schema, chunk=pa.array(np.full(k, chunk)), i=pa.array(np.arange(k, dtype=np.int32)),
                        h1=pa.array(h[:, 0]), h2=pa.array(h[:, 1]), n=pa.array(size), known=pa.array(seen),
                        base=pa.array(plain), score=pa.array(score))
            for lo in range(0, len(rare), 50_000):
                part = slice(lo, lo + 50_000)
                yield _part(len(rare[part]), _RARE, schema, chunk=pa.array(np.full(len(rare[part]), chunk)),
                            i=pa.array(i[part].astype(np.int32)), h=pa.array(-(rare[part] + 1)), k=pa.array(count[part]))
            at = at[np.repeat(~hit, n)].astype(np.uint16)
            b, w, c = b[~hit], w[~hit], n[~hit]
            starts = np.cumsum(c) - c
            bucket = bucket_of(b, w, salts(m), m["buckets"])

            def blob(i, b=b, w=w, c=c, at=at, starts=starts):
                n = c[i]
                inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                return (rising(b[i]), squeeze(w[i]), squeeze(n.astype(np.uint32)), squeeze(at[np.repeat(starts[i], n) + inner]))

            for batch in _dealt(bucket, m["buckets"], blob, ["b", "w", "c", "at"]):
                yield _part(batch.num_rows, _BLOB, schema, chunk=pa.array(np.full(batch.num_rows, chunk)),
                            **{x: batch.column(x) for x in ("bucket", "b", "w", "c", "at")})

    return docs.mapInArrow(run, _PART)


def _by_bucket(contexts: DataFrame, shared) -> DataFrame:
    """(bucket, code, total, back): each context in every bucket that holds some of its pairs."""
    def run(batches):
        m = shared.value
        for batch in batches:
            b = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            s = np.where(b >= 0, salts(m)[np.maximum(b, 0)], 1)
            i = np.repeat(np.arange(len(b)), s)
            salt = np.arange(len(i)) - np.repeat(np.cumsum(s) - s, s)
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket_at(b[i], salt, m["buckets"]).astype(np.int32)), pa.array(b[i]),
                 batch.column(1).take(pa.array(i)), batch.column(2).take(pa.array(i))], names=["bucket", "code", "total", "back"])
    # two salts of a context may share a bucket
    return contexts.mapInArrow(run, "bucket int, code bigint, total double, back double")


def _look_up(shared):
    """A function of one bucket's rows: texts' pairs against the table; sums per text, and what backs off to rare words."""
    def run(table: pa.Table) -> pa.Table:
        m = shared.value
        kind = table.column("kind").to_numpy()
        of = lambda k: table.filter(pa.array(kind == k))
        ctx = of(1)
        code = ctx.column("code").to_numpy().astype(np.int64)
        code, first = np.unique(code, return_index=True)
        total, back = (ctx.column(x).to_numpy()[first] for x in ("total", "back"))
        have = [(unrising(r["b"]), unsqueeze(r["w"], np.int64), unsqueeze(r["c"], np.int64)) for r in of(0).to_pylist()]
        tb, tw, tc = have[0] if have else (np.zeros(0, np.int64),) * 3
        log_c = _log_discounted(tc, m["d2"])
        asked = [(r["chunk"], unrising(r["b"]), unsqueeze(r["w"], np.int64), unsqueeze(r["c"], np.uint32).astype(np.int64),
                  unsqueeze(r["at"], np.uint16).astype(np.int64)) for r in of(2).to_pylist()]
        out = [[], [], [], [], []]
        if asked:
            keys = Keys(tb, tw, *[x for a in asked for x in a[1:3]])
            held = keys.pack(tb, tw)  # sorted as the table is
        p1 = unigrams(m)
        for chunk, b, w, n, at in asked:
            key = keys.pack(b, w)
            pos = np.minimum(np.searchsorted(held, key), max(0, len(held) - 1))
            seen = held[pos] == key if len(held) else np.zeros(len(key), bool)
            c = np.minimum(np.searchsorted(code, b), max(0, len(code) - 1))
            known = code[c] == b if len(code) else np.zeros(len(b), bool)
            value = np.zeros(len(b))
            if len(held):
                value = np.where(seen, log_c[pos] - total[c], 0.0)
            if len(code):
                value = value + np.where(~seen & known, back[c], 0.0)
            often = ~seen & (w >= 0)
            value[often] += np.log10(np.maximum(p1[w[often]], 1e-300))
            k = int(at.max()) + 1
            sums = np.bincount(at, np.repeat(value, n), k)
            texts = np.flatnonzero(np.bincount(at, minlength=k))
            rare = np.repeat(~seen & (w < 0), n)
            hashes = np.repeat(-(w + 1), n)[rare]
            out[0].append(np.full(len(texts) + len(hashes), chunk, np.int64))
            out[1].append(np.concatenate([texts, at[rare]]).astype(np.int32))
            out[2].append(np.concatenate([sums[texts], np.zeros(len(hashes))]))
            out[3].append(np.concatenate([np.zeros(len(texts), np.int64), hashes]))
            out[4].append(np.concatenate([np.zeros(len(texts), np.int64), np.ones(len(hashes), np.int64)]))
        kinds = (np.int64, np.int32, np.float64, np.int64, np.int64)
        cols = [np.concatenate(x) if x else np.zeros(0, t) for x, t in zip(out, kinds, strict=True)]
        return pa.table(dict(zip(["chunk", "i", "score", "h", "k"], cols, strict=True)))
    return run


def score(docs: DataFrame, model: Model, id_col="doc_id", text_col="text") -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark, m = docs.sparkSession, model.shared
    ship(spark)
    shared = spark.sparkContext.broadcast(m)
    text = F.coalesce(F.col(text_col), F.lit(""))
    h1, h2 = F.xxhash64(F.lit(1), text), F.xxhash64(F.lit(2), text)
    read = _read_texts(docs.select(text.alias("text"), h1.alias("h1"), h2.alias("h2")), shared)
    read = stored(read, "katz-texts")
    none = lambda t: F.lit(None).cast(t)
    at = ["bucket", "kind", "chunk", "b", "w", "c", "at", "code", "total", "back"]
    tables = model.pairs.select("bucket", F.lit(0).alias("kind"), none("bigint").alias("chunk"), "b", "w", "c",
                                none("binary").alias("at"), none("bigint").alias("code"), none("double").alias("total"),
                                none("double").alias("back"))
    weights = _by_bucket(model.contexts, shared).select(
        "bucket", F.lit(1).alias("kind"), none("bigint").alias("chunk"), *[none("binary").alias(x) for x in ("b", "w", "c", "at")],
        "code", "total", "back")
    blobs = read.where(F.col("kind") == _BLOB).select(
        "bucket", F.lit(2).alias("kind"), "chunk", "b", "w", "c", "at", none("bigint").alias("code"),
        none("double").alias("total"), none("double").alias("back"))
    found = tables.union(weights).union(blobs).select(*at).groupBy("bucket") \
        .applyInArrow(_look_up(shared), "chunk bigint, i int, score double, h bigint, k bigint")
    found = stored(found, "katz-found")
    den = F.lit(m["n"] + 0.5 * (m["v"] + 1))
    zero = F.lit(0).cast("bigint")
    rare = read.where(F.col("kind") == _RARE).select("chunk", "i", "h", F.col("k").alias("kb"), zero.alias("ku")) \
        .union(found.where("k > 0").select("chunk", "i", "h", zero.alias("kb"), F.col("k").alias("ku"))) \
        .join(model.words, "h", "left")
    rare = rare.select("chunk", "i", F.when(F.col("c").isNotNull(), F.col("kb")).otherwise(0).alias("known"),
                       (F.col("kb") * F.log10((F.coalesce("c", F.lit(0)) + 0.5) / den)).alias("base"),
                       (F.col("ku") * F.log10(_lower_prob(F.col("c"), m))).alias("score"))
    empty = [none("bigint").alias(x) for x in ("h1", "h2", "n")]
    parts = read.where(F.col("kind") == _TEXT).select("chunk", "i", "h1", "h2", "n", "known", "base", "score") \
        .union(rare.select("chunk", "i", *empty, "known", "base", "score")) \
        .union(found.where("k = 0").select("chunk", "i", *empty, zero.alias("known"), F.lit(0.0).alias("base"), "score"))
    one = parts.groupBy("chunk", "i").agg(
        F.max("h1").alias("h1"), F.max("h2").alias("h2"), F.max("n").alias("n"), F.count("n").alias("copies"),
        *[F.sum(x).alias(x) for x in ("known", "base", "score")])
    # chunks of equal texts share their number, and every copy adds the same
    one = one.select("h1", "h2", "n", (F.col("known") / F.col("copies")).cast("bigint").alias("known"),
                     (F.col("base") / F.col("copies")).alias("base"), (F.col("score") / F.col("copies")).alias("score")) \
        .groupBy("h1", "h2").agg(*[F.min(x).alias(x) for x in ("n", "known", "base", "score")])
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), h1.alias("h1"), h2.alias("h2"))
    return rows.join(one, ["h1", "h2"]).select(
        "doc_id", "held_out", F.col("n").alias("n_tokens"), F.col("known").alias("n_known"),
        F.lit(model.train_tokens).cast("bigint").alias("train_tokens"), F.col("base").alias("base_score"), "score")


def fit_and_score(docs: DataFrame, id_col="doc_id", text_col="text", **bounds) -> DataFrame:
    """Learn from the rows that are not held out, score all."""
    return score(docs, fit(docs.where(~held_out(id_col)), text_col, **bounds), id_col, text_col)
