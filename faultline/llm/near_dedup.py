"""Near-duplicates by MinHash, banding, verification and star contraction.

1. Sketch: a text's distinct 5-word shingles are hashed to 64 bits; ``BANDS``
   x ``ROWS`` universal hash functions (a x + b, high half, 64-bit a and b)
   give the minima.  A band's minima make one key.  Texts with the same
   shingle set (128-bit fingerprint) are one class with its least id as node.
2. Star pairs: in each bucket (band key) the least node leads; every node is
   paired with the leader it shares most buckets with, if they share at
   least ``STAR_SHARED``, and pairs are confirmed on the full shingle sets of
   both texts.  This only saves work: what it leaves out step 4 tests.
3. Components of the confirmed links by large-star and small-star.
4. Rest: in buckets that still hold several components the nodes outside the
   largest one are compared with all of other components, in blocks bounded
   in rows and bytes: by signature
   agreement first, then, for the nodes that have a partner left, by their
   sets.  New pairs are confirmed on the full sets again and the components
   are taken anew.  So each pair that shares a
   bucket has been tested unless it is already in one component; nothing is
   capped and no group's pairs are written out.

With 48 bands of 6 rows a link at similarity 0.75 shares no bucket with
probability 8e-5, at 0.8 with 5e-7; the signature test of step 4 passes links
with a margin of five standard deviations.

Words are runs outside ASCII white space, A-Z in lower case.  Edge cases: a
text of one to four words is one shingle; null, empty and blank texts have
no shingles and link with nothing; rows without an id link with nothing and
are kept; repeated rows fall into one class; an empty table gives an empty
result; extra columns are ignored, ``keep_first`` passes them through.  Rows
that share an id but not the text are one document: it has the text of least
hash, and all its rows with a word get that one's component."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import maybe_in, ship, stored, text_batches
from .components import connected_components

SHINGLE = 5
BANDS, ROWS = 48, 6
PERCENT = 75
STAR_SHARED = 3
BLOCK_ROWS, BLOCK_BYTES = 512, 8 << 20
SLICE = 16_384
MEMO = 400_000

_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                               0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
_RNG = np.random.default_rng(20_240_601)
_A = _RNG.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2)


class _WordHash(dict):
    def __missing__(self, word):
        if len(self) > MEMO:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


_hashes = _WordHash()


def _mixed(s):
    s = (s ^ (s >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return s ^ (s >> np.uint64(31))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - SHINGLE + 1) if len(h) else 0
    if not n:
        return h
    k = min(SHINGLE, len(h))
    s = np.full(n, np.uint64(k), np.uint64)
    for j in range(k):
        s = (s ^ (s >> np.uint64(29))) * _MIX[j] + h[j:j + n]
    return np.unique(_mixed(s))


def minima(s: np.ndarray) -> np.ndarray:
    """32-bit minimum of each hash function over a shingle set."""
    x = s >> np.uint64(32)
    out = np.full(len(_A), np.uint64(0xFFFFFFFFFFFFFFFF))
    for lo in range(0, len(x), SLICE):
        part = x[None, lo:lo + SLICE]
        step = max(1, 262_144 // part.shape[1])
        for k in range(0, len(_A), step):
            v = _A[k:k + step, None] * part
            v += _B[k:k + step, None]
            np.minimum(out[k:k + step], v.min(1), out=out[k:k + step])
    return (out >> np.uint64(32)).astype(np.uint32)


def band_keys(sig: np.ndarray) -> np.ndarray:
    s = np.arange(1, BANDS + 1, dtype=np.uint64)
    for j in range(ROWS):
        s = (s ^ (s >> np.uint64(29))) * _MIX[j % len(_MIX)] + sig.reshape(BANDS, ROWS)[:, j]
    return _mixed(s).view(np.int64)


def similar(a: np.ndarray, b: np.ndarray, percent: float = PERCENT) -> bool:
    """100 |a & b| >= percent |a | b| on sorted distinct arrays."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)) or not len(a):
        return False
    inter = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * inter >= percent * (len(a) + len(b) - inter)


def sketch(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """Stored table doc_id, text_hash, n, fp, bands, sig (low byte of each minimum); bands null for empty sets."""
    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                n, fp, bands, sig = [], [], [], []
                for t in part.column(1).to_pylist():
                    s = shingles(t)
                    n.append(len(s))
                    fp.append(xxhash.xxh3_128_digest(s.tobytes()))
                    m = minima(s) if len(s) else None
                    bands.append(None if m is None else band_keys(m))
                    sig.append(None if m is None else m.astype(np.uint8).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(n, pa.int64()), pa.array(fp, pa.binary()),
                     pa.array(bands, pa.list_(pa.int64())), pa.array(sig, pa.binary())],
                    names=["doc_id", "text_hash", "n", "fp", "bands", "sig"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"),
                       F.xxhash64(F.col(text_col)).alias("text_hash"))
    return stored(rows.mapInArrow(run, "doc_id bigint, text_hash bigint, n bigint, fp binary, bands array<bigint>, "
                                       "sig binary"), "sketch")


def _texts(docs, nodes, id_col, text_col):
    """One text per node id, the one of least hash; texts of other ids mostly stay where they are."""
    ids = stored(nodes.select("node").distinct(), "text-nodes")
    t = docs.select(F.col(id_col).cast("bigint").alias("node"), F.col(text_col).alias("text"))
    t = maybe_in(t, F.col("node"), ids).where("__maybe").drop("__maybe")
    return t.join(ids, "node", "left_semi").groupBy("node").agg(F.min_by("text", F.xxhash64("text")).alias("text"))


def confirm(pairs: DataFrame, docs: DataFrame, id_col, text_col) -> DataFrame:
    """Stored links: the pairs (u, v) whose full shingle sets are similar enough."""
    def run(batches):
        last, held = None, None
        for b in batches:
            keep = []
            u, a, c = b.column(0).to_pylist(), b.column(2), b.column(3)
            for i in range(b.num_rows):
                if last is None or u[i] != last:
                    last, held = u[i], shingles(a[i].as_py())
                keep.append(similar(held, shingles(c[i].as_py())))
            yield b.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    pairs = stored(pairs.select("u", "v").distinct(), "pairs")
    t = stored(_texts(docs, pairs.select(F.col("u").alias("node")).union(pairs.select(F.col("v").alias("node"))),
                      id_col, text_col), "pair-texts")
    # v's are mostly different; a leader u may have very many partners, so its
    # text joins last, as the small side of a join that can be split
    got = pairs.join(t.select(F.col("node").alias("v"), F.col("text").alias("tv")), "v") \
        .join(t.select(F.col("node").alias("u"), F.col("text").alias("tu")), "u") \
        .select("u", "v", "tu", "tv")
    return stored(got.mapInArrow(run, "u bigint, v bigint"), "links")


def block_pairs(comp, size, side, sig, node):
    """(i, partners) of one block: residents that a visitor may be linked to,
    by component, size and signature.  ``side`` is 1 for visitors, 0 for
    residents of the bucket's largest component and 2 for other residents,
    which are visitors too: of such a pair the lesser node visits."""
    p = PERCENT / 100
    least = p - 5 * np.sqrt(p * (1 - p) / sig.shape[1])
    for i in np.flatnonzero(side == 1):
        ok = (comp != comp[i]) & ((side == 0) | (side == 2) & (node > node[i]))
        ok &= 100 * np.minimum(size, size[i]) >= PERCENT * np.maximum(size, size[i])
        at = np.flatnonzero(ok)
        if len(at):
            at = at[(sig[at] == sig[i]).mean(1) >= least]
            if len(at):
                yield int(i), at


def block_links(comp, size, side, sig, node, sets) -> list[tuple[int, int]]:
    """Index pairs of one block with enough set overlap.  Pairs that earlier
    pairs of this block connect for certain are left out."""
    root, first, out = list(range(len(comp))), {}, []

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, c in enumerate(comp.tolist()):
        root[i] = first.setdefault(c, i)
    for i, at in block_pairs(comp, size, side, sig, node):
        for j in at.tolist():
            if find(i) == find(j):
                continue
            a, b = sets[i], sets[j]
            inter = len(np.intersect1d(a, b, assume_unique=True))
            share = 100 * inter / (len(a) + len(b) - inter)
            if share >= PERCENT - 0.5:  # 32-bit shingles: the full sets decide
                out.append((i, j))
                if share >= PERCENT + 0.5:
                    root[find(i)] = find(j)
    return out


def _blocks(rows: DataFrame, weight) -> DataFrame:
    """Rows (key, node, component, ...) dealt into cells: columns pair and side are added.

    The nodes of a bucket are residents, in blocks by hash; those outside its
    largest component are visitors as well, in blocks of their own, and every
    visitors' block meets every residents' block once.  Blocks are bounded by
    ``BLOCK_ROWS`` rows and ``BLOCK_BYTES`` of ``weight``, so one stray node
    beside m others deals m + m / ``BLOCK_ROWS`` rows."""
    size = rows.groupBy("key", "component").agg(F.count("*").alias("m"), F.sum(weight).alias("w"))
    count = size.groupBy("key").agg(F.max(F.struct("m", "w", "component")).alias("top"),
                                    F.sum("m").alias("m"), F.sum("w").alias("w"))
    blocks = lambda m, w: F.greatest(F.ceil(m / BLOCK_ROWS), F.ceil(w / BLOCK_BYTES), F.lit(1)).cast("int")
    count = count.select("key", F.col("top.component").alias("largest"), blocks(F.col("m"), F.col("w")).alias("nr"),
                         blocks(F.col("m") - F.col("top.m"), F.col("w") - F.col("top.w")).alias("nv"))
    b = rows.join(count, "key")
    h = F.xxhash64("node")
    cell = lambda r, v, side: F.struct((v * F.lit(1 << 24).cast("bigint") + r).alias("pair"), F.lit(side).alias("side"))
    stays = lambda side: F.transform(F.sequence(F.lit(0), F.col("nv") - 1),
                                     lambda v: cell(F.pmod(h, F.col("nr")), v, side))
    visits = F.transform(F.sequence(F.lit(0), F.col("nr") - 1),
                         lambda r: cell(r, F.pmod(F.shiftrightunsigned(h, 20), F.col("nv")), 1))
    dealt = F.when(F.col("component") == F.col("largest"), stays(0)).otherwise(F.concat(stays(2), visits))
    return b.select(*rows.columns, F.inline(dealt))


def _by_block(compare, names):
    """An Arrow map over rows sorted by (key, pair): ``compare`` gets the rows of one block as lists."""
    def run(batches):
        key, rows = None, []

        def flush():
            if len(rows) > 1 and any(r[4] != rows[0][4] for r in rows):
                got = compare(rows)
                if got:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*got, strict=True)],
                                                     names=names)

        for b in batches:
            for r in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if r[:2] != key:
                    yield from flush()
                    key, rows = r[:2], []
                rows.append(r)
        yield from flush()
    return run


def _arrays(rows):
    """component, size, side, signature, node of rows (key, pair, side, node, component, n, sig, ...)."""
    return (np.array([r[4] for r in rows]), np.array([r[5] for r in rows]), np.array([r[2] for r in rows]),
            np.frombuffer(b"".join(r[6] for r in rows), np.uint8).reshape(len(rows), -1), np.array([r[3] for r in rows]))


def _close(rows):
    """(key, node) of the rows that have a partner by signature."""
    hit = set()
    for i, at in block_pairs(*_arrays(rows)):
        hit.add(i)
        hit.update(at.tolist())
    return [(rows[i][0], rows[i][3]) for i in sorted(hit)]


def _linked(rows):
    """(u, v) of the rows whose sets overlap enough."""
    got = block_links(*_arrays(rows), [np.frombuffer(r[7], np.uint32) for r in rows])
    return [tuple(sorted((rows[i][3], rows[j][3]))) for i, j in got]


def _rest(buckets: DataFrame, comps: DataFrame, reps: DataFrame, docs, id_col, text_col) -> DataFrame:
    """Pairs across components in buckets that hold several of them."""
    def small_sets(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                s = [np.unique((shingles(t) >> np.uint64(32)).astype(np.uint32)).tobytes()
                     for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(s, pa.binary())], names=["node", "set"])

    def dealt(rows, *more):
        return rows.select("key", "pair", "side", "node", "component", "n", "sig", *more) \
            .repartition("key", "pair").sortWithinPartitions("key", "pair", "node")

    b = buckets.join(comps, "node", "left").withColumn("component", F.coalesce("component", "node"))
    several = b.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    b = b.join(several.select("key"), "key", "left_semi")
    b = stored(b.join(reps.select("node", "n", "sig"), "node"), "open-buckets")
    close = dealt(_blocks(b, F.lit(320))).mapInArrow(_by_block(_close, ["key", "node"]), "key bigint, node bigint")
    close = stored(close.distinct(), "close")
    b = stored(b.join(close, ["key", "node"], "left_semi"), "close-buckets")
    sets = stored(_texts(docs, close, id_col, text_col).mapInArrow(small_sets, "node bigint, set binary"), "small-sets")
    full = _blocks(b, 4 * F.col("n")).join(sets, "node")
    return dealt(full, "set").mapInArrow(_by_block(_linked, ["u", "v"]), "u bigint, v bigint")


def components(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept."""
    ship(docs.sparkSession)
    text_batches(docs.sparkSession)
    sk = sketch(docs, id_col, text_col)
    some = sk.where("doc_id is not null and n > 0")
    # an id with several texts is the document of the text of least hash
    twice = some.groupBy("doc_id").agg(F.min("text_hash").alias("a"), F.max("text_hash").alias("b")).where("a <> b")
    twice = stored(some.join(twice.select("doc_id", F.col("a").alias("text_hash")), ["doc_id", "text_hash"], "left_semi")
                   .select("doc_id", "text_hash", F.col("fp").alias("own_fp")).distinct(), "ids-with-several-texts")
    others = sk.join(twice.select("doc_id", F.col("text_hash").alias("keep"), "own_fp"), "doc_id", "left")
    some = others.where("doc_id is not null and n > 0 and (keep is null or keep = text_hash)")
    classes = stored(some.groupBy("fp").agg(F.min("doc_id").alias("node")), "classes")
    reps = some.join(classes.select(F.col("node").alias("doc_id"), "fp"), ["doc_id", "fp"], "left_semi") \
        .dropDuplicates(["doc_id"]).select(F.col("doc_id").alias("node"), "n", "bands", "sig")
    reps = stored(reps, "representatives")
    # Spark's own exchanges by key, so that a hot bucket's join is split
    rows = reps.select("node", F.explode("bands").alias("key"))
    lead = rows.groupBy("key").agg(F.min("node").alias("leader"), F.count("*").alias("m")).where("m > 1")
    buckets = stored(rows.join(lead.select("key", "leader"), "key"), "buckets")
    stars = buckets.where("node <> leader").groupBy("node", "leader").agg(F.count("*").alias("shared")) \
        .where(F.col("shared") >= STAR_SHARED) \
        .groupBy("node").agg(F.max(F.struct("shared", (-F.col("leader")).alias("minus"))).alias("best")) \
        .select((-F.col("best.minus")).alias("u"), F.col("node").alias("v"))
    links = confirm(stars, docs, id_col, text_col)
    comps = stored(connected_components(links), "components")
    more = confirm(_rest(buckets.select("key", "node"), comps, reps, docs, id_col, text_col), docs, id_col, text_col)
    comps = connected_components(links.union(more))
    whole = classes.join(comps, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    own = F.coalesce("own_fp", F.when(F.col("doc_id").isNotNull() & (F.col("n") > 0), F.col("fp")))
    got = others.select("doc_id", "n", own.alias("fp")) \
        .join(whole, "fp", "left")
    comp = F.coalesce("component_id", "doc_id")
    return got.select("doc_id", F.col("n").alias("n_shingles"), comp.alias("component_id"),
                      F.coalesce(F.col("doc_id") == comp, F.lit(True)).alias("kept"))


def keep_first(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """Rows of ``docs`` that stay: one document of each component, columns unchanged.
    Repeated rows of the kept id stay too."""
    gone = components(docs, id_col, text_col).where("not kept").select(F.col("doc_id").alias("__gone"))
    gone = stored(gone.distinct(), "dropped")
    d = maybe_in(docs, F.col(id_col), gone)
    rest = d.where("__maybe").join(gone, F.col(id_col).cast("bigint") == F.col("__gone"), "left_anti")
    return d.where("not __maybe").union(rest).drop("__maybe")
