"""Token-id output as directly addressable codes (DAC).

Ids are split into 8-bit chunks.  Level 0 holds the low chunk of every id
and a bitmap that says which ids go on; level 1 holds the next chunk of
those, with a bitmap of its own, and so on.  A rank directory over each
bitmap (ones before every 512th bit) turns a position on one level into the
position on the next, so token ``i`` is read with one byte and one popcount
per level and no block is decoded.

A file is a run of segments of ``SEGMENT`` ids, an offset table, the table
of its documents and a footer.  Files cover ascending document ids; a
document may span segments.  Documents are range-partitioned by id (the text
hash breaks ties, so a repeated id is split too), encoded in place and
streamed to files, so a task holds one Arrow batch and one segment.  A file
name is unique to its task attempt and only files named in the stored
manifest count: lost executors leave stray files, never wrong ones.

Edge cases: a null or empty text is one end id; null ids come first; rows
with the same id are documents of their own; an empty table gives no files
and an empty result; other columns are not read."""
from __future__ import annotations

import io
import itertools
import json
import os
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shuffle_partitions
from .common import scratch, ship, stored

SEGMENT = 1 << 20
RANK_BITS = 512
MAGIC = b"DAC1"
CACHE_WORDS = 700_000

_cache: dict = {}


class WordEncoder:
    """Whole-text encoding through a bounded memo of words.

    The tokenizer's pre-tokenizer never joins text across ASCII white space,
    so a text's ids are its words' ids in a row.  Words are looked up in
    ASCII lower case where the tokenizer lower-cases (special strings are
    matched before that, so texts with ``<|`` keep their case), and a final
    full stop or comma after an ASCII letter is a pre-token of its own."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        spec = json.loads(self.tok.to_str())
        pre = json.dumps(spec.get("pre_tokenizer"))
        if "\\\\s" not in pre or '"Lowercase"' not in json.dumps(spec.get("normalizer")):
            raise ValueError("the word memo needs a lower-casing tokenizer that splits at white space")
        suffix = spec["model"].get("end_of_word_suffix")
        vocab = self.tok.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        if suffix:
            self.ends[[i for w, i in vocab.items() if w.endswith(suffix)]] = True
        self.memo: dict[bytes, bytes] = {}
        self.memo.update({p: self._raw([p])[0] for p in (b".", b",")})

    def _raw(self, words: list[bytes]) -> list[bytes]:
        enc = getattr(self.tok, "encode_batch_fast", self.tok.encode_batch)
        return [np.asarray(e.ids, "<u4").tobytes()
                for e in enc([w.decode() for w in words], add_special_tokens=False)]

    def _plain(self, words: list[bytes]) -> list[bytes]:
        """Ids of words of letters alone: each is one pre-token and ends with
        an end-of-word piece, so many are encoded as one text and cut there
        (where the cuts don't add up, word by word)."""
        groups = [words[i:i + 128] for i in range(0, len(words), 128)]
        enc = getattr(self.tok, "encode_batch_fast", self.tok.encode_batch)
        out = []
        for g, e in zip(groups, enc([b" ".join(g).decode() for g in groups], add_special_tokens=False), strict=True):
            ids = np.asarray(e.ids, "<u4")
            cuts, raw, lo = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist(), ids.tobytes(), 0
            if len(cuts) != len(g):
                out += self._raw(g)
                continue
            for c in cuts:
                out.append(raw[lo:c])
                lo = c
        return out

    def _learn(self, missing: list[bytes]) -> None:
        memo, direct, ends = self.memo, set(), []
        for w in missing:
            if len(w) > 1 and w[-1] in b".," and 97 <= w[-2] <= 122 and b"<|" not in w:
                ends.append(w)
                if w[:-1] not in memo:
                    direct.add(w[:-1])
            else:
                direct.add(w)
        todo = [w for w in direct if w not in memo]
        plain, other = [], []
        for w in todo:
            (plain if w.isalpha() or w.decode().isalpha() else other).append(w)
        memo.update(zip(plain, self._plain(plain), strict=True))
        memo.update(zip(other, self._raw(other), strict=True))
        for w in ends:
            memo[w] = memo[w[:-1]] + memo[w[-1:]]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian 32-bit ids of each text, as bytes."""
        rows = []
        for t in texts:
            raw = (t or "").encode("utf-8", "surrogatepass")
            rows.append(raw.split() if b"<|" in raw else raw.lower().split())
        if len(self.memo) > CACHE_WORDS:  # the words met first are the frequent ones
            self.memo = dict(itertools.islice(self.memo.items(), CACHE_WORDS // 2))
        missing = set().union(*rows).difference(self.memo) if rows else set()
        if missing:
            self._learn(list(missing))
        get = self.memo.__getitem__
        return [b"".join(map(get, ws)) for ws in rows]


def encoder(path: str) -> WordEncoder:
    """One encoder per worker process."""
    if path not in _cache:
        _cache[path] = WordEncoder(path)
    return _cache[path]


# ---- the code ----------------------------------------------------------------

def pack(ids: np.ndarray) -> bytes:
    """One segment: level count, then per level its length, chunks, bitmap and rank directory."""
    out, rest = [], ids.astype(np.uint32, copy=False)
    while True:
        more = rest > 255
        bits = np.packbits(more, bitorder="little")
        ones = np.add.reduceat(np.unpackbits(bits), np.arange(0, len(bits) * 8, RANK_BITS), dtype=np.uint32) \
            if len(bits) else np.zeros(0, np.uint32)
        rank = np.concatenate([[0], np.cumsum(ones)[:-1]]).astype("<u4") if len(ones) else ones
        out.append(struct.pack("<I", len(rest)) + (rest & 255).astype(np.uint8).tobytes()
                   + bits.tobytes() + rank.tobytes())
        if not more.any():
            break
        rest = rest[more] >> 8
    return struct.pack("<B", len(out)) + b"".join(out)


def _levels(buf):
    """(length, chunks, bitmap, rank directory) offsets of each level."""
    n_levels, at = buf[0], 1
    for _ in range(n_levels):
        (n,) = struct.unpack_from("<I", buf, at)
        chunks = at + 4
        bitmap = chunks + n
        ranks = bitmap + (n + 7) // 8
        at = ranks + 4 * -(-((n + 7) // 8 * 8) // RANK_BITS)
        yield n, chunks, bitmap, ranks


def unpack(buf: bytes) -> np.ndarray:
    """All ids of a segment."""
    out, where = None, None
    for level, (n, chunks, bitmap, _) in enumerate(_levels(buf)):
        c = np.frombuffer(buf, np.uint8, n, chunks).astype(np.uint32)
        if out is None:
            out, where = c, np.arange(n)
        else:
            out[where] |= c << np.uint32(8 * level)
        more = np.unpackbits(np.frombuffer(buf, np.uint8, (n + 7) // 8, bitmap), bitorder="little")[:n]
        where = where[more.astype(bool)]
    return out


def access(buf: bytes, i: int) -> int:
    """Id ``i`` of a segment by rank alone."""
    value = 0
    for level, (_, chunks, bitmap, ranks) in enumerate(_levels(buf)):
        value |= buf[chunks + i] << (8 * level)
        if not buf[bitmap + (i >> 3)] >> (i & 7) & 1:
            break
        block = i // RANK_BITS
        (before,) = struct.unpack_from("<I", buf, ranks + 4 * block)
        lo = bitmap + block * RANK_BITS // 8
        part = int.from_bytes(buf[lo:bitmap + (i >> 3) + 1], "little")
        i = before + (part & ((1 << (i - block * RANK_BITS)) - 1)).bit_count()
    return value


# ---- files -------------------------------------------------------------------

class FileWriter:
    """Streams ids to one file; holds one segment."""

    def __init__(self, sink):
        self.sink, self.at, self.offsets, self.held, self.n_held = sink, 0, [], [], 0
        self.docs: list[tuple[int | None, int, int]] = []
        self.n = 0
        self._put(MAGIC)

    def _put(self, b: bytes):
        self.sink.write(b)
        self.at += len(b)

    def add(self, doc_id, ids: np.ndarray):
        self.docs.append((doc_id, self.n, len(ids)))
        self.n += len(ids)
        while len(ids):
            part = ids[:SEGMENT - self.n_held]
            self.held.append(part)
            self.n_held += len(part)
            ids = ids[len(part):]
            if self.n_held == SEGMENT:
                self._flush()

    def _flush(self):
        if self.n_held:
            self.offsets.append(self.at)
            self._put(pack(np.concatenate(self.held)))
            self.held, self.n_held = [], 0

    def close(self):
        self._flush()
        known = np.array([d[0] is not None for d in self.docs], bool)
        table = np.array([(d[0] or 0, d[1], d[2]) for d in self.docs], "<i8").reshape(-1, 3)
        body = np.array([*self.offsets, self.at], "<i8").tobytes() + np.packbits(known).tobytes() + table.tobytes()
        self._put(body)
        self._put(struct.pack("<QQQQ", len(self.offsets), len(self.docs), self.n, len(body)) + MAGIC)
        self.sink.close()


class FileReader:
    """Random access to a file of ``FileWriter``."""

    def __init__(self, source):
        self.src = source
        size = source.size()
        segs, docs, self.n, body = struct.unpack("<QQQQ", source.read_at(36, size - 36)[:32])
        b = source.read_at(body, size - 36 - body)
        self.offsets = np.frombuffer(b, "<i8", segs + 1)
        at = 8 * (segs + 1)
        known = np.unpackbits(np.frombuffer(b, np.uint8, (docs + 7) // 8, at))[:docs].astype(bool)
        table = np.frombuffer(b, "<i8", 3 * docs, at + (docs + 7) // 8).reshape(-1, 3)
        self.ids = [int(x) if k else None for x, k in zip(table[:, 0], known, strict=True)]
        self.starts, self.lengths = table[:, 1], table[:, 2]
        self._at, self._buf = -1, b""

    def segment(self, k: int) -> bytes:
        if k != self._at:
            lo, hi = int(self.offsets[k]), int(self.offsets[k + 1])
            self._at, self._buf = k, self.src.read_at(hi - lo, lo)
        return self._buf

    def token(self, i: int) -> int:
        """Token ``i`` of the file, by rank: no segment is decoded."""
        return access(self.segment(i // SEGMENT), i % SEGMENT)

    def documents(self):
        """(doc_id, start, ids as parts) in file order; each segment is unpacked once."""
        k, seg = -1, None
        for doc, start, n in zip(self.ids, self.starts, self.lengths, strict=True):
            parts, at, end = [], int(start), int(start + n)
            while at < end:
                if at // SEGMENT != k:
                    k = at // SEGMENT
                    seg = unpack(self.segment(k))
                lo = at % SEGMENT
                part = seg[lo:lo + end - at]
                parts.append(part)
                at += len(part)
            yield doc, int(start), parts


def _fs(path: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") \
        else (fs.LocalFileSystem(), path)


MANIFEST = "part int, file string, n_docs bigint, n_tokens bigint"


def write_codes(docs: DataFrame, tokenizer: str, end_id: int | None, path: str,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and write ``docs`` below ``path`` in ascending id order; the stored manifest (one row a file)."""
    ship(docs.sparkSession)
    t = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    tie = F.xxhash64("text")
    t = t.repartitionByRange(shuffle_partitions(docs.sparkSession), F.col("doc_id"), tie) \
        .sortWithinPartitions("doc_id", tie)
    end = np.array([] if end_id is None else [end_id], "<u4")

    def run(batches):
        from pyspark import TaskContext
        enc, out, name, base = encoder(tokenizer), None, None, None
        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1)
            for lo in range(0, len(ids), 256):
                chunk = texts.slice(lo, 256).to_pylist()
                for doc, raw in zip(ids[lo:lo + 256], enc.encode(chunk), strict=True):
                    if out is None:
                        fs, base = _fs(path)
                        fs.create_dir(base, recursive=True)
                        name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.dac"
                        out = FileWriter(io.BufferedWriter(fs.open_output_stream(f"{base}/{name}"), 1 << 20))
                    out.add(doc, np.concatenate([np.frombuffer(raw, "<u4"), end]))
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([TaskContext.get().partitionId()], pa.int32()), "file": [name],
                "n_docs": pa.array([len(out.docs)], pa.int64()), "n_tokens": pa.array([out.n], pa.int64())})

    return stored(t.mapInArrow(run, MANIFEST), "codes-manifest")


def read_codes(spark: SparkSession, manifest: DataFrame, path: str) -> DataFrame:
    """Per document, read back from the files: doc_id, start, n_tokens, ids_crc32."""
    files = sorted(manifest.collect(), key=lambda r: r["part"])  # one row a file
    before, rows = 0, []
    for r in files:
        rows.append((r["file"], before))
        before += r["n_tokens"]
    todo = spark.createDataFrame(rows, "file string, before bigint").repartition(max(1, len(rows)), "file")

    def run(batches):
        fs, base = _fs(path)
        for b in batches:
            for name, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                out = []
                with fs.open_input_file(f"{base}/{name}") as src:
                    for doc, at, parts in FileReader(src).documents():
                        crc = 0
                        for p in parts:
                            crc = zlib.crc32(p.astype("<u4", copy=False), crc)
                        out.append((doc, start + at, sum(map(len, parts)), crc))
                for lo in range(0, len(out), 10_000):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64()) for c in zip(*out[lo:lo + 10_000], strict=True)],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return todo.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def encode_roundtrip(docs: DataFrame, tokenizer: str, end_id: int | None = 2, **cols) -> DataFrame:
    """Write the files to a fresh shared folder and digest what they hold."""
    spark = docs.sparkSession
    path = scratch(spark, "codes")
    return read_codes(spark, write_codes(docs, tokenizer, end_id, path, **cols), path)
