"""Token counts by distinct pre-token.

A pre-token is a stretch of text that the model can't merge across: cuts lie
before runs of spaces, around line feeds and after a letter that is followed
by punctuation that no piece of the vocabulary has after a letter (read from
the vocabulary).  Pieces never cross a cut, so a text's count is the sum
over its pre-tokens.

1. Distinct pre-tokens with their corpus frequency: partial counts in each
   task, one aggregation.
2. Each distinct pre-token is encoded once; the vocabulary table is stored.
3. Per document, pre-token frequencies meet the vocabulary.  The most
   frequent ``frequent`` pre-tokens of at most ``MAX_CHARS`` characters go
   to every task as a dictionary (size bounded by those two numbers); the
   frequencies of all others are joined by a shuffle, on keys that are rare
   by construction, and summed.

No ids are materialised.  Edge cases: a null or empty text has 0 tokens and
0 bytes; ids may be null or repeat (rows are told apart by a row number);
an empty table gives an empty result; other columns are not read."""
from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import n_bytes, ship, stored

FREQUENT = 400_000
MAX_CHARS = 48
FLUSH = 250_000
LIMIT = 4096
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_SP = " ▁"

_models: dict = {}


class PieceCounter:
    """Piece counts of pre-tokens of one sentencepiece model."""

    def __init__(self, path: str):
        import sentencepiece
        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())
                  if not (self.sp.is_byte(i) or self.sp.is_control(i) or self.sp.is_unknown(i))]
        inner = re.compile("[^▁]▁")
        if any(inner.search(p) or "\n" in p for p in pieces) or self.sp.encode("A  ﬁ\t ", out_type=str)[0] != "▁A":
            raise ValueError("pieces of this model cross spaces or line feeds, or it rewrites its input")
        after = set()
        for p in pieces:
            after.update(re.findall(f"[{_LETTERS}]([!-/:-@\\[-`{{-~])", p))
        cut = "".join(re.escape(c) for c in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" if c not in after)
        self.units = re.compile(
            f"\n|[{_SP}]*[{_LETTERS}]+(?=[{cut}{_SP}\n]|\\Z)|[{_SP}]+[^{_SP}\n]*|[^{_SP}\n]+").findall

    def split(self, text: str) -> list[str]:
        """Pre-tokens; the model's own leading space is part of the first."""
        return self.units(" " + text) if text else []

    def count(self, units: list[str]) -> list[int]:
        # a unit without a space is encoded after a line feed, which adds two pieces
        plain = [u[1:] if u[0] in _SP else "\n" + u for u in units]
        return [1 if u in (" ", "▁") else len(ids) - (0 if u[0] in _SP else 2)
                for u, ids in zip(units, self.sp.encode(plain, num_threads=1), strict=True)]


def counter(path: str) -> PieceCounter:
    if path not in _models:
        _models[path] = PieceCounter(path)
    return _models[path]


def _texts(batch, col: int):
    """Texts of a batch, a few at a time."""
    a = batch.column(col)
    for lo in range(0, len(a), 256):
        yield from a.slice(lo, 256).to_pylist()


def vocabulary(docs: DataFrame, model: str, text_col: str = "text") -> DataFrame:
    """Stored table of distinct pre-tokens: unit, n (in the corpus), pieces."""

    def tally(batches):
        m, seen = counter(model), Counter()
        for b in batches:
            for t in _texts(b, 0):
                seen.update(m.split(t or ""))
                if len(seen) > FLUSH:
                    yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()),
                                                      pa.array(seen.values(), pa.int64())], names=["unit", "n"])
                    seen = Counter()
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()),
                                              pa.array(seen.values(), pa.int64())], names=["unit", "n"])

    def encode(batches):
        m = counter(model)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1),
                                              pa.array(m.count(b.column(0).to_pylist()), pa.int64())],
                                             names=["unit", "n", "pieces"])

    seen = docs.select(text_col).mapInArrow(tally, "unit string, n bigint")
    distinct = seen.groupBy("unit").agg(F.sum("n").alias("n"))
    return stored(distinct.mapInArrow(encode, "unit string, n bigint, pieces bigint"), "pre-tokens")


def _frequent(vocab: DataFrame, most: int) -> dict[str, int]:
    """At most ``most`` of the most frequent short pre-tokens, by a histogram of frequencies."""
    short = vocab.where(F.length("unit") <= MAX_CHARS)
    level = F.floor(F.log2("n") * 16).cast("int")
    sizes = sorted(((r["l"], r["c"]) for r in short.groupBy(level.alias("l")).agg(F.count("*").alias("c")).collect()),
                   reverse=True)
    cut, total = None, 0
    for lv, c in sizes:
        if total + c > most:
            break
        cut, total = lv, total + c
    if cut is None:
        return {}
    got = short.where(level >= cut).select("unit", "pieces").toArrow()
    return dict(zip(got.column(0).to_pylist(), got.column(1).to_pylist(), strict=True))


def count_tokens(docs: DataFrame, model: str, limit: int = LIMIT, frequent: int = FREQUENT,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens, over_limit."""
    ship(docs.sparkSession)
    vocab = vocabulary(docs, model, text_col)
    known = docs.sparkSession.sparkContext.broadcast(_frequent(vocab, frequent))

    def tally(batches):
        m, get = counter(model), known.value.get
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                sure, rare = [], []
                for t in b.column(2).slice(lo, 256).to_pylist():
                    total, rest = 0, []
                    for u, f in Counter(m.split(t or "")).items():
                        p = get(u)
                        if p is None:
                            rest.append({"unit": u, "f": f})
                        else:
                            total += p * f
                    sure.append(total)
                    rare.append(rest)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, 256), b.column(1).slice(lo, 256), pa.array(sure, pa.int64()),
                     pa.array(rare, pa.list_(pa.struct([("unit", pa.string()), ("f", pa.int64())])))],
                    names=["doc_id", "n_bytes", "sure", "rare"])

    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("doc_id"), n_bytes(F.col(text_col)).alias("n_bytes"),
                       F.col(text_col).alias("text")) \
        .mapInArrow(tally, f"doc_id {kind}, n_bytes bigint, sure bigint, rare array<struct<unit:string,f:bigint>>")
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "token-rows")
    rest = rows.select("row", F.inline("rare")).join(vocab.select("unit", "pieces"), "unit") \
        .groupBy("row").agg(F.sum(F.col("f") * F.col("pieces")).alias("more"))
    n = (F.col("sure") + F.coalesce(F.col("more"), F.lit(0))).alias("n_tokens")
    return rows.drop("rare").join(rest, "row", "left").select("doc_id", "n_bytes", n, (n > limit).alias("over_limit"))
