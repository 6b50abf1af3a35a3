"""Token codes and token counts against the libraries."""
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from faultline.llm import token_codes as C
from faultline.llm import token_counts as T

from .conftest import odd_rows

P = pytest.importorskip("public_tokenizers")
WORDS, PIECES = P.path("word_bpe_49k.json"), P.path("piece_bpe_32k.model")


def test_pack_round_trip_and_access():
    r = np.random.default_rng(1)
    for n in (0, 1, 511, 512, 513, 5000):
        ids = r.integers(0, [200, 300, 70_000, 1 << 31][n % 4], n, dtype=np.uint32)
        buf = C.pack(ids)
        assert (C.unpack(buf) == ids).all()
        assert all(C.access(buf, int(i)) == ids[i] for i in r.integers(0, n, 40)) if n else True


def test_file_random_access(tmp_path, monkeypatch):
    monkeypatch.setattr(C, "SEGMENT", 1000)
    r = np.random.default_rng(2)
    docs = [(i if i % 5 else None, r.integers(0, 49_000, int(r.integers(0, 2600)), dtype=np.uint32)) for i in range(20)]
    from pyarrow import fs
    w = C.FileWriter(fs.LocalFileSystem().open_output_stream(str(tmp_path / "f.dac")))
    for d, ids in docs:
        w.add(d, ids)
    w.close()
    f = C.FileReader(pa.OSFile(str(tmp_path / "f.dac")))
    whole = np.concatenate([x for _, x in docs])
    assert f.n == len(whole) and all(f.token(int(i)) == whole[i] for i in r.integers(0, len(whole), 300))
    back = [(d, np.concatenate(p) if p else np.zeros(0)) for d, _, p in f.documents()]
    assert [d for d, _ in back] == [d for d, _ in docs]
    assert all((a == b).all() for (_, a), (_, b) in zip(back, docs))


def test_codes_query(odd, none):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(WORDS)
    got = C.encode_roundtrip(odd, WORDS).collect()
    rows = sorted(odd_rows(), key=lambda r: (r[0] is not None, r[0] or 0))
    start, want = 0, []
    for d, t, *_ in rows:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 2]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(((r[0] is not None, *r[1:]) for r in got)) == sorted((d is not None, *x) for d, *x in want)
    assert C.encode_roundtrip(none, WORDS).count() == 0


def fuzz(n):
    r = random.Random(3)
    alpha = [*" \n\t\r▁.,|!<>/s'abcAB12²éÉßıİΣς́ 　日🙂ﬁ_-x", "<s>", "</s>", "<|endoftext|>",
             "<|ENDOFTEXT|>", "the", "'re", "'S", "  ", "\n\n", "\x0b", "\x1c"]
    return ["".join(r.choice(alpha) for _ in range(r.randint(0, 14))) for _ in range(n)]


def test_word_memo_is_exact():
    from tokenizers import Tokenizer
    tok, enc = Tokenizer.from_file(WORDS), C.WordEncoder(WORDS)
    texts = fuzz(3000)
    for t, raw in zip(texts, enc.encode(texts), strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids, t


def test_pre_token_counts_are_exact():
    m = T.PieceCounter(PIECES)
    for t in fuzz(3000):
        assert sum(m.count(m.split(t))) == len(m.sp.encode(t)), t


@pytest.mark.parametrize("frequent", [0, 20, 400_000])
def test_counts_query(odd, none, frequent):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    key = lambda r: tuple(-1 if x is None else x for x in r)
    want = [(r[0], len((r[1] or "").encode()), len(sp.encode(r[1] or ""))) for r in odd_rows()]
    got = T.count_tokens(odd, PIECES, limit=50, frequent=frequent).collect()
    assert sorted((tuple(r)[:3] for r in got), key=key) == sorted(want, key=key)
    assert all(r["over_limit"] == (r["n_tokens"] > 50) for r in got)
    if frequent == 20:
        assert T.count_tokens(none, PIECES).count() == 0
