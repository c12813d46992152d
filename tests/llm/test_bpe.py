import hashlib
import random

import public_tokenizers as P
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from ledgerlark.llm import bpe

from .conftest import ODD

PATH = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def test_odd_rows(spark, odd, empty, library):
    got = sorted((r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256)
                 for r in bpe.digests(odd, PATH).collect())
    want = []
    for r in ODD:
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        want.append((r[0] or 0, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == sorted(want)
    assert bpe.encode(empty, PATH).count() == 0 and bpe.digests(empty, PATH).count() == 0
    ids = {r.doc_id: r.ids for r in bpe.encode(odd, PATH).collect()}
    assert ids == {r[0]: library.encode(r[1] or "", add_special_tokens=False).ids for r in ODD}


def test_random_texts(library):
    rnd = random.Random(3)
    parts = ["a", "e", "t", " ", " ", "th", "ing", "\n", "1", "..", "é", "日", "'s", "--", "=", "  ", "heses", "\t", "　",
             "\x00", "<|endoftext|>", "<|endof", "\r\n", "\x85"]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(1, 60))) for _ in range(3000)]
    texts += ["".join(chr(rnd.randint(32, 0x2FFF)) for _ in range(40)) for _ in range(300)]
    texts += ["aaaaaaaaaaaaaaaaaaaaaaa", "=" * 300, " " * 200, "x<|endoftext|><|endoftext|> y", "", " ", "\n", "a \n", "\n\n\n"]
    enc = bpe.Encoder(PATH)
    got = enc.encode(pa.array(texts))
    for text, ids in zip(texts, got):
        assert ids.as_py() == library.encode(text, add_special_tokens=False).ids
    assert enc.decode(got).to_pylist() == texts


def test_decode(spark):
    df = spark.createDataFrame([(1, [50256, 0, 99999, -1]), (2, None), (3, []), (4, [0, 127, 0])], "doc_id long, ids array<int>")
    want = Tokenizer.from_file(PATH).decode([0, 127, 0], skip_special_tokens=False)  # bytes that are no UTF-8
    got = {r.doc_id: r.decoded for r in bpe.decode(df, PATH).collect()}
    assert got == {1: "<|endoftext|>!", 2: "", 3: "", 4: want}


def test_bounded_memory(library):
    """The cache forgets, results stay the same."""
    enc = bpe.Encoder(PATH)
    enc.seen.limit = 50
    rnd = random.Random(1)
    texts = [" ".join("".join(rnd.choices("abcdefgh", k=6)) for _ in range(40)) for _ in range(50)]
    assert [enc.encode(pa.array([t])).to_pylist()[0] for t in texts] == [
        library.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(enc.seen) + len(enc.seen.old) < 400
