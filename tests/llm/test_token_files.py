import heapq
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers as P
from tokenizers import Tokenizer

from ledgerlark.llm import token_files as T

from .conftest import ODD

PATH = P.path("word_bpe_49k.json")


def plain_cost(n):
    heap, cost = list(n), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        x = heapq.heappop(heap) + heapq.heappop(heap)
        cost += x
        heapq.heappush(heap, x)
    return cost


def test_code_lengths():
    rnd = random.Random(2)
    for size in (2, 3, 10, 500):
        n = np.array([rnd.randint(1, 10 ** rnd.randint(0, 6)) for _ in range(size)])
        bits = T.code_lengths(n, 60)
        assert sum(2.0 ** -b for b in bits.tolist()) == 1
        assert int((n * bits).sum()) == plain_cost(n.tolist())      # as good as plain Huffman
        tight = T.code_lengths(n, max(1, int(np.ceil(np.log2(size)))))
        assert tight.max() <= max(1, int(np.ceil(np.log2(size)))) and sum(2.0 ** -b for b in tight.tolist()) <= 1
    fib = [1, 1]
    while len(fib) < 40:
        fib.append(fib[-1] + fib[-2])
    assert T.code_lengths(np.array(fib), 12).max() == 12
    assert T.code_lengths(np.array([5])).tolist() == [1] and T.code_lengths(np.array([], int)).tolist() == []


def test_round_trip():
    rnd = np.random.default_rng(0)
    ids = np.unique(rnd.integers(0, 50_000, 3_000))
    code = T.Code(ids, T.code_lengths(rnd.integers(1, 1_000_000, len(ids)), 14))
    for n in (0, 1, 255, 256, 257, 5_000):
        x = rnd.choice(ids, n).astype(np.uint32)
        data, marks = code.pack(x)
        assert (code.unpack(data, marks, n) == x).all()


def test_odd_rows(spark, odd, empty, tmp):
    lib = Tokenizer.from_file(PATH)
    rows = sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0))
    path = T.write_documents(odd, PATH, f"{tmp}/odd")
    got = sorted(T.read(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [r[0] for r in rows]
    at = 0
    for r, row in zip(got, rows):
        ids = lib.encode(row[1] or "", add_special_tokens=False).ids + [1]
        assert (r.start, r.n_tokens) == (at, len(ids))
        assert zlib.crc32(bytes(r.ids)) == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    assert T.read(spark, T.write_documents(empty, PATH, f"{tmp}/empty")).count() == 0


def test_small_blocks_and_order(spark, tmp):
    docs = spark.createDataFrame([(i, f"text number {i} " * (i % 7)) for i in range(300, 0, -1)], "doc_id long, text string")
    T.write(T.encoded(docs, PATH), f"{tmp}/files", block_tokens=64)
    got = sorted(T.read(spark, f"{tmp}/files").collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == list(range(1, 301))
    assert all(b.start == a.start + a.n_tokens for a, b in zip(got, got[1:]))
    # files ascend by document
    blocks = sorted(spark.read.parquet(f"{tmp}/files/blocks").collect(), key=lambda r: (r.part, r.piece, r.start))
    assert [d for b in blocks for d in b.doc_ids] == list(range(1, 301)) and len(blocks) > 10


def test_words_as_the_library_has_them():
    """Spellings that share an entry, special tokens and odd characters."""
    lib, words, rnd = Tokenizer.from_file(PATH), T.WordIds(PATH), random.Random(3)
    assert words.plain and words.spelling
    parts = ["a", "E", "t", " ", "th", "ing", "\n", "1", "..", ".", ",", "é", "É", "日", "'s", "'S", "--", "  ", "\t", "　",
             "?", ")", "<|", "|>", "<|endoftext|>", "<|ENDOFTEXT|>", "\x01", "σ", "Σ", "İ", "K", "\u0301", "ß", "÷", "\x0b",
             "\x1c", "\x85"]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 60))) for _ in range(4000)] + ["", " "]
    ids, ends = words.encode(pa.array(texts))
    for text, a, b in zip(texts, [0, *ends], ends):
        assert ids[a:b].tolist() == lib.encode(text, add_special_tokens=False).ids
