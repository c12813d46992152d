import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from ledgerlark.llm import lexical_search as S

from .conftest import LONG

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOC = "doc_id long, text string, n_docs int, shard long, item_id long"
ITEM = "item_id long, text string, term int, score int"


def terms(text):
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def brute(docs, items, k=10):
    bags = [(d, Counter(terms(t))) for d, t in docs]
    N, L = sum(1 for _, b in bags if b), sum(sum(b.values()) for _, b in bags)
    out = Counter()
    for i, t in set(items):
        own, scores = set(terms(t)), []
        df = {x: sum(1 for _, b in bags if x in b) for x in own}
        w = {x: math.floor(1000 * math.log((2 * N + 2) / (2 * df[x] + 1))) for x in own}
        for d, b in bags:
            m = 10 + (90 * sum(b.values()) * N) // L if L else 0
            s = sum(w[x] * ((10 ** 9 * b[x]) // (1000 * b[x] + 8 * m)) for x in own if x in b)
            if s > 0:
                scores.append((-s, d is None, d or 0))
        out.update((i, r + 1, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scores)[:k]))
    return out


def check(spark, docs, items, k=10, parts=3):
    got = S.top_k(spark.createDataFrame([(*r, 1, 2, 3) for r in docs], DOC).repartition(parts),
                  spark.createDataFrame([(*r, 1, 2) for r in items], ITEM), k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    want = brute(docs, items, k)
    assert Counter(tuple(r) for r in got.collect()) == want
    return want


def corpus(seed, n):
    rnd = random.Random(seed)
    vocabulary = [f"t{i}" for i in range(60)] + ["é", "Straße", "日本", "ABC", "x9"]
    weights = [1 / (1 + i) for i in range(len(vocabulary))]
    draw = lambda n: " ".join(rnd.choices(vocabulary, weights, k=n))
    docs = [(i, draw(rnd.randrange(80)) + rnd.choice(["", ".", "\n"])) for i in range(n)]
    items = [(i, draw(rnd.choice([1, 3, 12, 40]))) for i in range(25)]
    return docs, items


def test_against_brute_force(spark):
    docs, items = corpus(1, 300)
    docs += [(5, docs[5][1]), (6, "other t1"), (None, docs[9][1]), (800, None), (801, ""), (802, "!?_-")]
    docs += [(900 + i, docs[7][1]) for i in range(40)]                                    # ties beyond k
    items += [(3, items[3][1]), (3, "t1 t2"), (None, "t5"), (100, None), (101, ""), (102, "nowhere met"), (103, "T1 t1,T1")]
    check(spark, docs, items)


def test_wide_items_long_texts_and_small_blocks(spark, monkeypatch):
    """More terms than a word of bits; several blocks, shards and batches."""
    monkeypatch.setattr(S, "BLOCK", 4)
    monkeypatch.setattr(S, "BATCH", 3)
    docs, items = corpus(2, 120)
    wide = " ".join(terms(LONG)[:400])
    rnd = random.Random(5)
    pieces = wide.split()
    docs += [(500 + i, " ".join(rnd.choices(pieces, k=90))) for i in range(60)] + [(700, LONG)]
    check(spark, docs, items + [(200, wide), (201, " ".join(pieces[:64])), (202, " ".join(pieces[:65]))], 7, 8)


def test_empty_tables(spark):
    docs, items = corpus(3, 5)
    check(spark, docs, [])
    check(spark, [], items)
    check(spark, [(1, ""), (2, None)], items)


@pytest.mark.parametrize("seed", range(3))
def test_masks_and_bounds(seed):
    rnd = np.random.default_rng(seed)
    n, terms_n = 90, 130
    held = rnd.random((terms_n, n)) < rnd.random((terms_n, 1))
    held[:, 0] = False
    held[:, 1] = True
    t, d = np.nonzero(held)
    counts = rnd.integers(1, 9, len(t))
    row = {"n_docs": n, "ids": np.arange(n, dtype="<i8").tobytes(), "known": np.ones(n, "u1").tobytes(),
           "sizes": np.full(n, 500, "<i8").tobytes(), "terms": [b"%d" % i for i in range(terms_n)],
           "ends": np.cumsum(held.sum(axis=1)).astype("<i8").tobytes(), "docs": d.astype("<u2").tobytes(),
           "counts": counts.astype("<u4").tobytes()}
    shard = S.Shard(row, n, 500 * n)
    pick = np.sort(rnd.permutation(terms_n)[:100])
    has, group = shard.masks(pick)
    assert (has[group] == held[pick].T).all() and len({x.tobytes() for x in has}) == len(has)
    gain = np.zeros((terms_n, n), np.int64)
    gain[t, d] = shard.gain
    w = rnd.integers(0, 50, len(pick))
    assert ((has @ (w * shard.most[pick]))[group] >= w @ gain[pick]).all()
