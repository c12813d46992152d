import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ledgerlark.llm import decontaminate as D

from .conftest import LONG

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOC = "doc_id long, text string, n_words int, row long, ctx string"
ITEM = "item_id long, text string, h int, n int"


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    windows = {}
    for i, t in items:
        w = words(t)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k:k + n]), set()).add(i)
    sizes = {len(x) for x in windows}
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                got = windows.get(tuple(w[k:k + n]))
                if got:
                    hit |= set(range(k, k + n))
                    found |= got
        named = sorted(str(x) for x in found if x is not None)
        out.append((d, len(w), len(hit), len(named), tuple(named), bool(hit)))
    return Counter(out)


def check(spark, docs, items, **options):
    got = D.contamination(spark.createDataFrame([(*r, 1, 2, "x") for r in docs], DOC).repartition(3),
                          spark.createDataFrame([(*r, 1, 2) for r in items], ITEM), **options).collect()
    want = brute(docs, items)
    assert Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, tuple(r["items"]), r.contaminated) for r in got) == want
    return want


def test_against_brute_force(spark):
    rnd = random.Random(3)
    vocabulary = [f"w{i}" for i in range(12)] + ["é", "日本", "Foo", "x1"]
    draw = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    items = [(i, draw(rnd.choice([10, 11, 25, 60]))) for i in range(30)] + [(100 + i, draw(i)) for i in range(2, 10)]
    items += [(7, draw(30)), (7, items[3][1]), (None, draw(14)), (200, items[0][1]), (201, ""), (202, None), (203, " ,.;")]
    docs = []
    for i in range(250):
        text = draw(rnd.randrange(120))
        for _ in range(rnd.randrange(3)):
            w = rnd.choice(items[:40])[1] .split() if rnd.random() < .8 else []
            a = rnd.randrange(max(1, len(w)))
            text += rnd.choice([" ", ", ", "\n", "--"]) + " ".join(w[a:a + rnd.choice([9, 10, 30])]).upper() + " " + draw(5)
        docs.append((i, text))
    docs += [(0, docs[0][1]), (3, docs[3][1]), (3, "other"), (None, items[0][1]), (900, None), (901, ""), (902, "!? \x7f_"),
             (903, items[3][1])] + [(1000 + i, "so " + items[2][1] + f" end{i}") for i in range(60)]
    want = check(spark, docs, items)
    assert sum(1 for r in want if r[2]) > 60 and sum(1 for r in want if not r[2]) > 10


def test_repeating_words_long_texts_and_other_windows(spark):
    items = [(1, "la " * 40), (2, "la " * 9), (3, "ho he " * 12), (4, " ".join(words(LONG)[5_000:5_012]))]
    docs = [(1, "la " * 500), (2, "la la la"), (3, "he ho " * 30 + "la " * 10), (4, LONG), (5, "la-" * 9 + "x"), (6, "a" * 300_000)]
    check(spark, docs, items)


def test_full_filter_only_lets_more_pass(spark, monkeypatch):
    monkeypatch.setattr(D, "FILTER_BITS", 64)
    items = [(i, " ".join(f"k{i}x{j}" for j in range(30))) for i in range(40)]
    docs = [(i, "intro words here " + items[i % 40][1] + " outro") for i in range(80)] + [(99, "nothing of the kind " * 20)]
    keep = D.Filter(np.full(1, np.iinfo(np.uint64).max, np.uint64))
    assert keep(np.arange(100, dtype=np.uint64) * np.uint64(977)).all()
    check(spark, docs, items)


def test_empty_tables(spark):
    docs, items = [(1, "some text of a few words"), (None, None)], [(1, "some text of a few words and some more to fill it")]
    check(spark, docs, [])
    check(spark, [], items)


@pytest.mark.parametrize("seed", range(3))
def test_every_shared_window_keeps_one_fingerprint_on_both_sides(seed):
    rnd = random.Random(seed)
    shared = [rnd.choice("ab cd ef".split()) for _ in range(10)]
    side = lambda: " ".join([rnd.choice("ab cd ef gh".split()) for _ in range(rnd.randrange(9))] + shared + ["gh", "ab"])
    got = [{x[1] for x in D.marks(pa.array([side().encode()]), lambda h: np.ones(len(h), bool), [], 10, 5)[2]} for _ in range(20)]
    assert all(a & b for a in got for b in got)
