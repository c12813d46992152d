import random
import re

import xxhash

from ledgerlark.llm import simhash as S

from .conftest import ODD


def brute_fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_classes(fps, bits):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in fps:
        for b in fps:
            if bin(a ^ b).count("1") <= bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


def test_odd_rows(spark, odd, empty):
    got = sorted((r.doc_id is None, r.doc_id or 0, r.fingerprint, r.component_id) for r in S.near_duplicates(odd).collect())
    fps = {r[1]: brute_fingerprint(r[1]) for r in ODD}
    assert [(a, b, c) for a, b, c, _ in got] == sorted((r[0] is None, r[0] or 0, f"{fps[r[1]]:016x}") for r in ODD)
    by = {}
    for r in ODD:
        if r[0] is not None:
            by[fps[r[1]]] = min(r[0], by.get(fps[r[1]], r[0]))
    assert all(c == by.get(int(f, 16)) for none, _, f, c in got if not none)
    assert S.near_duplicates(empty).count() == 0
    kept = S.one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 5, 6, 7]  # 3, 4 are as empty as 2; 8 is 1


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def check_classes(spark, fps, **how):
    df = spark.createDataFrame([(i, signed(f)) for i, f in enumerate(fps)], "doc_id long, fp long")
    got = {r.fp: r.component_id for r in S.classes(df, **how).collect()}
    roots = brute_classes(sorted(set(fps)), how.get("bits", 2))
    least = {}
    for i, f in enumerate(fps):
        least[roots[f]] = min(i, least.get(roots[f], i))
    assert got == {signed(f): least[roots[f]] for f in set(fps)}


def test_links_and_chains(spark):
    rnd = random.Random(5)
    fps = [rnd.getrandbits(64) for _ in range(30)]
    for f in fps[:12]:  # chains of two flipped bits each, and pairs three bits apart
        g = f
        for _ in range(4):
            a, b = rnd.sample(range(64), 2)
            g ^= 1 << a | 1 << b
            fps.append(g)
        fps.append(f ^ 0b111)
    fps += [0, 1 << 63, 3, (1 << 64) - 1]
    check_classes(spark, fps)
    check_classes(spark, fps, bits=1)
    check_classes(spark, fps, bits=3)


def test_hot_blocks_lose_no_link(spark):
    """Far more nodes under one key than are paired."""
    rnd = random.Random(7)
    base = rnd.getrandbits(64)
    fps = [base ^ (1 << i) for i in range(20)] + [base ^ (x << 40) for x in rnd.sample(range(1 << 12), 60)]
    check_classes(spark, fps, pair_limit=3)
