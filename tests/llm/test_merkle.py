import random
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import pytest

from ledgerlark.llm import merkle as M

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf int, tree string, `a b` int"


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(levels):
    """Levels of a tree from its leaves, and the siblings of each leaf."""
    out = [levels]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i:i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def sibs(levels, i):
    out = []
    for lev in levels[:-1]:
        first = i - i % 3
        out.append((lev[first:i], lev[i + 1:first + 3]))
        i //= 3
    return out


def brute(rows):
    by = defaultdict(list)
    for r in rows:
        by[r[1]].append((r[0] is not None, r[0] or 0, leaf(r), r))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: climb([x[2] for x in sorted(by[s], key=lambda x: x[:3])]) for s in order}
    top = climb([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for i, (_, _, own, r) in enumerate(sorted(by[s], key=lambda x: x[:3])):
            path = sibs(trees[s], i) + sibs(top, k)
            hit = r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            got = leaf((*r[:4], r[4].replace("\n", ""))) if hit else own
            for a, b in path:
                got = H(*a, got, *b)
            out.append((r[0], own, trees[s][-1][0], top[-1][0], H(*(x for a, b in path for x in a + b)), got,
                        got == top[-1][0]))
    return Counter(out)


def rows_of(sizes, seed=0):
    rnd = random.Random(seed)
    out, n = [], 0
    for s, size in sizes.items():
        for _ in range(size):
            out.append((n, s, rnd.choice(["en", None]), rnd.randrange(9), rnd.choice(["a\nb", "a", f"é{n}\n", "", None])))
            n += 1
    rnd.shuffle(out)
    return out


def check(spark, rows):
    df = spark.createDataFrame([(*r, 7, "x", 1) for r in rows], SCHEMA)
    got = M.manifest(df)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert Counter(tuple(r) for r in got.collect()) == brute(rows)


@pytest.mark.parametrize("sizes", [
    {"a": 1}, {"a": 81, None: 82, "é": 3, "B": 4, "b": 1},
    {"hot": 6562, None: 1} | {f"s{i}": 1 + i % 4 for i in range(90)}])
def test_against_brute_force(spark, sizes):
    check(spark, rows_of(sizes))


def test_repeated_rows_null_ids_and_long_texts(spark):
    long = "line of text\n" * 20_000
    rows = [(1, "a", "en", 3, long)] * 5 + [(None, "a", None, None, None)] * 4 + [(1, "a", "en", 3, "x")] * 3
    rows += [(2, "", "", 0, ""), (3, None, None, None, "\n"), (10 ** 12, None, "en", -5, "b\n\nc")]
    check(spark, rows)


def test_stored_paths_of_large_trees(spark, monkeypatch):
    """Small groups, so that steps above the block level are met."""
    monkeypatch.setattr(M, "LEVELS", 1)
    monkeypatch.setattr(M, "GROUP", 3)
    monkeypatch.setattr(M, "BLOCK", 9)
    check(spark, rows_of({"hot": 500, "x": 27, "y": 28, "z": 1, None: 10}, 1))


def test_empty(spark):
    assert M.manifest(spark.createDataFrame([], SCHEMA)).count() == 0
