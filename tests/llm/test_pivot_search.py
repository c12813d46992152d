import math
import random

import pytest
from pyspark.sql import functions as F

from ledgerlark.llm import pivot_search as P


def brute(rows, asked, k):
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, v in {(q, tuple(v)) for q, v in good if asked(q)}:
        best = sorted((-sum(a * b for a, b in zip(v, x)), i) for i, x in good if i != q and len(x) == len(v))[:k]
        out |= {(q, v, n + 1, i, -s) for n, (s, i) in enumerate(best)}
    return sorted((q, n, i, s) for q, _, n, i, s in out)


@pytest.mark.parametrize("block,pivots", [(4, 3), (64, 8), (256, 1)])
def test_against_brute_force(spark, block, pivots):
    rnd = random.Random(block)
    centres = [[rnd.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    rows = [(i, [x + rnd.gauss(0, 0.1) for x in rnd.choice(centres)]) for i in range(200)]
    rows += [(200 + i, rows[7][1]) for i in range(12)]                       # ties
    rows += [(10, rows[10][1]), (20, rows[3][1]), (33, rows[33][1])]          # repeated ids, same and other vectors
    rows += [(300, None), (310, []), (320, [1.0, None] + [0.0] * 4), (330, [float("nan")] * 6),
             (340, [float("inf")] * 6), (None, rows[0][1]), (350, [1.0, 2.0]), (351, [2.0, 1.0]), (360, [0.0] * 6)]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows],
                               "vec_id long, embedding array<double>, score int, n int")
    got = P.top_k(P.quantized(df), F.col("vec_id") % 10 == 0, 5, pivots, block)
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got.collect()) == brute(rows, lambda i: i % 10 == 0, 5)


def test_few_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5])], schema)
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in P.top_k(P.quantized(few), F.col("vec_id") == 0).collect()] == [
        (0, 1, 1, 256 * 128)]
    assert P.top_k(P.quantized(spark.createDataFrame([], schema)), F.col("vec_id") == 0).count() == 0


@pytest.mark.parametrize("size", [1e4, 1e6, 4e6, 3e15])
def test_large_components(spark, size):
    """Products beyond the whole numbers of doubles, and sums that could be
    beyond longs."""
    rnd = random.Random(11)
    rows = [(i, [rnd.uniform(-size, size) for _ in range(3)]) for i in range(120)]
    if size > 1e15:
        rows = [(10 * i, [size * rnd.choice([-1, 0, 1]), rnd.uniform(-1e6, 1e6), 0.0]) for i in range(120)] + [(5, [0.0, 1e6, size])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = P.top_k(P.quantized(df), F.col("vec_id") % 10 == 5, 5, 4, 16)
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got.collect()) == brute(rows, lambda i: i % 10 == 5, 5)


def test_beyond_the_long_range_is_an_error(spark):
    for rows in ([(0, [1e30]), (1, [1.0])], [(0, [1e15]), (1, [1e15])]):
        with pytest.raises(Exception, match="long range"):
            P.top_k(P.quantized(spark.createDataFrame(rows, "vec_id long, embedding array<double>")), F.col("vec_id") == 0).collect()


def test_bounds_hold():
    import numpy as np
    rnd = np.random.default_rng(1)
    x, q, p = (rnd.integers(-500, 500, (n, 16)) for n in (300, 20, 8))
    bound = P._bounds(q, P._distances(q, p.astype(float)), x, P._distances(x, p.astype(float)))
    assert (bound >= q @ x.T).all()
