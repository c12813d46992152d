"""Distributed exact median vs numpy / Spark's median, incl. ties, negatives,
a hot value and odd/even group sizes; refinement forced with tiny limits."""
import random

import numpy as np
from pyspark.sql import functions as F

from ledgerlark.operators.quantile import exact_median


def test_exact_median_matches(spark):
    rng = random.Random(7)
    rows = []
    for g in range(6):
        n = [1, 2, 7, 50, 501, 2000][g]
        for i in range(n):
            x = rng.choice([rng.uniform(-1e3, 1e3), round(rng.uniform(0, 5), 1), 3.3])
            rows.append((f"g{g}", x))
    rows += [("hot", 42.0)] * 3000 + [("hot", 1.0)] * 10 + [("hot", None)]
    df = spark.createDataFrame(rows, "k string, x double")
    got = {r.k: r.median for r in exact_median(df, ["k"], "x", buckets=8, max_exact=5).collect()}
    want = {r.k: r.m for r in df.groupBy("k").agg(F.median("x").alias("m")).collect()}
    assert got == want
    for k in want:
        vals = [x for kk, x in rows if kk == k and x is not None]
        assert abs(got[k] - float(np.median(vals))) < 1e-9
