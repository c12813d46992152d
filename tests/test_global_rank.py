"""Ranks over a whole table against pandas, with ties over many partitions."""
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import cleaning, global_rank, kpi, quality, stats


def table(n=500):
    rng = random.Random(11)
    return [(i, None if i % 41 == 0 else float(rng.choice([1, 1, 1, 2, 3, i, -i, 0.5])),
             float(rng.randint(0, 40))) for i in range(n)]


@pytest.mark.parametrize("partitions", [1, 7])
def test_average_ranks(spark, partitions):
    rows = table()
    df = spark.createDataFrame(rows, "id long, x double, y double").repartition(partitions)
    got = {r.x: r.rank for r in global_rank.average_ranks(df, "x", "rank").collect()}
    x = pd.Series([r[1] for r in rows]).dropna()
    assert got == dict(zip(x, x.rank()))


def test_descending_keys_number_all_rows(spark):
    df = spark.createDataFrame([(r[2], f"c{r[0]}") for r in table(200)], "v double, c string").repartition(5)
    r = global_rank.key_ranks(df, {"v": F.col("v"), "c": F.col("c")}, descending=("v",)).collect()
    assert [(x.v, x.c) for x in sorted(r, key=lambda x: x.n_before)] == sorted(((x.v, x.c) for x in r), key=lambda p: (-p[0], p[1]))
    assert sorted(x.n_before for x in r) == list(range(200))


def test_spearman_overall(spark):
    rows = table()
    df = spark.createDataFrame(rows, "id long, x double, y double").repartition(6)
    r = stats.spearman_overall(df, "x", "y").first()
    p = pd.DataFrame(rows, columns=["id", "x", "y"]).dropna()
    assert (r.n, r.rho) == (len(p), round(p.x.rank().corr(p.y.rank()), 6))
    constant = stats.spearman_overall(df.withColumn("y", F.lit(1.0)), "x", "y").first()
    assert (constant.n, constant.rho, constant.p_value) == (len(p), None, None)
    assert stats.spearman_overall(df.limit(0), "x", "y").first().n == 0


def test_notes_and_priority(spark):
    signs = {"a": (1, 0), "b": (-1, 1), "c": (0, 1), "d": (0, -1), "e": (0, 0)}
    rows = [("2026-01-%02d" % d, "S1", c, 10.0 * d, d, float(t * d) if t else None, float(w * d) if w else None)
            for c, (t, w) in signs.items() for d in range(1, 9)]
    daily = spark.createDataFrame(rows, "order_date string, store_id string, category string, net_revenue double, "
                                        "units_sold long, temp_max double, precipitation_sum double")
    got = {r.category: r for r in kpi.recommendations(daily).collect()}
    assert {c: r.tag for c, r in got.items()} == {"a": "leans warm", "b": "leans cool", "c": "leans wet",
                                                  "d": "leans dry", "e": "weather-neutral"}
    assert [got[c].priority for c in "abcde"] == [1, 2, 3, 4, 5]
    assert got["a"].note == kpi.NOTE_WARM and got["b"].note == kpi.NOTE_COOL + kpi.NOTE_WET
    assert got["c"].note == "is flat to temperature (r=+0.00). Rain nudges it up slightly too."
    assert got["d"].note.endswith("(r=+0.00). It dips a little in the rain.") and got["e"].note == kpi.NOTE_NEUTRAL


def test_row_digest_parts_rows_only_when_they_differ(spark):
    rows = [("1", None), ("1", ""), ("", "1"), (None, "1"), ("1:-", None), ("1", "-"), ("1", None), ("12", "3"), ("1", "23")]
    df = spark.createDataFrame(rows, "a string, b string")
    got = df.groupBy(quality.row_digest(["a", "b"]).alias("d")).count().collect()
    assert sorted(r["count"] for r in got) == [1] * 7 + [2]


def test_first_row_of_a_key_stays(spark):
    """A hot key, keys with NULLs, single rows: one row a key, the first loaded."""
    key = [("o1", "2026-01-01", "S1", "P1")] * 60 + [("o2", "2026-01-01", None, None)] * 3 + [
        (f"o{i}", "2026-01-01", "S1", "P1") for i in range(3, 9)] + [("o9", None, "S1", "P1")] * 2
    rows = [(100 - i, 100 - i, *k, 1, 1.0, 0.0, 1.0) for i, k in enumerate(key)]
    lines = spark.createDataFrame(rows, "raw_id long, row_uid long, order_id string, order_date string, store_id string, "
                                        "product_key string, quantity long, unit_price double, discount_pct double, "
                                        "line_revenue double").repartition(5)
    got = cleaning.tag_lines(lines).collect()
    assert len(got) == len(rows)
    kept = {r.order_id: r.raw_id for r in got if r.reject_reason is None}
    want = {}
    for raw_id, _, order_id, date, *_ in rows:
        if date:
            want[order_id] = min(raw_id, want.get(order_id, raw_id))
    assert kept == want
    assert sum(r.reject_reason == cleaning.REASON_DUPLICATE for r in got) == 61
    assert sum(r.reject_reason == cleaning.REASON_BAD_DATE for r in got) == 2
