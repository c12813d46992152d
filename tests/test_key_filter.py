"""Rows of a large frame are found without moving it."""

import re

from pyspark.sql import functions as F

from ledgerlark.operators import cleaning, key_filter
from ledgerlark.plans.pipeline import FeedPipeline
from ledgerlark.session import cut_lineage

SF = "/root/testdata/sf0.001"


def test_every_key_passes_and_few_others(spark, monkeypatch):
    keys = cut_lineage(spark.range(3000).select(F.xxhash64("id").alias("d")), "keys")
    rows = spark.range(30_000)
    passed = rows.where(key_filter.maybe_among(keys)(F.xxhash64("id")))
    assert passed.where("id < 3000").count() == 3000 and passed.count() < 4000
    monkeypatch.setattr(key_filter, "MOST_WORDS", key_filter.LEAST_WORDS)   # too few bits: more pass, none less
    assert rows.where(key_filter.maybe_among(keys)(F.xxhash64("id"))).where("id < 3000").count() == 3000
    none = keys.where("d is null")
    assert rows.where(key_filter.maybe_among(none)(F.xxhash64("id"))).count() == 0


def test_marking_moves_no_rows(spark):
    p = FeedPipeline(spark, SF)
    marked = cleaning.mark_repeated(p.raw, cleaning.typed_lines_apart(p.raw, p.crosswalk))
    plan = marked._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    whole = cleaning.typed_lines(p.raw, p.crosswalk).groupBy(*cleaning.NATURAL_KEY).agg(F.count(F.lit(1)).alias("n"))
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in cleaning.NATURAL_KEY]
    missed = (p.lines.where("not repeated").alias("a").join(
        whole.where("n > 1").alias("b"), same[0] & same[1] & same[2] & same[3], "left_semi"))
    assert missed.count() == 0 and p.lines.where("repeated").count() > 0


def test_only_legacy_lines_move_for_the_crosswalk(spark):
    p = FeedPipeline(spark, SF)
    got, want = cleaning.typed_lines_apart(p.raw, p.crosswalk), cleaning.typed_lines(p.raw, p.crosswalk)
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    union = plan[plan.index("Union"):]
    assert len(re.findall("Join LeftOuter", union)) == 1
