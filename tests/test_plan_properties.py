"""Plan-shape guards over every registered query of the feed library (on the smallest tables):
no nested-loop / cartesian joins, and Python UDF evaluation only where a
tail probability is computed on already-aggregated rows."""
import re

from ledgerlark.plans import queries as registered

SF = "/root/testdata/sf0.001"
# queries whose plans may evaluate an Arrow UDF (p-values on one row per test;
# the edit distance and best window of blocked pairs)
UDF_OK = {"edit_similarity", "best_window_similarity", "channel_shift_z", "share_vs_median", "spearman_by_store",
          "significance_screen", "significance_screen_signal"}


def test_plan_shapes(spark):
    bad = []
    for name, fn in registered.queries().items():
        plan = fn(spark, SF)._jdf.queryExecution().executedPlan().toString()
        if re.search(r"BroadcastNestedLoopJoin|CartesianProduct", plan):
            bad.append((name, "nested-loop/cartesian join"))
        if re.search(r"(ArrowEvalPython|BatchEvalPython)", plan) and name not in UDF_OK:
            bad.append((name, "python udf"))
    assert bad == []


def test_amounts_are_parsed_once(spark):
    """A row's amounts are matched once each, and the filters of tagging read them parsed."""
    from ledgerlark.operators import cleaning
    from ledgerlark.plans.pipeline import FeedPipeline

    def patterns(df):
        return len(re.findall("RLIKE", df._jdf.queryExecution().optimizedPlan().toString()))

    p = FeedPipeline(spark, SF)
    assert patterns(cleaning.typed_lines(p.raw, p.crosswalk)) == len(cleaning.AMOUNTS)
    assert patterns(p.lines) == 0 and patterns(cleaning.tag_lines(p.lines)) == 0


def test_equal_digests_of_different_keys(spark, monkeypatch):
    """Keys that share a digest are told apart by the keys themselves."""
    from pyspark.sql import functions as F

    from ledgerlark.operators import cleaning
    monkeypatch.setattr(F, "xxhash64", lambda *c: F.lit(1).cast("long"))
    lines = spark.createDataFrame(
        [(i, i, o, "2026-01-01", None, "P1", 1, 1.0, 0.0, 1.0) for i, o in enumerate("abcabd")],
        "raw_id long, row_uid long, order_id string, order_date string, store_id string, product_key string, "
        "quantity long, unit_price double, discount_pct double, line_revenue double")
    got = {r.raw_id: r.reject_reason for r in cleaning.tag_lines(lines).collect()}
    assert got == dict.fromkeys((0, 1, 2, 5)) | dict.fromkeys((3, 4), cleaning.REASON_DUPLICATE)


def test_feed_copies_are_compiled(spark):
    """The copies of a feed row come from constant arrays: a function over a
    built array is evaluated outside of compiled code."""
    from ledgerlark.plans import adapters
    plan = adapters.feed(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode" in plan and "lambda" not in plan


def test_catalogs_are_spread_and_built_once(spark):
    """The part table is one small file: the catalogs' names are made in as many
    tasks as shuffles have, once."""
    from ledgerlark.plans import adapters
    from ledgerlark.plans.pipeline import FeedPipeline

    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    p = FeedPipeline(spark, SF)
    for made, stored in ((adapters.products(spark, SF), p.products), (adapters.new_products(spark, SF), p.new_products)):
        assert "RepartitionByExpression" in plan(made)
        assert "Project" not in plan(stored)
        assert sorted(map(tuple, made.collect())) == sorted(map(tuple, stored.collect()))
