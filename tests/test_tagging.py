"""Lines that are alone with their natural key are tagged as they are read."""

from pyspark.sql import functions as F

from ledgerlark.operators import cleaning
from ledgerlark.plans.pipeline import FeedPipeline

SF = "/root/testdata/sf0.001"
LINE = ("raw_id long, row_uid long, order_id string, order_date string, store_id string, product_key string, "
        "quantity long, unit_price double, discount_pct double, line_revenue double")


def test_all_rows_of_repeated_keys_are_marked(spark):
    keys = ["a", "b", "a", None, "c", None, "d"]
    lines = spark.createDataFrame([(i, i, k, "2026-01-01", None, "P1", 1, 1.0, 0.0, 1.0) for i, k in enumerate(keys)], LINE)
    got = cleaning.mark_repeated(lines).where("repeated").select("row_uid").collect()
    assert sorted(r[0] for r in got) == [0, 2, 3, 5]
    alone = lines.withColumn("repeated", F.col("order_id").isin("a") | F.col("order_id").isNull())
    once, several = cleaning.tag_parts(alone)
    assert not any(x in once._jdf.queryExecution().optimizedPlan().toString() for x in ("Join", "Aggregate"))
    assert sorted((r.row_uid, r.reject_reason) for r in several.collect()) == [
        (0, None), (2, cleaning.REASON_DUPLICATE), (3, None), (5, cleaning.REASON_DUPLICATE)]


def test_typed_lines_are_written_once(spark):
    """Tagged lines are the typed lines' own files, with a small table of the rows of repeated keys."""
    p = FeedPipeline(spark, SF)
    typed = set(p.lines.inputFiles())
    assert typed <= set(p.tagged.inputFiles())
    rest = spark.read.parquet(*(set(p.tagged.inputFiles()) - typed)).count()
    assert rest == p.lines.where("repeated").count() < p.raw.count() / 10
    assert p.tagged.count() == p.raw.count()
