"""Lines move once for their catalogs, and not for the store-days."""

import re

from pyspark.sql import functions as F

from ledgerlark.operators import daily, kpi

LINE = ("order_date string, store_id string, product_key string, legacy_product_id string, quantity long, unit_price double, "
        "discount_pct double, sales_channel string, line_revenue double")
OLD = "product_id string, product_name string, category string, catalog_pos long"
NEW = "new_product_id string, item_name string, department string, catalog_pos long"
DAILY = "order_date string, store_id string, category string, precipitation_sum double"


def frames(spark):
    keys = [("NP1", "P1"), ("NP2", "P1"), ("NP3", "P2"), ("P1", "P1"), ("NP9", None), ("NP1", None), (None, None), ("X", "P7"), (None, "P2")]
    lines = spark.createDataFrame([("2026-01-01", "S001", k, l, 2, 5.0, 0.0, "pickup", 10.0) for k, l in keys], LINE)
    old = spark.createDataFrame([("P1", "old one", "camping", 1), ("P2", "old two", "patio", 2)], OLD)
    new = spark.createDataFrame([("NP1", "new one", "Outdoor", 1), ("NP2", None, "Garden", 2), ("NP3", "new three", None, 3)], NEW)
    days = spark.createDataFrame([("2026-01-01", "S001", "a", 1.5), ("2026-01-01", "S001", "b", 0.5)], DAILY)
    return lines, old, new, days


def test_lines_that_the_first_catalog_names_only_in_part(spark):
    lines, old, new, days = frames(spark)
    cats = {(r.product_key, r.legacy_product_id): (r.category, r.category_source) for r in daily.resolve_category(lines, new, old).collect()}
    assert cats[("NP3", "P2")] == (None, "new_system") and cats[("P1", "P1")][1] == "legacy_recovered"
    for few in (False, True):
        got = kpi.enriched_lines(lines, new, old, days, few_days=few)
        names = {(r.product_key, r.legacy_product_id): (r.product_name, r.category) for r in got.collect()}
        assert names[("NP2", "P1")] == ("old one", "Garden")
        assert names[("NP3", "P2")][0] == "new three" and names[("NP3", "P2")][1] == names[(None, "P2")][1] != "UNKNOWN"
        assert names[("NP9", None)] == ("NP9", "UNKNOWN") and names[(None, None)] == (None, "UNKNOWN")
        assert got.count() == lines.count() and {r.precipitation_sum for r in got.collect()} == {1.5}
        assert got.columns[-3:] == ["gross_revenue", "discount_given", "precipitation_sum"]


def test_lines_move_once(spark):
    """No join but the first reads all lines with a legacy id: what it moved is read again."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k) for k in keys}
    _, old, new, _ = frames(spark)
    lines = spark.range(5000).select(
        F.lit("2026-01-01").alias("order_date"), F.lit("S001").alias("store_id"), F.concat(F.lit("NP"), F.col("id")).alias("product_key"),
        F.concat(F.lit("P"), F.col("id")).alias("legacy_product_id"), F.lit(2).cast("long").alias("quantity"), F.lit(5.0).alias("unit_price"),
        F.lit(0.0).alias("discount_pct"), F.lit("pickup").alias("sales_channel"), F.lit(10.0).alias("line_revenue"))
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        got = daily.resolve_category(lines, new, old)
        got.write.format("noop").mode("overwrite").save()
        got.collect()
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "ReusedExchange" in plan[:plan.index("Initial Plan")], plan
    assert re.search("SortMergeJoin", plan)


def test_store_days_are_counted_before_a_broadcast(spark, monkeypatch):
    days = frames(spark)[3]
    assert kpi.few_store_days(days)
    monkeypatch.setattr(kpi, "BROADCAST_DAYS", 0)
    assert not kpi.few_store_days(days)
