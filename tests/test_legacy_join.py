"""Lines without a legacy id stay out of the join by legacy id."""

import re

from ledgerlark.operators import daily

LINE = "legacy_product_id string, product_key string"
OLD = "product_id string, category string, catalog_pos long"
NEW = "new_product_id string, department string, catalog_pos long"


def test_lines_without_legacy_id_skip_the_join(spark):
    lines = spark.createDataFrame([("P1", "P1"), ("P1", "NP1"), (None, "NP1"), (None, "X"), ("P9", "P9"), (None, None)], LINE)
    old = spark.createDataFrame([("P1", "camping", 1), ("P1", "patio", 2), (None, "patio", 3)], OLD)
    new = spark.createDataFrame([("NP1", "footwear", 1)], NEW)
    got = daily.resolve_category(lines, new, old)
    assert sorted(tuple(r["product_key"] or "" for r in [r]) + (r.category, r.category_source) for r in got.collect()) == [
        ("", "UNKNOWN", "unknown"), ("NP1", "footwear", "new_system"), ("NP1", "footwear", "new_system"),
        ("P1", "patio", "legacy_recovered"), ("P9", "UNKNOWN", "unknown"), ("X", "UNKNOWN", "unknown")]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"isnotnull\(legacy_product_id", plan) and re.search(r"isnull\(legacy_product_id", plan)
