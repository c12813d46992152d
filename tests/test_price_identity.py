"""List prices are parsed once an item, before the lines meet them."""
from ledgerlark.operators import daily


def test_list_prices_are_parsed_in_the_catalogs(spark):
    lines = spark.createDataFrame(
        [("P1", "P1", 0, 9.0, 10.0), ("P2", "P2", 0, 5.0, None), ("NP1", None, 1, 20.0, 0.0), ("NP1", "P1", 0, 10.0, 0.0),
         ("NP9", None, 1, 1.0, 0.0), ("NP2", None, 1, 1.0, 0.0)],
        "product_key string, legacy_product_id string, is_new_system int, unit_price double, discount_pct double")
    old = spark.createDataFrame([("P1", "10.00", 1), ("P2", "$5", 1), ("P2", " 5.00 ", 2)],
                                "product_id string, base_price string, catalog_pos long")
    new = spark.createDataFrame([("NP1", "20", 1), ("NP2", "$1", 1)], "new_product_id string, msrp string, catalog_pos long")
    df = daily.price_identity(lines, old, new)
    assert sorted(map(tuple, df.collect())) == [(0, 3, 0, 3, 0), (1, 3, 2, 1, 0)]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") == 3          # the new catalog stands on both sides of the union by legacy id
