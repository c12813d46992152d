"""Lines are summed once; it is the store-days that are repeated for each threshold."""
from ledgerlark.operators import kpi


def test_store_days_are_repeated_not_lines(spark):
    rows = [("d1", "S1", 10.0, 0.0), ("d1", "S1", 5.0, 2.0), ("d2", "S1", 3.0, 0.5), ("d2", "S2", 8.0, None), ("d3", "S2", 4.0, 1.0),
            ("d3", None, 6.0, 9.0), (None, "S2", 2.0, 0.0), ("d4", "S2", None, 0.0)]
    lines = spark.createDataFrame(rows, "order_date string, store_id string, net_revenue double, precipitation_sum double")
    df = kpi.rain_lift_mean(lines, (1.0, 10.0))
    # rain days of 1 mm: S1 d1 15, S2 d3 4, none d3 6; dry: S1 d2 3, S2 none 2 (S2 d4 sums to NULL)
    assert sorted(map(tuple, df.collect())) == [(1.0, round((25 / 3 / 2.5 - 1) * 100, 4), 2, 3), (10.0, None, None, 3)]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" in plan and "Aggregate [order_date" in plan.split("Generate")[1]
