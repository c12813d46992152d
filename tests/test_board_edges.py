"""Edge semantics of the F / G operators on hand-made frames (cases the
adapter data never produces): zero gross, empty selections, a missing week
before, units with zero net, a duplicated grain key, NULL discounts."""
from pyspark.sql import functions as F

from ledgerlark.operators import daily, kpi

DAILY = ("order_date string, store_id string, category string, category_source string, units_sold long, "
         "net_revenue double, gross_revenue double, discount_given double, temp_max double, temp_min double, "
         "precipitation_sum double, weather_code int")


def test_kpi_and_week_over_week(spark):
    d = spark.createDataFrame([
        ("2026-07-01", "S001", "camping", "new_system", 2, 10.0, 12.0, 2.0, 30.0, 20.0, 0.0, 1),
        ("2026-07-08", "S001", "camping", "new_system", 3, 30.0, 30.0, 0.0, 31.0, 21.0, 2.0, 1),
        ("2026-07-09", "S002", "patio", "new_system", 4, 0.0, 0.0, 0.0, 29.0, 19.0, 1.0, 2),
    ], DAILY)
    lines = spark.createDataFrame([("x",)] * 4, "order_date string")
    k = kpi.kpi_totals(d, lines).first()
    assert (k.net_revenue, k.gross_revenue, k.units_sold, k.order_lines) == (40.0, 42.0, 9, 4)
    assert k.avg_order_value == 10.0 and k.kept_pct == round(40 / 42 * 100, 4)
    empty = kpi.kpi_totals(d.limit(0), lines.limit(0)).first()
    assert (empty.net_revenue, empty.kept_pct, empty.avg_order_value, empty.order_lines) == (0.0, 0.0, 0.0, 0)
    w = kpi.week_over_week(d).first()
    # last day 07-09 has no day 7 earlier -> 0; 07-08 vs 07-01 is not the last day
    assert (w.last_day, w.week_before, w.net_last_day, w.net_week_before, w.units_week_before) == \
        ("2026-07-09", "2026-07-02", 0.0, 0.0, 0)
    a = [r.order_date for r in daily.anomaly_days(d).collect()]
    assert a == ["2026-07-09"]                       # units sold but zero net
    lbl = kpi.window_label(d).first()
    assert (lbl.first_day, lbl.last_day, lbl.n_days) == ("2026-07-01", "2026-07-09", 3)


def test_grain_and_reconcile(spark):
    d = spark.createDataFrame([
        ("2026-07-01", "S001", "camping", "new_system", 1, 5.0, 5.0, 0.0, None, None, None, None),
        ("2026-07-01", "S001", "camping", "new_system", 1, 5.0, 5.0, 0.0, None, None, None, None),
        (None, "S001", "camping", "new_system", 1, 1.0, 1.0, 0.0, None, None, None, None),
    ], DAILY)
    g = daily.grain_check(d).first()
    assert (g.n_rows, g.n_keys, g.grain_unique) == (3, 2, 0)
    clean = spark.createDataFrame([(5.0,), (5.0,), (1.02,)], "line_revenue double")
    r = daily.reconcile(d, clean).first()
    assert (r.daily_net, r.clean_net, r.reconciles) == (11.0, 11.02, 0)
    cov = daily.weather_coverage(d).first()
    assert (cov.n_rows, cov.n_with_weather, cov.coverage) == (3, 0, 0.0)


def test_daily_rollup_semantics(spark):
    clean = spark.createDataFrame([
        ("2026-07-01", "S001", "NP1", None, 2, 10.0, None, 20.0),     # NULL discount -> 0
        ("2026-07-01", "S001", "NP1", None, None, 10.0, 10.0, None),  # NULL quantity -> NULL money
        ("2026-07-01", "S001", "P9", "P9", 1, 5.0, 100.0, 5.0),       # 100% discount -> denominator 1
    ], "order_date string, store_id string, product_key string, legacy_product_id string, quantity long, "
       "unit_price double, discount_pct double, line_revenue double")
    new = spark.createDataFrame([("NP1", "camping", 1)], "new_product_id string, department string, catalog_pos long")
    legacy = spark.createDataFrame([("P9", "Hydration", 9)], "product_id string, category string, catalog_pos long")
    out = {(r.category, r.category_source): r for r in daily.daily_sales(clean, new, legacy).collect()}
    cam = out[("camping", "new_system")]
    assert (cam.units_sold, cam.net_revenue, cam.gross_revenue, cam.discount_given) == (2, 20.0, 20.0, 0.0)
    hyd = out[("drinkware", "legacy_recovered")]    # lower-cased category through the rename map
    assert (hyd.net_revenue, hyd.gross_revenue) == (5.0, 5.0)
    assert hyd.temp_max is None                     # no weather table -> NULL columns
