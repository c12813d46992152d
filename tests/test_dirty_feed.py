"""Malformed dates and absurd amounts stop nothing and land in a defined place."""
from pyspark.sql import functions as F

from ledgerlark.functions.numeric import bad_amount, to_double
from ledgerlark.functions.text import calendar_day
from ledgerlark.operators import cleaning, daily, kpi, monitor

LINE = ("raw_id long, row_uid long, order_id string, order_date string, store_id string, product_key string, "
        "legacy_product_id string, is_new_system int, quantity long, unit_price double, discount_pct double, "
        "line_revenue double, sales_channel string, loyalty_member int, source_file string")


def line(i, order="o", day="2026-08-01", price=2.0, quantity=3, discount=0.0):
    return (i, i, order, day, "S1", "NP1", None, 1, quantity, price, discount, price * quantity, "pickup", 1, "f.csv")


def test_calendar_day(spark):
    texts = ["2026-08-01", "2024-02-29", "2026-02-29", "2026-13-45", "12/07/2026", "2026-8-1", "2026", " 2026-08-01", "", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "d string").select(calendar_day(F.col("d")).cast("string")).collect()]
    assert got == ["2026-08-01", "2024-02-29"] + [None] * 8


def test_numbers_beyond_doubles(spark):
    texts = ["1e400", "-1e400", "1e15", "$1e308", "1e-400"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "d string").select(to_double(F.col("d"))).collect()]
    assert got == [None, None, 1e15, 1e308, 0.0]


def test_week_over_week(spark):
    rows = [("2026-08-08", 10.0, 1), ("2026-08-01", 4.0, 2), ("12/07/2026", 99.0, 9), (None, 5.0, 1), ("2026-99-99", 1.0, 1)]
    d = spark.createDataFrame(rows, "order_date string, net_revenue double, units_sold long")
    r = kpi.week_over_week(d).first()
    assert (r.last_day, r.net_last_day, r.net_week_before, r.units_week_before) == ("2026-08-08", 10.0, 4.0, 2)
    assert kpi.week_over_week(d.where("order_date LIKE '%/%'")).first().last_day is None


def test_impossible_file_dates(spark):
    log = spark.createDataFrame([("2026-08-01", "a"), ("2026-13-45", "a"), ("2026-08-03", "b"), ("2026-08-04", "b"), (None, "b")],
                                "source_date_expected string, file_hash string")
    assert [r.missing_date for r in monitor.missing_days(log).collect()] == ["2026-08-02"]
    assert [(r.date, r.previous_date) for r in monitor.republished(log).collect()] == [("2026-08-04", "2026-08-03")]
    assert monitor.missing_days(log.where("source_date_expected LIKE '%13%'")).count() == 0


def test_absurd_amounts_are_quarantined(spark):
    rows = [line(1, "a"), line(2, "b", price=1e30), line(3, "c", price=1e15), line(4, "d", quantity=10 ** 15),
            line(5, "e", discount=1e20), line(6, "f", discount=99.9999999), line(7, "g", discount=100.0),
            line(8, "b", price=5.0), line(9, "h", day=None, price=1e30), line(10, "a"), line(11, "i", price=9e14, quantity=1)]
    tagged = cleaning.tag_lines(spark.createDataFrame(rows, LINE))
    got = {r.raw_id: r.reject_reason for r in tagged.collect()}
    absurd = dict.fromkeys((2, 3, 4, 5, 6), cleaning.REASON_AMOUNT)
    assert got == absurd | dict.fromkeys((1, 7, 8, 11)) | {9: cleaning.REASON_BAD_DATE, 10: cleaning.REASON_DUPLICATE}
    total = daily.daily_sales(cleaning.clean_orders(tagged), None, None).first()
    assert total.net_revenue == 6 + 6 + 15 + 9e14
    assert cleaning.rejected_rows(tagged).where("reason = 'amount_out_of_range'").count() == 5


def test_bad_amount_is_never_null(spark):
    got = spark.sql("SELECT CAST(NULL AS DOUBLE) AS p").select(bad_amount(F.col("p"), F.col("p"), F.col("p"))).first()[0]
    assert got is False
