"""Amounts are read once each: a plain text isn't trimmed, nothing is matched or cast twice."""
import re

from pyspark.sql import functions as F

from ledgerlark.functions import numeric
from ledgerlark.operators import cleaning, daily

RAW = "order_date string, quantity string, unit_price string, discount_pct string"


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_plain_texts_are_as_if_trimmed(spark):
    texts = [None, "", " ", "7", "72.70", "$72.70", "$ 72.70", "72.70 $", "1,234.5", "1$", ",1", "1,", " 7", "7 ", "\t7\r\n",
             "7\n", "\n7", "7\u0085", " 7", "7　", "é7", "7é", "\x7f7", "7\x7f", "~7~", "!7!", "\x1f7", "a b", "$", ",",
             "$,$", " $ ", "1e400", "1d", "NaN", "+.5e-3"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    t = F.col("t")
    for got, want in ((numeric.strip_formatting(t), F.trim(F.translate(t, "$,", ""), F.lit(numeric.ALL_SPACES))),
                      (numeric.strip_ws(t), F.trim(t, F.lit(numeric.WHITESPACE)))):
        assert df.where(~got.eqNullSafe(want)).count() == 0
        assert "CASE WHEN" in _plan(df.select(got))
    read = numeric.with_numbers(df, ["t"])
    assert read.where(~F.col("_t").eqNullSafe(numeric.to_double(t))).count() == 0


def test_typed_lines_cast_an_amount_once(spark):
    cols = ["raw_id long", "row_uid long"] + [f"{c} string" for c in cleaning.RAW_COLUMNS]
    raw = spark.createDataFrame([], ", ".join(cols))
    plan = _plan(cleaning.typed_lines(raw).select("quantity", "unit_price", "discount_pct"))
    assert len(re.findall(r"cast\(_\w+#\d+ as double\)", plan)) == len(cleaning.AMOUNTS)


def test_raw_reconcile_matches_an_amount_once(spark):
    raw = spark.createDataFrame([("2026-01-01", "2", "$3.50", "0"), ("2026-01-01", "2.5", "1", "0"), ("2026-01-01", "abc", "1", "0"),
                                 ("2026-01-02", "1", "1e400", "0"), ("2026-01-02", "1", "1e15", "0"), ("", "1", "1", "0"),
                                 (None, "1", "1", "0"), ("2026-01-03", None, None, None)], RAW)
    sales = spark.createDataFrame([("2026-01-01", 6.0), ("2026-01-04", 1.0)], "order_date string, net_revenue double")
    df = daily.raw_reconcile(raw, sales)
    assert len(re.findall("RLIKE", _plan(df))) == 2
    assert sorted(map(tuple, df.collect())) == [
        ("2026-01-01", 3, 7.0, 6.0, 1.0), ("2026-01-02", 2, 0.0, None, 0.0), ("2026-01-03", 1, 0.0, None, 0.0),
        ("2026-01-04", 0, None, 1.0, -1.0)]
