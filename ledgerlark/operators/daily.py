"""clean_orders -> daily_sales and its invariants.

Money is summed as DECIMAL(38,10) so totals do not depend on the order Spark
happens to add partial sums in; results are reported as DOUBLE rounded to
cents (4 dp for per-line ratios).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions.numeric import amount_in_range, to_double, whole, with_numbers
from ledgerlark.operators.crosswalk import department_of

GRAIN = ["order_date", "store_id", "category", "category_source"]
DAILY_COLUMNS = GRAIN + ["units_sold", "net_revenue", "gross_revenue", "discount_given",
                         "temp_max", "temp_min", "precipitation_sum", "weather_code"]
UNKNOWN = "UNKNOWN"


def money_sum(c: Column) -> Column:
    """Order-independent sum of a double money column; 0.0 when all NULL."""
    return F.coalesce(F.sum(c.cast("decimal(38,10)")), F.lit(0).cast("decimal(38,10)"))


def to_cents(c: Column) -> Column:
    return F.round(c, 2).cast("double")


def join_legacy(lines: DataFrame, catalog: DataFrame) -> DataFrame:
    """``lines`` left-joined with one row a ``product_id``. Lines without a legacy
    id match none and stay out: their NULL keys would all meet in one task."""
    has_id = F.col("legacy_product_id").isNotNull()
    met = (lines.where(has_id).join(catalog, F.col("legacy_product_id") == catalog.product_id, "left").drop("product_id"))
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in catalog.schema if f.name != "product_id"]
    return met.unionByName(lines.where(~has_id).select("*", *none))


def join_catalogs(lines: DataFrame, new: DataFrame, legacy: DataFrame, enough: Column) -> DataFrame:
    """``lines`` left-joined with ``new`` by product key, and those of which it tells too
    little (``enough``, never NULL) with ``legacy`` by legacy id; the columns of
    ``legacy`` are NULL in the others. A line moves once for the first join, and few
    for the second."""
    has_id = F.col("legacy_product_id").isNotNull()

    def first(df: DataFrame) -> DataFrame:
        return df.join(new, F.col("product_key") == new.new_product_id, "left").drop("new_product_id")

    met = first(lines.where(has_id))
    # names the line's own id as well: a filter on the catalog's columns alone would
    # change the first join, and both parts are to read the same moved lines
    done = enough | ~has_id
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in legacy.schema if f.name != "product_id"]
    return (first(lines.where(~has_id)).select("*", *none).unionByName(met.where(done).select("*", *none))
            .unionByName(join_legacy(met.where(~done), legacy)))


def resolve_category(clean: DataFrame, new_products: DataFrame | None,
                     products: DataFrame | None, mapping: dict | None = None) -> DataFrame:
    """(category, category_source) per clean line.

    product_key in new catalog -> (department, new_system); else legacy id in
    legacy catalog -> (renamed lower(category) or UNKNOWN, legacy_recovered);
    else (UNKNOWN, unknown). Membership is decided by the join match, not by
    a non-null department.
    """
    df = clean
    nd = lc = None
    in_new = F.col("_in_new").isNotNull()
    if new_products is not None:
        nd = (new_products.groupBy("new_product_id")
              .agg(F.max_by("department", "catalog_pos").alias("_dept"))
              .withColumn("_in_new", F.lit(True)))
    else:
        df = df.withColumn("_dept", F.lit(None).cast("string")).withColumn("_in_new", F.lit(None))
    if products is not None:
        lc = (products.groupBy("product_id")
              .agg(F.max_by("category", "catalog_pos").alias("_cat"))
              .withColumn("_in_legacy", F.lit(True)))
    else:
        df = df.withColumn("_cat", F.lit(None).cast("string")).withColumn("_in_legacy", F.lit(None))
    if nd is not None and lc is not None:
        df = join_catalogs(df, nd, lc, in_new)
    elif nd is not None:
        df = df.join(nd, df.product_key == nd.new_product_id, "left").drop("new_product_id")
    elif lc is not None:
        df = join_legacy(df, lc)
    in_legacy = F.col("_in_legacy").isNotNull()
    cat = (F.when(in_new, F.col("_dept"))
           .when(in_legacy, department_of(F.col("_cat"), mapping, UNKNOWN))
           .otherwise(F.lit(UNKNOWN)))
    src = (F.when(in_new, "new_system").when(in_legacy, "legacy_recovered").otherwise("unknown"))
    return (df.withColumn("category", cat).withColumn("category_source", src)
            .drop("_dept", "_in_new", "_cat", "_in_legacy"))


def line_money(df: DataFrame) -> DataFrame:
    """net = q*p; gross = net / (1 - disc/100) with NULL disc -> 0 and a
    non-positive denominator -> 1; discount = gross - net."""
    q = F.col("quantity").cast("double")
    disc = F.coalesce(F.col("discount_pct"), F.lit(0.0))
    denom = F.lit(1.0) - disc / F.lit(100.0)
    denom = F.when(denom > 0, denom).otherwise(F.lit(1.0))
    net = q * F.col("unit_price")
    gross = net / denom
    return (df.withColumn("_q", q).withColumn("_net", net).withColumn("_gross", gross)
            .withColumn("_disc", gross - net))


def daily_sales(clean: DataFrame, new_products: DataFrame | None, products: DataFrame | None,
                weather: DataFrame | None = None, mapping: dict | None = None) -> DataFrame:
    """Roll up to (order_date, store_id, category, category_source),
    NULL keys kept, then left-join daily weather on (date, store)."""
    lines = line_money(resolve_category(clean, new_products, products, mapping))
    agg = (lines.groupBy(*GRAIN)
           .agg(F.coalesce(F.sum(F.col("quantity")), F.lit(0)).cast("long").alias("units_sold"),
                to_cents(money_sum(F.col("_net"))).alias("net_revenue"),
                to_cents(money_sum(F.col("_gross"))).alias("gross_revenue"),
                to_cents(money_sum(F.col("_disc"))).alias("discount_given")))
    if weather is None:
        return agg.select(*GRAIN, "units_sold", "net_revenue", "gross_revenue", "discount_given",
                          F.lit(None).cast("double").alias("temp_max"),
                          F.lit(None).cast("double").alias("temp_min"),
                          F.lit(None).cast("double").alias("precipitation_sum"),
                          F.lit(None).cast("int").alias("weather_code"))
    w = weather.select(F.col("weather_date").alias("_wd"), F.col("store_id").alias("_ws"),
                       F.col("temperature_2m_max").alias("temp_max"),
                       F.col("temperature_2m_min").alias("temp_min"),
                       "precipitation_sum", F.col("weather_code").cast("int").alias("weather_code"))
    j = agg.join(w, (agg.order_date == w._wd) & (agg.store_id == w._ws), "left")
    return j.select(*DAILY_COLUMNS)


def grain_check(daily: DataFrame) -> DataFrame:
    """rows vs distinct grain keys (NULLs equal) in one aggregation."""
    return daily.agg(F.count(F.lit(1)).alias("n_rows"),
                     F.count_distinct(F.struct(*GRAIN)).alias("n_keys")).withColumn(
        "grain_unique", (F.col("n_rows") == F.col("n_keys")).cast("int"))


def reconcile(daily: DataFrame, clean: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """total daily net vs total clean line_revenue -- one aggregation over
    the union of both inputs (each row feeds one of the two sums)."""
    both = (daily.select(F.col("net_revenue").alias("_d"), F.lit(None).cast("double").alias("_c"))
            .unionByName(clean.select(F.lit(None).cast("double").alias("_d"), F.col("line_revenue").alias("_c"))))
    out = both.agg(F.round(money_sum(F.col("_d")), 2).alias("daily_net"),
                   F.round(money_sum(F.col("_c")), 2).alias("clean_net"))
    return out.select(F.col("daily_net").cast("double").alias("daily_net"),
                      F.col("clean_net").cast("double").alias("clean_net"),
                      (F.abs(F.col("daily_net") - F.col("clean_net")) < tolerance).cast("int")
                      .alias("reconciles"))


def weather_coverage(daily: DataFrame) -> DataFrame:
    """rows with weather / rows."""
    return daily.agg(F.count(F.lit(1)).alias("n_rows"),
                     F.count("temp_max").alias("n_with_weather")).withColumn(
        "coverage", F.round(F.try_divide(F.col("n_with_weather"), F.col("n_rows")), 6))


def raw_reconcile(raw: DataFrame, daily: DataFrame) -> DataFrame:
    """F8: per order_date, net recomputed straight from raw text (D1 parsing
    only, no de-duplication, no catalog) vs daily_sales net. Shows where rows
    or value were lost or duplicated upstream of clean. Amounts out of range
    count as lines, not as money."""
    dated = raw.where(F.col("order_date").isNotNull() & (F.col("order_date") != ""))
    r = with_numbers(dated.select("order_date", "quantity", "unit_price"), ["quantity", "unit_price"])
    r = r.withColumn("_net", whole(F.col("_quantity")).cast("double") * F.col("_unit_price"))
    r = (r.groupBy("order_date")
         .agg(F.count(F.lit(1)).alias("raw_lines"), to_cents(money_sum(amount_in_range(F.col("_net")))).alias("raw_net")))
    d = (daily.groupBy("order_date")
         .agg(F.round(F.sum(F.col("net_revenue").cast("decimal(38,10)")), 2).cast("double").alias("daily_net")))
    j = r.join(d, "order_date", "full")
    return j.select("order_date", F.coalesce("raw_lines", F.lit(0)).alias("raw_lines"),
                    "raw_net", "daily_net",
                    F.round(F.coalesce("raw_net", F.lit(0.0)) - F.coalesce("daily_net", F.lit(0.0)), 2)
                    .alias("difference"))


def price_identity(clean: DataFrame, products: DataFrame, new_products: DataFrame,
                   tolerance: float = 0.011) -> DataFrame:
    """unit_price == list * (1 - disc/100), list = base_price (legacy line)
    or msrp (new line). Counts per is_new_system."""
    # prices are parsed once an item, not once a line and use
    lp = (products.groupBy("product_id").agg(F.max_by("base_price", "catalog_pos").alias("_base"))
          .select("product_id", to_double(F.col("_base"), False).alias("_base")))
    np_ = (new_products.groupBy("new_product_id").agg(F.max_by("msrp", "catalog_pos").alias("_msrp"))
           .select("new_product_id", to_double(F.col("_msrp"), False).alias("_msrp")))
    j = join_legacy(clean.join(np_, clean.product_key == np_.new_product_id, "left"), lp)
    list_price = F.col("_list")
    expected = list_price * (F.lit(1.0) - F.coalesce(F.col("discount_pct"), F.lit(0.0)) / 100.0)
    ok = F.abs(F.col("unit_price") - expected) < tolerance
    return (j.withColumn("_list", F.when(F.col("is_new_system") == 1, F.col("_msrp")).otherwise(F.col("_base")))
            .groupBy("is_new_system")
            .agg(F.count(F.lit(1)).alias("n_lines"),
                 F.count_if(list_price.isNull()).alias("n_no_list_price"),
                 F.count_if(ok).alias("n_consistent"),
                 F.count_if(list_price.isNotNull() & ~ok).alias("n_inconsistent")))


def anomaly_days(daily: DataFrame) -> DataFrame:
    """store-days... per date: units sold but zero net."""
    by_day = daily.groupBy("order_date").agg(
        F.sum("units_sold").alias("units"),
        F.round(F.sum(F.col("net_revenue").cast("decimal(38,10)")), 2).cast("double").alias("net"))
    return by_day.where((F.col("units") > 0) & (F.col("net") == 0))


def weather_latest(pulls: DataFrame) -> DataFrame:
    """A10 generalised: for each (store, date) keep the value from the pull
    with the latest range_end (ties: latest range_start).

    A partial aggregation (max of a struct) instead of a window, so a hot
    (store, date) cell never lands in one task with all its copies."""
    v = F.struct("range_end", "range_start", "temperature_2m_max", "temperature_2m_min",
                 "precipitation_sum", "weather_code")
    return (pulls.groupBy("store_id", "weather_date").agg(F.max(v).alias("_v"))
            .select("weather_date", "store_id",
                    F.col("_v.temperature_2m_max").alias("temperature_2m_max"),
                    F.col("_v.temperature_2m_min").alias("temperature_2m_min"),
                    F.col("_v.precipitation_sum").alias("precipitation_sum"),
                    F.col("_v.weather_code").alias("weather_code"),
                    F.col("_v.range_end").alias("range_end")))


def weather_revisions(pulls: DataFrame, rain_mm: float = 1.0) -> DataFrame:
    """cells seen in more than one pull whose precipitation differs, and
    whether the revision crosses the strict ``> rain_mm`` rain threshold
    (first vs last pull by range_end)."""
    first = F.min(F.struct("range_end", "range_start", "precipitation_sum"))
    last = F.max(F.struct("range_end", "range_start", "precipitation_sum"))
    g = (pulls.groupBy("store_id", "weather_date")
         .agg(F.count(F.lit(1)).alias("n_pulls"),
              F.min("precipitation_sum").alias("precip_min"),
              F.max("precipitation_sum").alias("precip_max"),
              first.alias("_f"), last.alias("_l")))
    revised = g.where((F.col("n_pulls") > 1) & (F.col("precip_min") != F.col("precip_max")))
    crosses = (F.col("_f.precipitation_sum") > rain_mm) != (F.col("_l.precipitation_sum") > rain_mm)
    return revised.select("store_id", "weather_date", "n_pulls", "precip_min", "precip_max",
                          F.col("_f.precipitation_sum").alias("precip_first"),
                          F.col("_l.precipitation_sum").alias("precip_last"),
                          crosses.cast("int").alias("crosses_threshold"))
