"""Adapter views: the pipeline's inputs derived from the shared test tables.

The library's operators consume a daily order feed, two product catalogs, a
store list and daily weather. The driver's tables are TPC-H-like, so each
input is *derived* from them here with integer arithmetic and exact decimals
(the same rules are written in SQL in ``plans/oracle.py`` so DuckDB can check
every query). All derivations are per-row maps or one equi-join; they grow
linearly with the tables.

Fixed values (adapter design, not reference data):
  - store id      S00<l_suppkey % 8 + 1>
  - channel       returnflag A -> pickup, N -> in_store, R -> ship_from_store
  - loyalty       order priority 1-2 -> Y, 3-4 -> N, 5 -> NULL
  - header eras   file year < 1998 legacy ``product_id``; 1998-1999
                  ``new_product_id``; from 2000 NP ids under ``product_id`` with
                  ``product_id_source = 'new_system'``
  - faults        dressed price when l_orderkey % 50 = 0 (``$x``, ``$ x``,
                  ``x $`` or no-break spaces, by l_orderkey / 50 % 4); price 0 on
                  day 45 of a year; NULL date when l_orderkey % 503 = 0; store
                  S999 when l_orderkey % 349 = 0; quantity negative, fractional
                  or text when l_orderkey % 401, 409 or 419 = 0; discount 150
                  when l_orderkey % 307 = 0; repeated row when l_orderkey % 263
                  = 0; stale copy of l_orderkey % 211 = 0 rows in the next
                  day's file; day 101 of a year published again as day 102,
                  whose own rows come a day late (days 100-102 have no other
                  copies); orphan product id (+9000000) when l_partkey % 97 = 0
                  on ``new_product_id`` files; a date as mm/dd/yyyy when l_orderkey
                  % 601 = 0; a file name with month 13 when l_orderkey % 983 =
                  0; price 1e15 or 1e400 when l_orderkey % 701 or 709 = 0
  - weather       no value when (day of year + store) % 37 = 0
  - legacy category by part type: ECONOMY camping, LARGE emergency, MEDIUM
                  footwear, PROMO hydration, SMALL outerwear, STANDARD patio;
                  l_partkey % 50 = 7 -> clearance (unmapped)
  - catalogs      p_partkey % 100 = 9 legacy margin 0.29 (no partner);
                  p_partkey % 20 = 9 re-listed in the new catalog at margin
                  0.28; p_partkey % 8 in {1, 5} renamed; p_partkey % 100 = 17
                  gets an ``alt`` twin. These rules vary rows; none removes a
                  row from any input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.operators.crosswalk import CATEGORY_TO_DEPARTMENT
from ledgerlark.session import shuffles_dropped

# Part type -> legacy catalog category (adapter rule).
PART_TYPE_TO_CATEGORY = {
    "ECONOMY": "camping",
    "LARGE": "emergency",
    "MEDIUM": "footwear",
    "PROMO": "hydration",
    "SMALL": "outerwear",
    "STANDARD": "patio",
}
UNMAPPED_CATEGORY = "clearance"
UNMAPPED_DEPARTMENT = "outlet"
LAUNCH_BUCKET = 40          # part keys per launch date -> bounded block size


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def _map_col(mapping: dict, key: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])[key]


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw daily feed (raw_orders shape, every data column text).

    ``raw_id`` is the load order: file name, then position inside the file; rows
    that are equal in all of it follow ``row_uid``.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "l_extendedprice", "l_discount", "l_returnflag",
        # assigned on the scan itself, so a recomputed partition gets the same ids
        F.monotonically_increasing_id().alias("l_rowid"))
    od = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("d"), "o_orderpriority")
    # lineitem x orders is a big-big join at scale: plan it as a shuffle
    # (sort-merge) join on the order key, which also spreads the per-row feed
    # derivation over all shuffle partitions instead of the scan's splits.
    base = li.join(od.hint("merge"), li.l_orderkey == od.o_orderkey).drop("o_orderkey")
    # stale copies are generated in the same pass (no second scan / join)
    doy, key = F.dayofyear("d"), F.col("l_orderkey")
    late = (doy == 101) | ((key % 211 == 0) & ~doy.isin(100, 102))
    twice = (key % 263 == 0) & ~doy.isin(100, 101, 102)
    # constant arrays: building one a row isn't compiled code
    copies = (F.when(late & twice, F.array(*map(F.lit, (0, 1, 2)))).when(late, F.array(F.lit(0), F.lit(1)))
              .when(twice, F.array(F.lit(0), F.lit(2))).otherwise(F.array(F.lit(0))))
    shift = F.when((F.col("copy_no") == 1) | ((F.col("copy_no") == 0) & (doy == 102)), 1).otherwise(0)
    rows = base.withColumn("copy_no", F.explode(copies)).withColumn("file_d", F.date_add("d", shift))
    price = _s(F.when(doy == 45, F.lit(0).cast("decimal(18,2)")).otherwise(F.col("l_extendedprice").cast("decimal(18,2)")))
    price = F.when(key % 701 == 0, F.lit("1e15")).when(key % 709 == 0, F.lit("1e400")).otherwise(price)
    form = F.floor(key / 50) % 4
    nbsp = F.lit("\u00a0")
    dressed = (F.when(form == 0, F.concat(F.lit("$"), price)).when(form == 1, F.concat(F.lit("$ "), price))
               .when(form == 2, F.concat(price, F.lit(" $"))).otherwise(F.concat(nbsp, price, nbsp)))
    quantity = F.when(key % 419 == 0, F.lit("abc")).otherwise(F.concat(
        F.when(key % 401 == 0, "-").otherwise(""), _s(F.col("l_quantity").cast("long")),
        F.when(key % 409 == 0, ".5").otherwise("")))
    y = F.year("file_d")
    pk = _s(F.col("l_partkey"))
    orphan_pk = _s(F.when(F.col("l_partkey") % 97 == 0, F.col("l_partkey") + 9000000)
                   .otherwise(F.col("l_partkey")))
    prio = F.substring("o_orderpriority", 1, 1)
    source_file = F.concat(F.lit("orders_"), F.when(key % 983 == 0, F.concat(_s(y), F.lit("-13-45")))
                           .otherwise(_s(F.col("file_d"))), F.lit(".csv"))
    return rows.select(
        F.struct(source_file.alias("f"), "copy_no", "l_orderkey", "l_linenumber",
                 "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                 "l_discount", "l_returnflag", "o_orderpriority").alias("raw_id"),
        (F.col("l_rowid") * 3 + F.col("copy_no")).alias("row_uid"),
        source_file.alias("source_file"),
        F.concat(_s(F.col("file_d")), F.lit("T06:00:00Z")).alias("ingested_at"),
        F.concat(_s(F.col("l_orderkey")), F.lit("-"), _s(F.col("l_linenumber"))).alias("order_id"),
        F.when(key % 503 != 0, F.when(key % 601 == 0, F.date_format("d", "MM/dd/yyyy")).otherwise(_s(F.col("d")))).alias("order_date"),
        F.when(key % 349 == 0, F.lit("S999")).otherwise(
            F.concat(F.lit("S00"), _s(F.col("l_suppkey") % 8 + 1))).alias("store_id"),
        F.when(y < 1998, F.concat(F.lit("P"), pk))
         .when(y >= 2000, F.concat(F.lit("NP"), pk)).alias("product_id"),
        F.when((y >= 1998) & (y < 2000), F.concat(F.lit("NP"), orphan_pk)).alias("new_product_id"),
        F.when(y >= 2000, F.lit("new_system")).alias("product_id_source"),
        quantity.alias("quantity"),
        F.when(key % 50 == 0, dressed).otherwise(price).alias("unit_price"),
        F.when(key % 307 == 0, F.lit("150")).otherwise(_s(F.round(F.col("l_discount") * 100).cast("int"))).alias("discount_pct"),
        F.when(F.col("l_returnflag") == "A", "pickup")
         .when(F.col("l_returnflag") == "N", "in_store")
         .when(F.col("l_returnflag") == "R", "ship_from_store").alias("sales_channel"),
        F.when(prio.isin("1", "2"), "Y").when(prio.isin("3", "4"), "N").alias("loyalty_member"),
    )


def feed_headers(raw: DataFrame) -> DataFrame:
    """One row per feed file: (source_file, header array) by the file's era."""
    legacy = ["order_id", "order_date", "store_id", "product_id", "quantity",
              "unit_price", "discount_pct", "sales_channel", "loyalty_member"]
    newcol = [c if c != "product_id" else "new_product_id" for c in legacy]
    flagged = legacy + ["product_id_source"]
    files = (raw.select("source_file").distinct()
             .withColumn("y", F.substring("source_file", 8, 4).cast("int")))
    hdr = (F.when(F.col("y") < 1998, F.array(*map(F.lit, legacy)))
           .when(F.col("y") < 2000, F.array(*map(F.lit, newcol)))
           .otherwise(F.array(*map(F.lit, flagged))))
    return files.select("source_file", hdr.alias("header"))


def write_feed_files(raw: DataFrame, folder: str, monthly: bool = False) -> str:
    """The feed as CSV files, a folder for each header era (the later eras in
    another column order): ``legacy``, ``renamed`` and ``flagged``.

    With ``monthly`` the feed files of a month are one file, a folder named for
    the month's first day with one part file, rows in load order. Otherwise the files are the splits of the feed, and the
    sales channel of l_orderkey % 13 = 0 rows has a second line, with quotes and
    a comma."""
    note = F.when(F.split("order_id", "-")[0].cast("long") % 13 == 0, F.concat(F.lit('\n"gift", '), F.col("order_id")))
    if monthly:
        rows = (raw.withColumn("source_file", F.concat(F.substring("source_file", 1, 14), F.lit("-01.csv")))
                .repartition("source_file").sortWithinPartitions("source_file", "raw_id", "row_uid"))
    else:
        rows = raw.withColumn("sales_channel", F.concat("sales_channel", F.coalesce(note, F.lit(""))))
    by = ["source_file"] if monthly else []
    year = F.substring("source_file", 8, 4).cast("int")
    shared = ["order_date", "store_id", "quantity", "unit_price", "discount_pct", "sales_channel", "loyalty_member"]
    eras = {"legacy": (year < 1998, ["order_id", "product_id", *shared]),
            "renamed": ((year >= 1998) & (year < 2000), [*shared[::-1], "new_product_id", "order_id"]),
            "flagged": (year >= 2000, [*shared[3:], "order_id", *shared[:3], "product_id_source", "product_id"])}
    for era, (of_era, header) in eras.items():
        with shuffles_dropped(raw.sparkSession):
            (rows.where(of_era).select(*header, *by).write.partitionBy(*by).option("header", "true").option("escape", '"')
             .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(f"{folder}/{era}"))
    return folder


def _launch_date(partkey: Column) -> Column:
    return _s(F.date_add(F.lit("2019-01-01").cast("date"), (partkey / LAUNCH_BUCKET).cast("int")))


def _category(p: DataFrame) -> Column:
    return (F.when(F.col("p_partkey") % 50 == 7, F.lit(UNMAPPED_CATEGORY))
            .otherwise(_map_col(PART_TYPE_TO_CATEGORY, F.col("p_type"))))


def _price_text(c: Column) -> Column:
    return _s(c.cast("decimal(12,2)"))


def _spread_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part table over as many tasks as shuffles have: it is a small file of
    few splits, and the catalogs' names are long work on few bytes."""
    return table(spark, sf_dir, "part").repartition("p_partkey")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Legacy catalog (all text like the reference's CSV), plus catalog_pos."""
    p = _spread_parts(spark, sf_dir)
    margin = F.concat(F.lit("0."), _s(F.when(F.col("p_partkey") % 100 == 9, F.lit(29))
                                      .otherwise(30 + F.col("p_partkey") % 7)))
    return p.select(
        F.concat(F.lit("P"), _s(F.col("p_partkey"))).alias("product_id"),
        F.concat_ws(" ", "p_name", "p_brand", _s(F.col("p_partkey"))).alias("product_name"),
        _category(p).alias("category"),
        F.col("p_name").alias("subcategory"),
        F.col("p_brand").alias("brand"),
        _price_text(F.col("p_retailprice")).alias("base_price"),
        margin.alias("margin_rate"),
        _launch_date(F.col("p_partkey")).alias("launch_date"),
        F.lit("Y").alias("active"),
        F.col("p_partkey").alias("catalog_pos"),
    )


def new_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New-system catalog: every part, with renamed items, items re-listed
    under a new margin in the migration (so their legacy row has no block
    partner), and near-duplicate ``alt`` twins that make blocks ambiguous."""
    p = _spread_parts(spark, sf_dir)
    k = F.col("p_partkey")
    name = (F.when(k % 8 == 1, F.concat_ws(" ", "p_name", F.lit("series"), F.lower("p_type")))
            .when(k % 8 == 5, F.concat_ws(" ", "p_name", _s(k), F.lit("pro")))
            .otherwise(F.concat_ws(" ", "p_name", "p_brand", _s(k))))
    dept = F.coalesce(_map_col(CATEGORY_TO_DEPARTMENT, _category(p)), F.lit(UNMAPPED_DEPARTMENT))
    retail = F.col("p_retailprice").cast("decimal(12,2)")
    base = p.select(
        F.concat(F.lit("NP"), _s(k)).alias("new_product_id"),
        name.alias("item_name"),
        dept.alias("department"),
        F.col("p_name").alias("class"),
        F.regexp_replace("p_brand", "Brand#", "Mfr ").alias("brand_name"),
        _price_text(F.round(retail * F.lit(1.05).cast("decimal(3,2)"), 2)).alias("msrp"),
        F.concat(F.lit("0."), _s(F.when(k % 20 == 9, F.lit(28)).otherwise(30 + k % 7))).alias("gross_margin"),
        _launch_date(k).alias("launch_date"),
        F.lit("Y").alias("active"),
        (k * 2).alias("catalog_pos"),
        k.alias("_k"), retail.alias("_retail"),
    )
    twins = (base.where(F.col("_k") % 100 == 17)
             .withColumn("new_product_id", F.concat(F.lit("NP"), _s(F.col("_k") + 8000000)))
             .withColumn("item_name", F.concat(F.col("item_name"), F.lit(" alt")))
             .withColumn("msrp", _price_text(F.round(F.col("_retail") * F.lit(1.07).cast("decimal(3,2)"), 2)))
             .withColumn("catalog_pos", F.col("catalog_pos") + 1))
    return base.unionByName(twins).drop("_k", "_retail")


def with_default_dates(catalog: DataFrame, number: Column) -> DataFrame:
    """The catalog after a migration that knew neither launch date nor margin of
    a third of the items: those share one default of both."""
    lost = number % 3 == 0
    margin = "margin_rate" if "margin_rate" in catalog.columns else "gross_margin"
    return (catalog.withColumn("launch_date", F.when(lost, "1900-01-01").otherwise(F.col("launch_date")))
            .withColumn(margin, F.when(lost, "0.30").otherwise(F.col(margin))))


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return (s.select(F.concat(F.lit("S00"), _s(F.col("s_suppkey") % 8 + 1)).alias("store_id"))
            .distinct())


def _weather_values(d: Column, store_no: Column) -> list[Column]:
    doy = F.dayofyear(d)
    tmax10 = 100 + (doy * 11 + store_no * 5) % 250
    return [
        (tmax10.cast("double") / 10).alias("temperature_2m_max"),
        ((tmax10 - 80).cast("double") / 10).alias("temperature_2m_min"),
        (((doy * 7 + F.year(d) * 3 + store_no * 13) % 40).cast("double") * 0.25).alias("precipitation_sum"),
        ((doy + store_no) % 4).cast("int").alias("weather_code"),
    ]


def _store_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    od = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    # AQE plans this join by measured size (a sort-merge join at scale)
    return (li.join(od, li.l_orderkey == od.o_orderkey)
            .select("d", (F.col("l_suppkey") % 8 + 1).alias("store_no")).distinct())


def weather_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily weather covariate per (date, store) the feed trades on, with gaps."""
    sd = _store_days(spark, sf_dir).where((F.dayofyear("d") + F.col("store_no")) % 37 != 0)
    return sd.select(
        _s(F.col("d")).alias("weather_date"),
        F.concat(F.lit("S00"), _s(F.col("store_no"))).alias("store_id"),
        *_weather_values(F.col("d"), F.col("store_no")),
        F.lit("adapter").alias("weather_source"),
    )


def weather_pulls(spark: SparkSession, sf_dir: str, weather: DataFrame | None = None) -> DataFrame:
    """Two cached pulls per (store, year): an early pull covering January-June
    and a later full-year pull whose precipitation is revised when
    (day-of-year + store) % 29 = 0. Columns: store_id, range_start, range_end,
    weather_date and the four values.
    """
    w = weather if weather is not None else weather_daily(spark, sf_dir)
    d = F.col("weather_date").cast("date")
    yr = _s(F.year(d))
    store_no = F.substring("store_id", 4, 1).cast("int")
    early = (w.where(F.month(d) <= 6)
             .withColumn("range_start", F.concat(yr, F.lit("-01-01")))
             .withColumn("range_end", F.concat(yr, F.lit("-06-30"))))
    revised = F.when((F.dayofyear(d) + store_no) % 29 == 0,
                     F.col("precipitation_sum") + 0.75).otherwise(F.col("precipitation_sum"))
    late = (w.withColumn("precipitation_sum", revised)
            .withColumn("range_start", F.concat(yr, F.lit("-01-01")))
            .withColumn("range_end", F.concat(yr, F.lit("-12-31"))))
    return early.unionByName(late)
