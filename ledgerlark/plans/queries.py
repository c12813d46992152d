"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key.

Every query reads the shared tables through the adapters (so its work grows
with them) and runs over whole tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark import schemas
from ledgerlark.functions.numeric import to_double, to_long
from ledgerlark.functions.similarity import similarity
from ledgerlark.functions.text import calendar_day, normalize_text, overlap_count, token_overlap_similarity
from ledgerlark.operators import cleaning, crosswalk, daily, kpi, monitor, quality, stats
from ledgerlark.plans import adapters
from ledgerlark.plans.pipeline import FeedPipeline
from ledgerlark.sources import reference, sinks

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Callable[[FeedPipeline], DataFrame]] = {}

# Incremental scenario used by the A5/B4 queries: files up to this date are
# already in the raw table / quality log; everything after is pending.
LOADED_THROUGH = "1999-12-31"
SLICE_CATEGORIES = ["footwear", "patio"]     # of the G6 query


def query(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


# ---- D: cleaning ------------------------------------------------------------
@query("numeric_normalise")
def q_numeric(p: FeedPipeline) -> DataFrame:
    r = p.raw
    return r.select("source_file", "order_id", F.col("unit_price").alias("unit_price_text"),
                    to_long(F.col("quantity")).alias("quantity"),
                    to_double(F.col("unit_price")).alias("unit_price"),
                    to_double(F.col("discount_pct")).alias("discount_pct"))


@query("product_resolution")
def q_product_resolution(p: FeedPipeline) -> DataFrame:
    r = cleaning.resolve_products(p.raw, p.crosswalk)
    return r.select("source_file", "order_id", "raw_val", F.col("is_new").cast("int").alias("is_new_system"),
                    "product_key", "legacy_product_id")


@query("clean_orders")
def q_clean(p: FeedPipeline) -> DataFrame:
    return p.clean


@query("rejected_rows")
def q_rejected(p: FeedPipeline) -> DataFrame:
    return p.rejected


@query("line_revenue_by_channel")
def q_channel_revenue(p: FeedPipeline) -> DataFrame:
    return p.clean.groupBy("sales_channel", "loyalty_member").agg(
        F.count(F.lit(1)).alias("n_lines"),
        daily.to_cents(daily.money_sum(F.col("line_revenue"))).alias("line_revenue"))


# ---- E: crosswalk -------------------------------------------------------------
@query("normalised_names")
def q_normalised(p: FeedPipeline) -> DataFrame:
    return p.products.select("product_id", normalize_text(F.col("product_name")).alias("norm_name"),
                             normalize_text(F.col("subcategory")).alias("norm_subcategory"))


@query("token_overlap")
def q_token_overlap(p: FeedPipeline) -> DataFrame:
    """E2/E3 over every blocked tier-2 pair."""
    l = p.products.select("product_id", normalize_text(F.col("product_name")).alias("a"))
    n = p.new_products.select("new_product_id", normalize_text(F.col("item_name")).alias("b"))
    j = p.scored.select("product_id", "new_product_id").join(l, "product_id").join(n, "new_product_id")
    return j.select("product_id", "new_product_id",
                    overlap_count(F.col("a"), F.col("b")).cast("long").alias("overlap"),
                    F.round(token_overlap_similarity(F.col("a"), F.col("b")), 6).alias("similarity"))


@query("edit_similarity")
def q_edit(p: FeedPipeline) -> DataFrame:
    """E4 over every blocked tier-2 pair."""
    l = p.products.select("product_id", normalize_text(F.col("product_name")).alias("a"))
    n = p.new_products.select("new_product_id", normalize_text(F.col("item_name")).alias("b"))
    j = p.scored.select("product_id", "new_product_id").join(l, "product_id").join(n, "new_product_id")
    return j.select("product_id", "new_product_id", similarity(F.col("a"), F.col("b"), "edit_distance").alias("similarity"))


@query("best_window_similarity")
def q_best_window(p: FeedPipeline) -> DataFrame:
    """E5 over every blocked tier-2 pair: the whole names, and the new name
    against the legacy subcategory, which is shorter."""
    l = p.products.select("product_id", normalize_text(F.col("product_name")).alias("a"),
                          normalize_text(F.col("subcategory")).alias("sub"))
    n = p.new_products.select("new_product_id", normalize_text(F.col("item_name")).alias("b"))
    j = p.scored.select("product_id", "new_product_id").join(l, "product_id").join(n, "new_product_id")
    return j.select("product_id", "new_product_id",
                    similarity(F.col("a"), F.col("b"), "partial_ratio").alias("name_window"),
                    similarity(F.col("sub"), F.col("b"), "partial_ratio").alias("subclass_window"))


@query("crosswalk_overrides")
def q_overrides(p: FeedPipeline) -> DataFrame:
    """Reviewers confirm the same-numbered new item for rows left for
    review whose product number is divisible by 3."""
    number = F.expr("substring(product_id, 2)")
    review = (p.crosswalk.where((F.col("needs_review") == 1) & (number.cast("long") % 3 == 0))
              .select("product_id", F.concat(F.lit("NP"), number).alias("new_product_id")))
    return crosswalk.apply_overrides(p.crosswalk.select(*crosswalk.CROSSWALK_COLUMNS), review).select(
        *crosswalk.CROSSWALK_COLUMNS)


@query("token_set_similarity")
def q_token_set(p: FeedPipeline) -> DataFrame:
    s = p.scored
    return s.select("product_id", "new_product_id", "name_sim", "subclass_sim",
                    F.round("price_sim", 6).alias("price_sim"), F.round("score", 6).alias("score"))


@query("crosswalk_exact")
def q_crosswalk_exact(p: FeedPipeline) -> DataFrame:
    L, N = crosswalk.prepare(p.products, p.new_products)
    return crosswalk.exact_name_matches(L, N).select("product_id", "new_product_id")


@query("crosswalk")
def q_crosswalk(p: FeedPipeline) -> DataFrame:
    return p.crosswalk.select(*crosswalk.CROSSWALK_COLUMNS)


@query("crosswalk_review")
def q_crosswalk_review(p: FeedPipeline) -> DataFrame:
    return p.crosswalk.where(F.col("needs_review") == 1).select(*crosswalk.CROSSWALK_COLUMNS)


@query("crosswalk_hot_blocks")
def q_crosswalk_hot(p: FeedPipeline) -> DataFrame:
    """E11 + E12 where a third of both catalogs has a default launch date and
    margin: blocks that grow with the catalog, searched by bounds. Cells are small
    and blocks count as hot early, so that small tables reach the bounds too."""
    number = F.regexp_extract(F.col("product_id"), "[0-9]+", 0).cast("long")
    new_number = F.regexp_extract(F.col("new_product_id"), "[0-9]+", 0).cast("long") % 8000000
    legacy = adapters.with_default_dates(p.products, number)
    new = adapters.with_default_dates(p.new_products, new_number)
    best = crosswalk.best_two(legacy, new, hot_pairs=256, cell=32)
    return (best.join(legacy.select("product_id", F.col("catalog_pos").alias("l_pos")), "l_pos")
            .select("product_id", "n_cands", F.col("b.new_product_id").alias("best_id"),
                    F.round("b.score", 6).alias("best_score"), F.col("s.new_product_id").alias("second_id"),
                    F.round("s.score", 6).alias("second_score")))


@query("crosswalk_validation")
def q_crosswalk_validation(p: FeedPipeline) -> DataFrame:
    return crosswalk.crosswalk_validation(p.crosswalk)


@query("crosswalk_status")
def q_crosswalk_status(p: FeedPipeline) -> DataFrame:
    return crosswalk.status_summary(p.crosswalk)


@query("score_distribution")
def q_score_distribution(p: FeedPipeline) -> DataFrame:
    return crosswalk.score_distribution(p.scored)


@query("crosswalk_fidelity")
def q_crosswalk_fidelity(p: FeedPipeline) -> DataFrame:
    return crosswalk.crosswalk_fidelity(p.crosswalk, p.scored, p.products)


@query("brand_bijection")
def q_brand_bijection(p: FeedPipeline) -> DataFrame:
    return crosswalk.brand_bijection(p.crosswalk, p.products, p.new_products)


@query("brand_bijection_kept")
def q_brand_kept(p: FeedPipeline) -> DataFrame:
    """E21 where every second item kept its brand's name."""
    even = F.regexp_extract("new_product_id", "[0-9]+", 0).cast("long") % 2 == 0
    kept = F.when(even, F.regexp_replace("brand_name", "Mfr ", "Brand#")).otherwise(F.col("brand_name"))
    return crosswalk.brand_bijection(p.crosswalk, p.products, p.new_products.withColumn("brand_name", kept))


# ---- F: daily_sales -------------------------------------------------------------
@query("category_resolution")
def q_category(p: FeedPipeline) -> DataFrame:
    c = daily.resolve_category(p.clean, p.new_products, p.products)
    return c.groupBy("category", "category_source").agg(
        F.count(F.lit(1)).alias("n_lines"), F.coalesce(F.sum("quantity"), F.lit(0)).cast("long").alias("units"))


@query("daily_sales")
def q_daily(p: FeedPipeline) -> DataFrame:
    return p.daily


@query("grain_check")
def q_grain(p: FeedPipeline) -> DataFrame:
    return daily.grain_check(p.daily)


@query("reconcile")
def q_reconcile(p: FeedPipeline) -> DataFrame:
    return daily.reconcile(p.daily, p.clean)


@query("raw_reconcile")
def q_raw_reconcile(p: FeedPipeline) -> DataFrame:
    return daily.raw_reconcile(p.raw, p.daily)


@query("price_identity")
def q_price_identity(p: FeedPipeline) -> DataFrame:
    return daily.price_identity(p.clean, p.products, p.new_products)


@query("price_identity_listed")
def q_price_identity_listed(p: FeedPipeline) -> DataFrame:
    """F9 over lines of which every second order sells at list price less
    discount, so both sides of the identity occur."""
    base = p.products.select(F.col("product_id").alias("legacy_product_id"), to_double(F.col("base_price"), False).alias("_b"))
    msrp = p.new_products.select(F.col("new_product_id").alias("product_key"), to_double(F.col("msrp"), False).alias("_m"))
    listed = F.when(F.col("is_new_system") == 1, F.col("_m")).otherwise(F.col("_b"))
    price = F.round(listed * (1 - F.coalesce(F.col("discount_pct"), F.lit(0.0)) / 100), 2)
    even = F.split("order_id", "-")[0].cast("long") % 2 == 0
    lines = (p.clean.join(base, "legacy_product_id", "left").join(msrp, "product_key", "left")
             .withColumn("unit_price", F.when(even & price.isNotNull(), price).otherwise(F.col("unit_price"))).drop("_b", "_m"))
    return daily.price_identity(lines, p.products, p.new_products)


@query("weather_coverage")
def q_weather_coverage(p: FeedPipeline) -> DataFrame:
    return daily.weather_coverage(p.daily)


@query("anomaly_days")
def q_anomaly(p: FeedPipeline) -> DataFrame:
    return daily.anomaly_days(p.daily)


@query("weather_latest")
def q_weather_latest(p: FeedPipeline) -> DataFrame:
    return daily.weather_latest(p.pulls)


@query("weather_unpack")
def q_weather_unpack(p: FeedPipeline) -> DataFrame:
    """Cache-file documents (struct of parallel daily arrays) rebuilt from
    the pulls, then unpacked to rows by the JSON source's unpack step."""
    from ledgerlark.sources import weather_json
    return weather_json.unpack(weather_json.pack(p.pulls)).select(
        "weather_date", "store_id", "temperature_2m_max", "temperature_2m_min", "precipitation_sum",
        "weather_code", "range_start", "range_end")


@query("weather_revisions")
def q_weather_revisions(p: FeedPipeline) -> DataFrame:
    return daily.weather_revisions(p.pulls)


# ---- A: feed files -------------------------------------------------------------
@query("feed_file_records")
def q_feed_file_records(p: FeedPipeline) -> DataFrame:
    """A1-A2: the feed written as CSV files of three headers, with line breaks
    and quotes in quoted fields, and read back from them."""
    from ledgerlark.session import stage_root
    from ledgerlark.sources import feed_csv
    folder = adapters.write_feed_files(p.raw, f"{stage_root(p.spark)}/feed-files-{uuid.uuid4().hex}")
    return feed_csv.read_orders(p.spark, f"{folder}/*").select(*feed_csv.DATA_FIELDS)


@query("ledger_load")
def q_ledger_load(p: FeedPipeline) -> DataFrame:
    """A5 + B2 over monthly CSV files: the log of two loads of the landing folder
    (files before 2000, then all) with the load that wrote each record; a third
    call finds nothing on offer."""
    from ledgerlark.session import stage_root
    from ledgerlark.streaming import ledger
    base = f"{stage_root(p.spark)}/ledger-{uuid.uuid4().hex}"
    folder = adapters.write_feed_files(p.raw, f"{base}/landing", monthly=True)
    eras = [f"{folder}/{era}" for era in ("legacy", "renamed", "flagged")]
    for landing in (eras[:2], eras, eras):
        ledger.load(p.spark, landing, f"{base}/loaded", name_level=2)
    return ledger.table(p.spark, f"{base}/loaded", "ingestion_log").select(
        "epoch", "source_date_expected", "status", "rows_loaded", "file_hash", "error_message")


# ---- A: tables written and read back ---------------------------------------------
def _stage_folder(p: FeedPipeline, name: str) -> str:
    from ledgerlark.session import stage_root
    return f"{stage_root(p.spark)}/{name}-{uuid.uuid4().hex}"


def _stage_database(p: FeedPipeline) -> str:
    """A database of this call in the shared stage folder, with all declared tables."""
    folder = _stage_folder(p, "db")
    name = "ledgerlark_" + folder[-32:]
    p.spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}'")
    sinks.create_tables(p.spark, name)
    return name


def _in_two_appends(p: FeedPipeline, name: str) -> None:
    for part in (p.clean.where("is_new_system = 1"), p.clean.where("is_new_system <> 1")):
        sinks.append_table(part, name, schemas.CLEAN_ORDERS)


@query("clean_orders_table")
def q_clean_table(p: FeedPipeline) -> DataFrame:
    """A11 + A13: clean_orders from two appends to the declared table."""
    table = f"{_stage_database(p)}.clean_orders"
    _in_two_appends(p, table)
    return p.spark.table(table)


@query("table_audit")
def q_table_audit(p: FeedPipeline) -> DataFrame:
    """A11-A13 + A16: declared tables made twice over, one filled by appends, two
    replaced (one after a first version), and counted; a table nobody made."""
    db = _stage_database(p)
    sinks.create_tables(p.spark, db)
    _in_two_appends(p, f"{db}.clean_orders")
    sinks.replace_table(p.daily.where("units_sold > 10"), f"{db}.daily_sales")
    sinks.replace_table(p.daily, f"{db}.daily_sales")
    sinks.replace_table(p.crosswalk.select(*crosswalk.CROSSWALK_COLUMNS), f"{db}.product_crosswalk")
    audit = sinks.table_audit(p.spark, [f"{db}.{t}" for t in (*schemas.TABLES, "no_such_table")])
    return audit.select(F.substring_index("table", ".", -1).alias("table_name"), "present", "n_rows")


@query("ingestion_log_mirror")
def q_log_mirror(p: FeedPipeline) -> DataFrame:
    """A14 + A15: the ingestion log exported as CSV and mirrored, typed, into
    its table, which held an older log; empty fields are NULL there."""
    table = f"{_stage_database(p)}.ingestion_log"
    log = q_ingestion_log(p)
    sinks.append_table(log.where(F.col("status") == "stale"), table, schemas.INGESTION_LOG)
    path = _stage_folder(p, "ingestion-log")
    sinks.export_csv(log, path)
    sinks.mirror_log(p.spark, path, table)
    return p.spark.table(table)


@query("reference_tables")
def q_reference_tables(p: FeedPipeline) -> DataFrame:
    """A7 + A8: a catalog read once and copied to a CSV snapshot and a table
    copy; the snapshot loaded as reference table (a file that is absent is
    skipped), each row with the number of copies that hold it."""
    folder = _stage_folder(p, "reference")
    catalog = p.new_products.drop("catalog_pos")
    status = reference.copy_table(catalog, {"csv": lambda d: sinks.export_csv(d, f"{folder}/csv"),
                                            "table": lambda d: d.write.parquet(f"{folder}/copy")})
    if set(status.values()) != {"ok"}:
        raise RuntimeError(f"copies failed: {status}")
    reference.load_reference(p.spark, {"new_products": f"{folder}/csv", "stores": f"{folder}/absent"}, f"{folder}/loaded")
    both = p.spark.read.parquet(f"{folder}/loaded/new_products").unionByName(p.spark.read.parquet(f"{folder}/copy"))
    return both.groupBy(*both.columns).agg(F.count(F.lit(1)).alias("n_copies"))


@query("failed_files")
def q_failed_files(p: FeedPipeline) -> DataFrame:
    """Files whose name holds no calendar day, as failed attempts."""
    day = F.substring("source_file", 8, 10)
    bad = (p.raw.where(calendar_day(day).isNull()).select(day.alias("file_date")).distinct()
           .withColumn("error", F.concat(F.lit("no such day: "), F.col("file_date"))))
    return monitor.failed_records(bad, F.concat(F.col("file_date"), F.lit("T06:00:00Z")), "feed://orders.csv")


# ---- B / C: monitoring and quality ------------------------------------------------
@query("dq_report")
def q_dq(p: FeedPipeline) -> DataFrame:
    return p.dq_report


@query("file_status")
def q_file_status(p: FeedPipeline) -> DataFrame:
    return p.file_status


@query("stale_files")
def q_stale(p: FeedPipeline) -> DataFrame:
    return (p.dq_report.where(F.col("flags").contains("stale("))
            .select("file_name", "flags"))


@query("ingestion_log")
def q_ingestion_log(p: FeedPipeline) -> DataFrame:
    hashes = monitor.content_digest(p.raw, quality.DATA_COLUMNS)
    ts = F.concat(F.col("file_date"), F.lit("T06:00:00Z"))
    return monitor.ingestion_log_new(p.file_status, hashes, None, source_url="feed://orders.csv",
                                     run_timestamp=ts)


@query("missing_days")
def q_missing(p: FeedPipeline) -> DataFrame:
    log = monitor.ingestion_log_new(p.file_status, None, None)
    return monitor.missing_days(log)


@query("republished")
def q_republished(p: FeedPipeline) -> DataFrame:
    hashes = monitor.content_digest(p.raw, quality.DATA_COLUMNS)
    log = monitor.ingestion_log_new(p.file_status, hashes, None)
    return monitor.republished(log)


@query("incremental_pending")
def q_pending(p: FeedPipeline) -> DataFrame:
    files = p.raw.select(F.col("source_file").alias("file_name")).distinct()
    loaded = (files.where(F.substring("file_name", 8, 10) <= LOADED_THROUGH)
              .select(F.substring("file_name", 8, 10).alias("file_date")))
    return monitor.pending_files(files, loaded)


@query("unchecked_files")
def q_unchecked(p: FeedPipeline) -> DataFrame:
    """Files not in the quality log, which ends where loading did."""
    files = p.raw.select(F.col("source_file").alias("file_name")).distinct()
    return monitor.unchecked_files(files, p.dq_report.where(F.substring("file_name", 8, 10) <= LOADED_THROUGH))


@query("dq_flag_diff")
def q_dq_flag_diff(p: FeedPipeline) -> DataFrame:
    """The current gate vs a log written before the non-numeric check
    existed (the same gate with that flag removed); the allowlist holds the
    known difference for the first affected file."""
    cur = p.dq_report.select("file_name", "flags")
    strip = F.regexp_replace(F.col("flags"), r";?nonnumeric\([^)]*\)", "")
    logged = cur.select("file_name", F.regexp_replace(strip, "^;", "").alias("flags"))
    nn = cur.select("file_name", F.regexp_extract("flags", r"nonnumeric\([^)]*\)", 0).alias("flag"))
    known = (nn.where(F.col("flag") != "").groupBy()
             .agg(F.min_by("flag", "file_name").alias("flag"), F.min("file_name").alias("file_name")))
    return quality.dq_flag_diff(cur, logged, known)


@query("dq_flag_history")
def q_dq_flag_history(p: FeedPipeline) -> DataFrame:
    """C13 against a log of a gate with a check that was since retired: on the
    seventh of a month the log holds a flag that the gate no longer gives."""
    cur = p.dq_report.select("file_name", "flags")
    retired = F.when(F.substring("file_name", 16, 2) == "07", F.lit("retired_check"))
    logged = cur.select("file_name", F.concat_ws(";", F.nullif("flags", F.lit("")), retired).alias("flags"))
    return quality.dq_flag_diff(cur, logged)


# ---- G: board ------------------------------------------------------------------
@query("enriched_lines")
def q_enriched(p: FeedPipeline) -> DataFrame:
    d, l = p.board
    return l.select("order_date", "store_id", "product_key", "product_name", "category", "sales_channel",
                    "quantity", F.round("net_revenue", 4).alias("net_revenue"),
                    F.round("gross_revenue", 4).alias("gross_revenue"), "precipitation_sum")


@query("kpi_totals")
def q_kpi(p: FeedPipeline) -> DataFrame:
    return kpi.kpi_totals(*p.board)


@query("kpi_totals_slice")
def q_kpi_slice(p: FeedPipeline) -> DataFrame:
    """The totals of two stores, two categories and one year."""
    return kpi.kpi_totals(*kpi.board_frames(p.daily, p.enriched, ["S001", "S003"], SLICE_CATEGORIES, "1996-01-01",
                                            "1996-12-31"))


@query("daily_series")
def q_daily_series(p: FeedPipeline) -> DataFrame:
    return kpi.daily_series(p.board[0])


@query("week_over_week")
def q_wow(p: FeedPipeline) -> DataFrame:
    return kpi.week_over_week(p.board[0])


@query("window_label")
def q_window(p: FeedPipeline) -> DataFrame:
    return kpi.window_label(p.board[0])


@query("weather_corr")
def q_weather_corr(p: FeedPipeline) -> DataFrame:
    return kpi.weather_corr_all(p.board[0]).drop("raw_r")


@query("recommendations")
def q_recommend(p: FeedPipeline) -> DataFrame:
    return kpi.recommendations(p.board[0])


@query("recommendation_tags")
def q_recommendation_tags(p: FeedPipeline) -> DataFrame:
    """G12-G13 where sales do follow the weather: the covariates of four
    categories are their own revenue or units, with either sign, so every tag occurs."""
    net, cat = F.col("net_revenue"), F.col("category")
    d = p.board[0].withColumns({
        "temp_max": F.when(cat == "footwear", net).when(cat == "apparel", -F.col("units_sold").cast("double")).otherwise(F.col("temp_max")),
        "precipitation_sum": F.when(cat.isin("camping", "apparel"), net).when(cat == "drinkware", -net)
        .otherwise(F.col("precipitation_sum"))})
    return kpi.recommendations(d)


@query("revenue_by_store")
def q_by_store(p: FeedPipeline) -> DataFrame:
    return kpi.revenue_by_store(p.board[0])


@query("revenue_by_category")
def q_by_category(p: FeedPipeline) -> DataFrame:
    return kpi.revenue_by_category(p.board[0])


@query("top_products")
def q_top(p: FeedPipeline) -> DataFrame:
    return kpi.top_products(p.board[1], 6)


@query("rain_day_counts")
def q_rain_days(p: FeedPipeline) -> DataFrame:
    return kpi.rain_day_counts(p.board[1])


@query("channel_mix")
def q_channel_mix(p: FeedPipeline) -> DataFrame:
    return kpi.channel_mix(p.board[1])


@query("rain_lift_mean")
def q_lift_mean(p: FeedPipeline) -> DataFrame:
    return kpi.rain_lift_mean(p.board[1], (0.4, 1.0, 5.0, 10.0))


# ---- H: statistics -------------------------------------------------------------
@query("store_days")
def q_store_days(p: FeedPipeline) -> DataFrame:
    return p.store_days


@query("channel_shift")
def q_channel_shift(p: FeedPipeline) -> DataFrame:
    return stats.channel_counts(p.clean, p.store_days)


@query("channel_shift_z")
def q_channel_z(p: FeedPipeline) -> DataFrame:
    return stats.channel_shift(p.clean, p.store_days)


@query("rain_lift_median")
def q_lift_median(p: FeedPipeline) -> DataFrame:
    return stats.rain_lift_median(p.store_days)


@query("store_mix")
def q_store_mix(p: FeedPipeline) -> DataFrame:
    return stats.store_mix(p.store_days)


@query("share_vs_median")
def q_share_vs_median(p: FeedPipeline) -> DataFrame:
    return stats.share_vs_median(p.store_days)


@query("spearman_by_store")
def q_spearman(p: FeedPipeline) -> DataFrame:
    return stats.spearman_by_store(p.store_days)


@query("significance_screen")
def q_screen(p: FeedPipeline) -> DataFrame:
    return stats.significance_screen(stats.spearman_by_store(p.store_days))


@query("significance_screen_signal")
def q_screen_signal(p: FeedPipeline) -> DataFrame:
    """H8 where four stores' sales follow the temperature in the first half of
    a month, so that tests pass the screen."""
    follows = F.col("store_id").isin("S001", "S002", "S003", "S004") & (F.substring("order_date", 9, 2) <= "15")
    sd = p.store_days.withColumn("temp_max", F.when(follows, F.col("net_revenue")).otherwise(F.col("temp_max")))
    return stats.significance_screen(stats.spearman_by_store(sd))


@query("channel_shift_zscore")
def q_channel_zscore(p: FeedPipeline) -> DataFrame:
    """H3 statistic without the tail probability (exactly checkable)."""
    return stats.channel_shift(p.clean, p.store_days).drop("p_value")


@query("spearman_rho_by_store")
def q_spearman_rho(p: FeedPipeline) -> DataFrame:
    """H7 rank correlations without p-values (exactly checkable)."""
    return stats.spearman_by_store(p.store_days).drop("p_value")


@query("share_vs_median_rho")
def q_share_rho(p: FeedPipeline) -> DataFrame:
    """H6 rank correlation without the p-value (exactly checkable)."""
    return stats.share_vs_median(p.store_days).drop("p_value")


@query("effective_sample")
def q_effective(p: FeedPipeline) -> DataFrame:
    return stats.effective_sample(p.daily)


_PIPELINES: dict = {}


def _fingerprint(spark: SparkSession, sf_dir: str) -> tuple:
    """Identity of the input folder's tables (bytes, files and time of the last
    change, as any Hadoop file system tells them), so stage tables are rebuilt
    when the inputs change."""
    out = []
    for name in ("lineitem", "orders", "part", "supplier"):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        size = fs.getContentSummary(path)
        out.append((name, size.getLength(), size.getFileCount(), fs.getFileStatus(path).getModificationTime()))
    return tuple(out)


def pipeline_for(spark: SparkSession, sf_dir: str) -> FeedPipeline:
    """One pipeline per (session, input folder): its materialised stage tables
    (raw feed, scored crosswalk pairs, typed lines) are built on first use and
    shared by every query, like the stage tables of the batch pipeline."""
    key = (id(spark), spark.sparkContext.applicationId, sf_dir, _fingerprint(spark, sf_dir))
    p = _PIPELINES.get(key)
    if p is None:
        p = _PIPELINES[key] = FeedPipeline(spark, sf_dir)
    return p


def queries() -> dict[str, Query]:
    def bind(fn):
        return lambda spark, sf_dir: fn(pipeline_for(spark, sf_dir))
    return {name: bind(fn) for name, fn in REGISTRY.items()}
