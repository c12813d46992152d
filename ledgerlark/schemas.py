"""Explicit schemas of the produced tables."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()


def _st(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


RAW_ORDERS = _st(("raw_id", L), *[(c, S) for c in [
    "source_file", "ingested_at", "order_id", "order_date", "store_id", "product_id",
    "new_product_id", "product_id_source", "quantity", "unit_price", "discount_pct",
    "sales_channel", "loyalty_member"]])
INGESTION_LOG = _st(("run_id", S), ("run_timestamp", S), ("source_url", S), ("source_date_expected", S),
                    ("source_date_found", S), ("status", S), ("rows_loaded", I), ("file_hash", S),
                    ("error_message", S))
DATA_QUALITY_LOG = _st(("run_date", S), ("file_name", S), ("n_rows", L), ("product_col", S),
                       ("has_source_flag", I),
                       *[(c, L) for c in ["na_order_id", "na_order_date", "na_store_id", "na_product",
                                          "na_quantity", "na_unit_price", "na_discount_pct",
                                          "na_sales_channel", "na_loyalty", "dup_rows", "dup_order_id",
                                          "neg_quantity", "neg_unit_price", "bad_discount",
                                          "orphan_store", "orphan_product"]],
                       ("flags", S))
STORES = _st(("store_id", S), ("store_name", S), ("city", S), ("state", S), ("latitude", D),
             ("longitude", D), ("region", S), ("store_type", S), ("opened_date", S))
PRODUCTS = _st(("product_id", S), ("product_name", S), ("category", S), ("subcategory", S), ("brand", S),
               ("base_price", S), ("margin_rate", S), ("launch_date", S), ("active", S))
NEW_PRODUCTS = _st(("new_product_id", S), ("item_name", S), ("department", S), ("class", S),
                   ("brand_name", S), ("msrp", S), ("gross_margin", S), ("launch_date", S), ("active", S))
PRODUCT_CROSSWALK = _st(("product_id", S), ("new_product_id", S), ("match_status", S),
                        ("match_confidence", S), ("match_method", S), ("notes", S), ("needs_review", I))
WEATHER_DAILY = _st(("weather_date", S), ("store_id", S), ("temperature_2m_max", D),
                    ("temperature_2m_min", D), ("precipitation_sum", D), ("weather_code", I),
                    ("weather_source", S))
REJECTED_ROWS = _st(("source_file", S), ("reason", S), ("order_id", S), ("raw_json", S))
CLEAN_ORDERS = _st(("order_id", S), ("order_date", S), ("store_id", S), ("product_key", S),
                   ("legacy_product_id", S), ("is_new_system", I), ("quantity", L), ("unit_price", D),
                   ("discount_pct", D), ("line_revenue", D), ("sales_channel", S), ("loyalty_member", I),
                   ("source_file", S))
DAILY_SALES = _st(("order_date", S), ("store_id", S), ("category", S), ("category_source", S),
                  ("units_sold", L), ("net_revenue", D), ("gross_revenue", D), ("discount_given", D),
                  ("temp_max", D), ("temp_min", D), ("precipitation_sum", D), ("weather_code", I))

TABLES = {
    "raw_orders": RAW_ORDERS, "ingestion_log": INGESTION_LOG, "data_quality_log": DATA_QUALITY_LOG,
    "stores": STORES, "products": PRODUCTS, "new_products": NEW_PRODUCTS,
    "product_crosswalk": PRODUCT_CROSSWALK, "weather_daily": WEATHER_DAILY,
    "rejected_rows": REJECTED_ROWS, "clean_orders": CLEAN_ORDERS, "daily_sales": DAILY_SALES,
}
