"""Per-file data-quality gate (C1-C13) and file classifier.

Inputs
  * ``raw``: feed rows with ``source_file``, the raw text columns (absent
    header columns are NULL) and ``raw_id`` (load order, for first appearance).
  * ``headers``: one row per file (``source_file``, ``header`` array<string>).
    This side also carries header-only files, which have no rows.
  * ``store_ids`` / ``product_ids``: reference key sets (or None).

Every check is an aggregation grouped by file (map-side combined), joined to
the per-file header row; no file's rows are ever gathered into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions.numeric import to_double
from ledgerlark.functions.text import date_from_filename

DATA_COLUMNS = ["order_id", "order_date", "store_id", "product_id", "new_product_id",
                "product_id_source", "quantity", "unit_price", "discount_pct",
                "sales_channel", "loyalty_member"]
NA_COLUMNS = [("na_order_id", "order_id"), ("na_order_date", "order_date"),
              ("na_store_id", "store_id"), ("na_product", None),
              ("na_quantity", "quantity"), ("na_unit_price", "unit_price"),
              ("na_discount_pct", "discount_pct"), ("na_sales_channel", "sales_channel"),
              ("na_loyalty", "loyalty_member")]
DQ_COLUMNS = (["run_date", "file_name", "n_rows", "product_col", "has_source_flag"]
              + [n for n, _ in NA_COLUMNS]
              + ["dup_rows", "dup_order_id", "neg_quantity", "neg_unit_price", "bad_discount",
                 "orphan_store", "orphan_product", "flags"])
NONNUMERIC_ORDER = ["unit_price", "quantity", "discount_pct"]


def _has(col: str) -> Column:
    return F.array_contains(F.col("header"), col)


def _product_col() -> Column:
    """``new_product_id`` if in the header, else ``product_id``."""
    return F.when(_has("new_product_id"), F.lit("new_product_id")).otherwise(F.lit("product_id"))


def found_dates(raw: DataFrame) -> DataFrame:
    """Per file: distinct non-NULL order_date values in first-appearance order,
    ``;``-joined (the single value when there is only one)."""
    firsts = (raw.where(F.col("order_date").isNotNull())
              .groupBy("source_file", "order_date").agg(F.min("raw_id").alias("_p")))
    return (firsts.groupBy("source_file")
            .agg(F.sort_array(F.collect_list(F.struct("_p", "order_date"))).alias("_s"))
            .select("source_file",
                    F.array_join(F.transform("_s", lambda x: x["order_date"]), ";").alias("found")))


def row_digest(columns: list[str]) -> Column:
    """SHA-256 of a row's texts, each ``-`` if NULL, else length and text, so
    only equal rows have equal input (the feed is untrusted: no short hash)."""
    return F.unhex(F.sha2(F.concat(*[
        F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("-")) for c in columns]), 256))


def file_stats(raw: DataFrame, headers: DataFrame, store_ids: DataFrame | None = None,
               product_ids: DataFrame | None = None) -> DataFrame:
    """All per-file facts, one row per file in ``headers``."""
    hdr = headers.select("source_file", "header")
    rows = raw.join(hdr, "source_file", "left")
    prod_val = F.when(_has("new_product_id"), F.col("new_product_id")).otherwise(F.col("product_id"))
    rows = rows.withColumn("_prod", prod_val)
    if store_ids is not None:
        s = store_ids.select(F.col("store_id").alias("_sid")).distinct().withColumn("_s_ok", F.lit(True))
        rows = rows.join(s, rows.store_id == s._sid, "left").drop("_sid")
    if product_ids is not None:
        p = product_ids.select(F.col("product_id").alias("_pid")).distinct().withColumn("_p_ok", F.lit(True))
        rows = rows.join(p, rows._prod == p._pid, "left").drop("_pid")
    # parse each numeric column once, then aggregate plain columns
    rows = rows.select("*", *[to_double(F.col(c), strip_currency=False).alias(f"_num_{c}")
                              for c in NONNUMERIC_ORDER])
    q, pr, d = F.col("_num_quantity"), F.col("_num_unit_price"), F.col("_num_discount_pct")
    aggs = [F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col("_prod").isNull()).alias("_na_prod")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"_na_{c}") for _, c in NA_COLUMNS if c]
    aggs += [F.count_if(q < 0).alias("neg_quantity"), F.count_if(pr < 0).alias("neg_unit_price"),
             F.count_if((d < 0) | (d > 100)).alias("bad_discount")]
    aggs += [F.count_if(F.col(c).isNotNull() & F.col(f"_num_{c}").isNull()).alias(f"_nn_{c}")
             for c in NONNUMERIC_ORDER]
    if store_ids is not None:
        aggs.append(F.count_if(F.col("_s_ok").isNull()).alias("_orphan_store"))
    if product_ids is not None:
        aggs.append(F.count_if(F.col("_p_ok").isNull()).alias("_orphan_product"))
    per_file = rows.groupBy("source_file").agg(*aggs)
    # rows are counted by digest, so no full row is shuffled; repeated order ids
    # are then counted from that (much smaller) result
    distinct_rows = (raw.select("source_file", "order_id", row_digest(DATA_COLUMNS).alias("_row"))
                     .groupBy("source_file", "order_id", "_row").count())
    dup_rows = distinct_rows.groupBy("source_file").agg(F.sum(F.col("count") - 1).alias("dup_rows"))
    dup_ids = (distinct_rows.groupBy("source_file", "order_id").agg(F.sum("count").alias("count"))
               .groupBy("source_file").agg(F.sum(F.col("count") - 1).alias("dup_order_id")))
    out = (hdr.join(per_file, "source_file", "left")
           .join(dup_rows, "source_file", "left")
           .join(dup_ids, "source_file", "left")
           .join(found_dates(raw), "source_file", "left"))
    zero = F.lit(0).cast("long")
    for c in ["n_rows", "dup_rows", "dup_order_id", "neg_quantity", "neg_unit_price", "bad_discount"]:
        out = out.withColumn(c, F.coalesce(F.col(c), zero))
    return (out.withColumn("found", F.coalesce(F.col("found"), F.lit("")))
               .withColumn("expected", date_from_filename(F.col("source_file")))
               .withColumn("refs_loaded", F.lit(store_ids is not None and product_ids is not None)))


def file_status(stats: DataFrame) -> DataFrame:
    """B1: (file, status, rows, found). Empty -> ``empty`` with found ''.
    ``stale`` whenever an expected date exists and differs from found (an
    all-NULL date column therefore reads stale); otherwise ``success``."""
    n = F.col("n_rows")
    found = F.when(n == 0, F.lit("")).otherwise(F.col("found"))
    status = (F.when(n == 0, "empty")
              .when(F.col("expected").isNotNull() & (found != F.col("expected")), "stale")
              .otherwise("success"))
    return stats.select(F.col("source_file").alias("file_name"), F.col("expected").alias("expected_date"),
                        status.alias("status"), n.alias("rows_loaded"), found.alias("found_date"))


def dq_report(stats: DataFrame, run_date: Column | None = None) -> DataFrame:
    """The 22-column quality row per file.

    ``na_*`` are NULL when the column is absent from the header; orphan
    counts are NULL when reference sets are not loaded or the file is empty.
    """
    n = F.col("n_rows")
    has_rows = n > 0
    pcol = _product_col()
    na = []
    for name, c in NA_COLUMNS:
        if c is None:
            na.append(F.when(F.array_contains(F.col("header"), pcol), F.col("_na_prod")).alias(name))
        else:
            na.append(F.when(_has(c), F.coalesce(F.col(f"_na_{c}"), F.lit(0).cast("long"))).alias(name))
    refs = F.col("refs_loaded")
    cols = stats.columns
    o_store = (F.when(refs & has_rows & _has("store_id"), F.col("_orphan_store"))
               if "_orphan_store" in cols else F.lit(None).cast("long"))
    o_prod = (F.when(refs & has_rows & F.array_contains(F.col("header"), pcol), F.col("_orphan_product"))
              if "_orphan_product" in cols else F.lit(None).cast("long"))
    nn_parts = [F.when(F.col(f"_nn_{c}") > 0, F.concat(F.lit(f"{c}="), F.col(f"_nn_{c}").cast("string")))
                for c in NONNUMERIC_ORDER]
    nn = F.array_join(F.filter(F.array(*nn_parts), lambda x: x.isNotNull()), ",")
    found = F.col("found")
    stale = (has_rows & _has("order_date") & F.col("expected").isNotNull() & (found != "")
             & (found != F.col("expected")))
    flag_list = F.array(
        F.when(~has_rows, F.lit("empty")),
        F.when(pcol == "new_product_id", F.lit("schema_new_product_col")),
        F.when(_has("product_id_source"), F.lit("header_mislabeled_product")),
        F.when(stale, F.concat(F.lit("stale(expected="), F.col("expected"), F.lit(",found="), found, F.lit(")"))),
        F.when((F.col("dup_rows") > 0) | (F.col("dup_order_id") > 0), F.lit("duplicates")),
        F.when((F.col("neg_quantity") > 0) | (F.col("neg_unit_price") > 0) | (F.col("bad_discount") > 0),
               F.lit("out_of_range")),
        F.when(has_rows & (nn != ""), F.concat(F.lit("nonnumeric("), nn, F.lit(")"))),
        F.when(~refs, F.lit("ref_not_loaded")),
        F.when((F.coalesce(o_store, F.lit(0)) > 0) | (F.coalesce(o_prod, F.lit(0)) > 0), F.lit("orphans")),
    )
    flags = F.array_join(F.filter(flag_list, lambda x: x.isNotNull()), ";")
    rd = run_date if run_date is not None else F.date_format(F.current_date(), "yyyy-MM-dd")
    return stats.select(
        rd.alias("run_date"), F.col("source_file").alias("file_name"), n.alias("n_rows"),
        F.when(has_rows, pcol).otherwise(F.lit("")).alias("product_col"),
        _has("product_id_source").cast("int").alias("has_source_flag"),
        *na,
        "dup_rows", "dup_order_id", "neg_quantity", "neg_unit_price", "bad_discount",
        o_store.alias("orphan_store"), o_prod.alias("orphan_product"),
        flags.alias("flags"))


def reference_sets(stores: DataFrame | None, products: DataFrame | None,
                   new_products: DataFrame | None):
    """(store_ids, product_ids) or (None, None) unless both non-empty.

    Only tiny ``isEmpty`` probes reach the driver."""
    if stores is None or products is None:
        return None, None
    s = stores.select("store_id").where(F.col("store_id").isNotNull())
    p = products.select("product_id")
    if new_products is not None:
        p = p.unionByName(new_products.select(F.col("new_product_id").alias("product_id")))
    p = p.where(F.col("product_id").isNotNull())
    if s.isEmpty() or p.isEmpty():
        return None, None
    return s, p


def dq_flag_diff(current: DataFrame, logged: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Re-verify history. Compares *sets* of flags per file between the
    current gate (``current``: file_name, flags) and the log (``logged``). A
    difference is ``known`` only when nothing was removed and the only added
    flag equals the allowlisted one for that file; other differences are
    ``unexpected``. Files whose sets agree are not returned."""
    def as_set(c):
        return F.array_sort(F.array_distinct(F.filter(F.split(F.coalesce(c, F.lit("")), ";"),
                                                      lambda x: x != "")))
    now = current.select("file_name", as_set(F.col("flags")).alias("now"))
    was = logged.select("file_name", as_set(F.col("flags")).alias("was"))
    j = now.join(was, "file_name", "left").withColumn("was", F.coalesce("was", F.array().cast("array<string>")))
    j = (j.withColumn("added", F.array_sort(F.array_except("now", "was")))
          .withColumn("removed", F.array_sort(F.array_except("was", "now")))
          .where((F.size("added") > 0) | (F.size("removed") > 0)))
    if known is not None:
        j = j.join(known.select("file_name", F.col("flag").alias("_known")), "file_name", "left")
    else:
        j = j.withColumn("_known", F.lit(None).cast("string"))
    is_known = ((F.size("removed") == 0) & (F.size("added") == 1)
                & F.coalesce(F.col("added")[0] == F.col("_known"), F.lit(False)))
    return j.select("file_name", F.array_join("added", ";").alias("added"),
                    F.array_join("removed", ";").alias("removed"),
                    F.when(is_known, "known").otherwise("unexpected").alias("classification"))
