"""raw_orders -> clean_orders + rejected_rows.

Input contract (``raw``): the 13 raw text columns plus
  * ``raw_id``  an orderable load position (file arrival, file name, position
    inside the file) -- "first in load order" means smallest ``raw_id``; when
    it is a long it must also be unique (e.g. a sequence assigned at load);
  * ``row_uid`` a unique long per physical row.

Skew: the natural-key de-duplication doesn't sort a key's rows. The
winner per key is ``min(raw_id)`` (a partial, map-side combined aggregate), and only
rows whose key's digest occurs more than once are compared with it; all others
are as they were read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions.numeric import bad_amount, whole, with_numbers
from ledgerlark.operators.key_filter import maybe_among
from ledgerlark.session import cut_lineage

RAW_COLUMNS = [
    "source_file", "ingested_at", "order_id", "order_date", "store_id",
    "product_id", "new_product_id", "product_id_source", "quantity",
    "unit_price", "discount_pct", "sales_channel", "loyalty_member",
]
AMOUNTS = ["quantity", "unit_price", "discount_pct"]
NATURAL_KEY = ["order_id", "order_date", "store_id", "product_key"]
CLEAN_COLUMNS = [
    "order_id", "order_date", "store_id", "product_key", "legacy_product_id",
    "is_new_system", "quantity", "unit_price", "discount_pct", "line_revenue",
    "sales_channel", "loyalty_member", "source_file",
]
REASON_BAD_DATE = "missing_or_bad_order_date"
REASON_AMOUNT = "amount_out_of_range"
REASON_DUPLICATE = "duplicate_natural_key"


def _has_long_ids(df: DataFrame) -> bool:
    from pyspark.sql.types import IntegerType, LongType
    return isinstance(df.schema["raw_id"].dataType, (LongType, IntegerType))


def crosswalk_map(crosswalk: DataFrame) -> DataFrame:
    """D4 lookup: legacy id -> mapped new id, only rows with a mapped id; one
    row per legacy id (a repeated legacy id keeps the last catalog row)."""
    cw = crosswalk.where(F.col("new_product_id").isNotNull())
    if "catalog_pos" in cw.columns:
        agg = F.max_by("new_product_id", "catalog_pos")
    else:
        agg = F.max("new_product_id")
    return cw.groupBy("product_id").agg(agg.alias("_mapped_id"))


def _identity() -> tuple[Column, Column]:
    """D3: the id a row gives, and whether it is one of the new system (never NULL)."""
    raw_val = F.coalesce("new_product_id", "product_id")
    is_new = (F.coalesce(F.col("product_id_source") == "new_system", F.lit(False))
              | F.col("new_product_id").isNotNull()
              | F.coalesce(raw_val.startswith("NP"), F.lit(False)))
    return raw_val, is_new


def resolve_products(raw: DataFrame, crosswalk: DataFrame | None = None) -> DataFrame:
    """Resolve product identity by value and flag, never by header.

    Adds ``raw_val``, ``is_new`` (boolean), ``product_key``, ``legacy_product_id``.
    """
    raw_val, is_new = _identity()
    df = raw.withColumn("raw_val", raw_val).withColumn("is_new", is_new)
    if crosswalk is not None:
        m = crosswalk_map(crosswalk).withColumnRenamed("product_id", "_legacy_key")
        df = df.join(m, df.raw_val == m._legacy_key, "left").drop("_legacy_key")
        mapped = F.coalesce("_mapped_id", "raw_val")
    else:
        df = df.withColumn("_mapped_id", F.lit(None).cast("string"))
        mapped = F.col("raw_val")
    return (df.withColumn("product_key", F.when(F.col("is_new"), F.col("raw_val")).otherwise(mapped))
              # a row without new_product_id has its product_id as raw_val
              .withColumn("legacy_product_id", F.when(~F.col("is_new"), F.col("raw_val")))
              .drop("_mapped_id"))


def line_revenue(quantity: Column, unit_price: Column) -> Column:
    return quantity.cast("double") * unit_price


def typed_lines(raw: DataFrame, crosswalk: DataFrame | None = None) -> DataFrame:
    """D1-D7 applied to every raw row (nothing filtered yet)."""
    # numbers first: they are narrower than texts where the lookup moves rows
    df = with_numbers(raw, AMOUNTS)
    df = df.withColumn("_quantity", whole(F.col("_quantity")))
    df = df.withColumn("_loyalty", F.when(F.col("loyalty_member") == "Y", 1).when(F.col("loyalty_member") == "N", 0))
    df = resolve_products(df, crosswalk)
    q, price = F.col("_quantity"), F.col("_unit_price")
    return df.select(
        "raw_id", "row_uid",
        "order_id", "order_date", "store_id", "product_key", "legacy_product_id",
        F.col("is_new").cast("int").alias("is_new_system"),
        q.alias("quantity"),
        price.alias("unit_price"),
        F.col("_discount_pct").alias("discount_pct"),
        line_revenue(q, price).alias("line_revenue"),
        "sales_channel",
        F.col("_loyalty").alias("loyalty_member"),
        "source_file",
        *[c for c in ("repeated",) if c in raw.columns],
    )


def typed_lines_apart(raw: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """:func:`typed_lines`, in which only lines with a legacy id, the only ones whose key
    the crosswalk decides, are moved for its join."""
    raw_val, is_new = _identity()
    looked_up = ~is_new & raw_val.isNotNull()
    return typed_lines(raw.where(~looked_up)).unionByName(typed_lines(raw.where(looked_up), crosswalk))


def tag_rows(raw: DataFrame, crosswalk: DataFrame | None = None) -> DataFrame:
    """Every typed row with ``reject_reason`` (NULL = clean).

    D8 bad date first; D9 natural-key de-duplication on the rest, keeping the
    first row in load order (NULLs compare equal inside the key).
    """
    return tag_lines(typed_lines(raw, crosswalk))


def mark_repeated(rows: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """``rows`` with ``repeated``: all rows of a natural key that occurs more than once
    are marked, and few others (of equal digests, of a repeated key's order, date and
    store, or that the bounded filter lets pass; rows that are rejected for their amounts).
    Keys are counted by digests, so nothing but those is moved: rows are
    marked where they are. ``lines``: the typed lines that rows without a resolved product
    become; the mark goes by the columns that both have."""
    lines = rows if lines is None else lines
    part = F.xxhash64(*[c for c in NATURAL_KEY if c in rows.columns])
    rest = [F.xxhash64(c).alias(f"_{c}") for c in NATURAL_KEY if c not in rows.columns]
    often = (lines.select(part.alias("_part"), *rest).groupBy("_part", *[f"_{c}" for c in NATURAL_KEY if c not in rows.columns])
             .agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_part"))
    passes = maybe_among(cut_lineage(often, "repeated_digests"))
    return rows.withColumn("repeated", passes(part))


def tag_parts(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """D8 + D9 over marked lines: (the rows that are alone with their key, the
    rows that may not be). Only the second are grouped and joined; callers that read
    them more than once pass them on as a table."""
    bad_date = F.col("order_date").isNull() | (F.col("order_date") == "")
    absurd = bad_amount(F.col("unit_price"), F.col("line_revenue"), F.col("discount_pct"))
    reason = F.when(bad_date, REASON_BAD_DATE).when(absurd, REASON_AMOUNT)
    once = marked.where(~F.col("repeated")).drop("repeated").withColumn("reject_reason", reason)
    # raw_id alone is the row id where it is a unique load sequence
    row = F.col("raw_id") if _has_long_ids(marked) else F.struct("raw_id", "row_uid")
    several = marked.where("repeated").drop("repeated").withColumn("_row", row)
    # equal digests of different keys part here
    first = (several.where(~bad_date & ~absurd).groupBy(*NATURAL_KEY)
             .agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
             .select(*[F.col(c).alias(f"_k_{c}") for c in NATURAL_KEY], "_first"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in NATURAL_KEY])
    several = (several.join(first, same, "left")
               .withColumn("reject_reason", F.coalesce(reason, F.when(F.col("_row") != F.col("_first"), F.lit(REASON_DUPLICATE))))
               .drop(*[f"_k_{c}" for c in NATURAL_KEY], "_row", "_first"))
    return once, several


def tag_lines(lines: DataFrame) -> DataFrame:
    """D8 + D9 over typed lines; lines whose amounts are beyond what money is
    summed in are rejected between the two, so one absurd price stops no table. Lines that
    aren't marked yet (``mark_repeated``) are marked and stored first, so their lineage runs twice:
    for the keys, and for the whole rows."""
    if "repeated" not in lines.columns:
        lines = cut_lineage(mark_repeated(lines), "marked_lines")
    once, several = tag_parts(lines)
    return once.unionByName(several)


def clean_orders(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col("reject_reason").isNull()).select(*CLEAN_COLUMNS)


def rejected_rows(tagged: DataFrame) -> DataFrame:
    """source_file, reason, order_id, raw_json (the cleaned row as JSON
    with every value rendered as text; NULL stays JSON null; numbers use a
    fixed 4-decimal rendering)."""
    as_text = []
    for c in CLEAN_COLUMNS:
        if c in ("unit_price", "discount_pct", "line_revenue"):
            as_text.append(F.when(F.col(c).isNotNull(), F.format_string("%.4f", F.col(c))).alias(c))
        else:
            as_text.append(F.col(c).cast("string").alias(c))
    return (tagged.where(F.col("reject_reason").isNotNull())
            .select("source_file", F.col("reject_reason").alias("reason"), "order_id",
                    F.to_json(F.struct(*as_text), {"ignoreNullFields": "false"}).alias("raw_json")))
