"""Cached weather pulls: JSON with a struct of parallel daily arrays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VALUES = ["temperature_2m_max", "temperature_2m_min", "precipitation_sum", "weather_code"]
DAILY = T.StructType([
    T.StructField("time", T.ArrayType(T.StringType())),
    T.StructField("temperature_2m_max", T.ArrayType(T.DoubleType())),
    T.StructField("temperature_2m_min", T.ArrayType(T.DoubleType())),
    T.StructField("precipitation_sum", T.ArrayType(T.DoubleType())),
    T.StructField("weather_code", T.ArrayType(T.LongType())),
])
PULL = T.StructType([
    T.StructField("latitude", T.DoubleType()), T.StructField("longitude", T.DoubleType()),
    T.StructField("timezone", T.StringType()), T.StructField("daily", DAILY),
])
NAME_RE = r"^([^_]+)_(\d{4}-\d{2}-\d{2})_(\d{4}-\d{2}-\d{2})\.json$"


# Fixed value: the weather_source label of archive pulls.
ARCHIVE_SOURCE = "open-meteo-archive"


def read_pulls(spark: SparkSession, paths: list[str] | str, source: str = ARCHIVE_SOURCE) -> DataFrame:
    """One row per store per ``daily.time[i]``; store and range come from
    the cache file name ``{store}_{start}_{end}.json``. Each file is one JSON
    document (one store's date range), parsed with an explicit schema."""
    raw = spark.read.schema(PULL).option("multiLine", "true").json(paths)
    name = F.col("_metadata.file_name")
    docs = raw.select(
        F.regexp_extract(name, NAME_RE, 1).alias("store_id"),
        F.regexp_extract(name, NAME_RE, 2).alias("range_start"),
        F.regexp_extract(name, NAME_RE, 3).alias("range_end"),
        name.alias("pull_file"), "daily")
    return unpack(docs, source)


def unpack(docs: DataFrame, source: str = ARCHIVE_SOURCE) -> DataFrame:
    """Struct of parallel arrays -> one row per index (``arrays_zip`` +
    ``explode``); every other column of ``docs`` is carried along."""
    keep = [c for c in docs.columns if c != "daily"]
    z = docs.select(*keep, F.explode(F.arrays_zip(*[F.col(f"daily.{c}") for c in ["time"] + VALUES])).alias("z"))
    return z.select(
        F.col("z.time").alias("weather_date"), *[c for c in ["store_id"] if c in keep],
        *[F.col(f"z.{c}").alias(c) for c in VALUES[:3]],
        F.col("z.weather_code").cast("int").alias("weather_code"),
        F.lit(source).alias("weather_source"), *[c for c in keep if c != "store_id"])


def pack(rows: DataFrame) -> DataFrame:
    """The inverse shape: one document per (store, range) with ``daily`` as
    parallel arrays in date order (the cache-file layout). A document holds
    one pull's date range, so its arrays are bounded by that range."""
    g = (rows.groupBy("store_id", "range_start", "range_end")
         .agg(F.array_sort(F.collect_list(F.struct("weather_date", *VALUES))).alias("_d")))
    def field(name):
        return lambda x: x[name]
    daily = F.struct(F.transform("_d", field("weather_date")).alias("time"),
                     *[F.transform("_d", field(c)).alias(c) for c in VALUES])
    return g.select("store_id", "range_start", "range_end", daily.alias("daily"))


def select_snapshot(pulls: DataFrame, clean: DataFrame) -> DataFrame:
    """A10: the pull whose range is exactly (min, max) non-empty order_date of
    clean_orders -- the cache key the weather stage asks for."""
    d = F.col("order_date")
    span = (clean.where(d.isNotNull() & (d != ""))
            .agg(F.min(d).alias("range_start"), F.max(d).alias("range_end")))
    return pulls.join(F.broadcast(span), ["range_start", "range_end"])  # span is one row
