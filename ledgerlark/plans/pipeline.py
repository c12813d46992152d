"""Composition of the stages over one input folder.

``FeedPipeline`` wires adapters -> crosswalk -> clean -> daily -> board /
statistics as lazy DataFrames. Nothing runs until a caller acts (a write, a
count, the driver's collect). ``run`` materialises the stage tables in the
order the reference pipeline builds them, each written once and re-read, so
later stages start from files rather than from lineage.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark import schemas
from ledgerlark.operators import cleaning, crosswalk, daily, kpi, monitor, quality, stats
from ledgerlark.plans import adapters
from ledgerlark.session import cut_lineage, shuffles_dropped
from ledgerlark.sources import feed_csv, reference, weather_json


class FeedPipeline:
    """``materialize=True`` writes the frames that many queries read -- the raw
    feed (raw_orders), the crosswalk's scored pairs (for queries over all of them), the typed order lines
    with those of repeated keys tagged (clean_orders + rejected_rows), daily_sales, the board's enriched lines
    and the per-file quality facts -- once as parquet tables under the shared ``spark.checkpoint.dir``
    and reads them back: the stage tables of the batch pipeline."""

    def __init__(self, spark: SparkSession, sf_dir: str | None = None, materialize: bool = True,
                 inputs: dict[str, DataFrame | None] | None = None):
        """``inputs``: frames (raw, headers, products, new_products, stores,
        weather or pulls) in place of those derived from ``sf_dir``."""
        self.spark = spark
        self.sf_dir = sf_dir
        self.materialize = materialize
        self.inputs = inputs or {}

    @classmethod
    def from_files(cls, spark: SparkSession, feed: str, products: str, new_products: str, stores: str,
                   pulls: str | None = None, ingested_at: str | None = None, materialize: bool = True) -> FeedPipeline:
        """Over real files: daily feed CSVs, the catalog and store CSVs, and the
        cached weather pulls. The weather used is the pull whose range is that
        of the clean orders."""
        return cls(spark, materialize=materialize, inputs={
            "raw": feed_csv.read_orders(spark, feed, ingested_at),
            "headers": feed_csv.file_headers(spark, feed),
            "products": reference.read_catalog(spark, products),
            "new_products": reference.read_catalog(spark, new_products),
            "stores": reference.read_text_csv(spark, stores),
            "pulls": weather_json.read_pulls(spark, pulls) if pulls else None})

    def _cut(self, df: DataFrame, name: str) -> DataFrame:
        if not self.materialize:
            return df
        return cut_lineage(df, name)

    # ---- inputs -------------------------------------------------------
    @cached_property
    def raw(self) -> DataFrame:
        # the raw feed plays the role of the stored raw_orders table
        if "raw" in self.inputs:
            return self._cut(self.inputs["raw"], "raw")
        return self._cut(adapters.feed(self.spark, self.sf_dir), "raw")

    @cached_property
    def headers(self) -> DataFrame:
        if "headers" in self.inputs:
            return self.inputs["headers"]
        return adapters.feed_headers(self.raw)

    @cached_property
    def products(self) -> DataFrame:
        if "products" in self.inputs:
            return self.inputs["products"]
        return self._cut(adapters.products(self.spark, self.sf_dir), "products")

    @cached_property
    def new_products(self) -> DataFrame:
        if "new_products" in self.inputs:
            return self.inputs["new_products"]
        return self._cut(adapters.new_products(self.spark, self.sf_dir), "new_products")

    @cached_property
    def stores(self) -> DataFrame:
        if "stores" in self.inputs:
            return self.inputs["stores"]
        return adapters.stores(self.spark, self.sf_dir)

    @cached_property
    def weather(self) -> DataFrame | None:
        # the weather_daily table
        if "weather" in self.inputs:
            return self.inputs["weather"]
        if "pulls" in self.inputs:
            pulls = self.inputs["pulls"]
            return None if pulls is None else self._cut(
                weather_json.select_snapshot(pulls, self.clean).select(*[f.name for f in schemas.WEATHER_DAILY]),
                "weather_daily")
        return self._cut(adapters.weather_daily(self.spark, self.sf_dir), "weather_daily")

    @cached_property
    def pulls(self) -> DataFrame:
        return adapters.weather_pulls(self.spark, self.sf_dir, self.weather)

    # ---- stages ---------------------------------------------------------
    @cached_property
    def scored(self) -> DataFrame:
        # tier-2 candidate pairs with their similarity scores (the only UDF work)
        return self._cut(crosswalk.scored_candidates(self.products, self.new_products), "scored_pairs")

    @cached_property
    def best_two(self) -> DataFrame:
        # the two best of each legacy row; a hot block's pairs aren't all scored
        return crosswalk.best_two(self.products, self.new_products)

    @cached_property
    def crosswalk(self) -> DataFrame:
        # the product_crosswalk table: catalog-sized, read by every stage below
        return self._cut(crosswalk.build_crosswalk(self.products, self.new_products, keep_pos=True,
                                                   ranked=self.best_two), "product_crosswalk")

    @cached_property
    def lines(self) -> DataFrame:
        # with the mark of repeated keys: tagging filters on it and on parsed amounts
        # and the load position only where tagging reads it; the product of two
        # stored columns is taken as lines are read
        marked = cleaning.mark_repeated(self.raw, cleaning.typed_lines_apart(self.raw, self.crosswalk))
        marked = marked.withColumn("raw_id", F.when(F.col("repeated"), F.col("raw_id")))
        lines = self._cut(cleaning.typed_lines_apart(marked, self.crosswalk).drop("line_revenue"), "typed_lines")
        return lines.withColumn("line_revenue", cleaning.line_revenue(F.col("quantity"), F.col("unit_price")))

    @cached_property
    def tagged(self) -> DataFrame:
        # most rows are tagged as they are read; only the others are written again
        once, several = cleaning.tag_parts(self.lines)
        return once.drop("raw_id").unionByName(self._cut(several.drop("raw_id"), "repeated_lines"))

    @cached_property
    def clean(self) -> DataFrame:
        return cleaning.clean_orders(self.tagged)

    @cached_property
    def rejected(self) -> DataFrame:
        return cleaning.rejected_rows(self.tagged)

    @cached_property
    def daily(self) -> DataFrame:
        return self._cut(daily.daily_sales(self.clean, self.new_products, self.products, self.weather),
                         "daily_sales")

    @cached_property
    def enriched(self) -> DataFrame:
        # the board's base frame, built once and shared by every tile; its money follows
        # from stored columns as lines are read, so it is neither moved nor stored
        lines = kpi.enriched_lines(self.clean, self.new_products, self.products, self.daily,
                                   few_days=self.materialize and kpi.few_store_days(self.daily))
        stored = self._cut(lines.drop("net_revenue", "gross_revenue", "discount_given"), "enriched_lines")
        return kpi.with_money(stored.withColumn(
            "net_revenue", cleaning.line_revenue(F.col("quantity"), F.col("unit_price"))))

    @cached_property
    def board(self):
        return kpi.board_frames(self.daily, self.enriched)

    @cached_property
    def store_days(self) -> DataFrame:
        # one row a store-day, read by every statistic, some several times
        return self._cut(stats.store_days(self.daily), "store_days")

    @cached_property
    def file_stats(self) -> DataFrame:
        # one row per file: the quality-log stage, read by seven queries
        s, p = quality.reference_sets(self.stores, self.products, self.new_products)
        return self._cut(quality.file_stats(self.raw, self.headers, s, p), "file_stats")

    @cached_property
    def file_status(self) -> DataFrame:
        return quality.file_status(self.file_stats)

    @cached_property
    def dq_report(self) -> DataFrame:
        # checked on arrival: the run date is the file's own date
        return quality.dq_report(self.file_stats, run_date=F.col("expected"))

    @cached_property
    def ingestion_log(self) -> DataFrame:
        return monitor.ingestion_log_new(self.file_status, monitor.content_digest(self.raw, quality.DATA_COLUMNS))

    # ---- materialisation ------------------------------------------------
    def run(self, out_dir: str, fmt: str = "parquet") -> dict[str, str]:
        """Write every stage table under ``out_dir`` (a shared folder on a
        cluster) and re-read it for the next stage. Returns table -> path."""
        paths = {}

        def put(name: str, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
            path = f"{out_dir}/{name}"
            w = df.write.mode("overwrite").format(fmt)
            if partition_by:
                w = w.partitionBy(*partition_by)
            with shuffles_dropped(self.spark):
                w.save(path)
            paths[name] = path
            return self.spark.read.format(fmt).load(path)

        def by_month(df: DataFrame) -> DataFrame:
            # date-range slices (board filters, windows) prune month folders
            return df.withColumn("order_month", F.substring("order_date", 1, 7))

        self.raw = put("raw_orders", self.raw)
        for name in ("stores", "products", "new_products"):
            if getattr(self, name) is not None:
                setattr(self, name, put(name, getattr(self, name)))
        put("ingestion_log", self.ingestion_log)
        put("data_quality_log", self.dq_report)
        self.best_two = put("scored_pairs", self.best_two)
        self.crosswalk = put("product_crosswalk", self.crosswalk)
        self.tagged = put("tagged_orders", self.tagged)
        put("clean_orders", by_month(self.clean), ["order_month"])
        put("rejected_rows", self.rejected)
        self.clean = self.spark.read.format(fmt).load(paths["clean_orders"]).drop("order_month")
        if self.weather is not None:
            self.weather = put("weather_daily", self.weather)
        put("daily_sales", by_month(self.daily), ["order_month"])
        self.daily = self.spark.read.format(fmt).load(paths["daily_sales"]).drop("order_month")
        return paths
