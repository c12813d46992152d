"""Incremental feed loading as a file-source stream (A5, B2 replay safety).

``readStream`` over the landing folder discovers new files; each micro-batch
runs the batch logic in ``foreachBatch``: header-by-name projection, date from
the file name, skip dates already present in the raw table, first file with
rows per date within the batch, append, and one log record a file. Because a re-run of an epoch re-checks the
loaded dates, a replay after a failure never loads a date twice, and a late
file (a backfill) is just another new file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.functions.text import date_from_filename
from ledgerlark.session import checkpoint_dir, cut_lineage, read_if_present
from ledgerlark.sources import feed_csv


def _loaded_dates(spark: SparkSession, raw_path: str) -> DataFrame:
    raw = read_if_present(spark, raw_path)
    if raw is None:  # first run: no raw table yet
        return spark.createDataFrame([], "file_date string")
    return raw.select(F.col("file_date").cast("string")).distinct()


def _next_file_rank(spark: SparkSession, raw_path: str) -> int:
    """One past the highest file rank in the raw table (a one-number aggregate)."""
    raw = read_if_present(spark, raw_path)
    top = None if raw is None else raw.agg(F.max("raw_id")).first()[0]
    return 0 if top is None else (int(top) >> feed_csv.POS_BITS) + 1


def load_batch(batch: DataFrame, raw_path: str, ingested_at: str | None = None,
               log_path: str | None = None) -> None:
    """Load the new dates of a batch of files and log every file.

    Of the files of a date that have rows, the one with the smallest name is
    loaded; a header-only file neither hides the day's other file nor counts as
    its load, so the date stays open for a later file. The log under ``log_path``
    (by default beside the raw table) gets one record a file and outcome:
    ``ok``, ``empty``, ``skipped`` (the date was loaded, or another file of the
    date was chosen) or ``failed`` (no date in the name)."""
    spark = batch.sparkSession
    paths = [feed_csv.literal_path(r.file_path) for r in batch.select("file_path").distinct().collect()]
    raw = feed_csv.read_orders(spark, paths, ingested_at, _next_file_rank(spark, raw_path))
    headers = feed_csv.file_headers(spark, paths)
    n_rows = raw.groupBy("source_file").agg(F.count(F.lit(1)).alias("rows_loaded"))
    files = (headers.select("source_file", date_from_filename(F.col("source_file")).alias("file_date"))
             .join(n_rows, "source_file", "left").withColumn("rows_loaded", F.coalesce("rows_loaded", F.lit(0))))
    loaded = _loaded_dates(spark, raw_path)
    todo = (files.where(F.col("file_date").isNotNull() & (F.col("rows_loaded") > 0))
            .join(loaded, "file_date", "left_anti")
            .groupBy("file_date").agg(F.min("source_file").alias("source_file")))
    # one row a file, fixed before the raw table changes
    outcome = cut_lineage(
        files.join(todo.select("source_file", F.lit(True).alias("chosen")), "source_file", "left").select(
            F.col("source_file").alias("file_name"), "file_date",
            F.when(F.col("file_date").isNull(), "failed").when(F.col("rows_loaded") == 0, "empty")
             .when(F.col("chosen"), "ok").otherwise("skipped").alias("status"),
            F.when(F.col("chosen"), F.col("rows_loaded")).otherwise(0).alias("rows_loaded"),
            F.when(F.col("file_date").isNull(), "no date in the file name").otherwise("").alias("error_message")),
        "file-outcomes")
    take = outcome.where("status = 'ok'").select(F.col("file_name").alias("source_file"), "file_date")
    raw.join(take, "source_file").write.mode("append").partitionBy("file_date").parquet(raw_path)
    log_path = log_path or f"{raw_path.rstrip('/')}_log"
    log = read_if_present(spark, log_path)
    if log is not None:  # a replayed batch logs nothing twice
        outcome = outcome.join(log.select("file_name", "status").distinct(), ["file_name", "status"], "left_anti")
    outcome.write.mode("append").parquet(log_path)


def start(spark: SparkSession, landing_dir: str, raw_path: str, checkpoint: str | None = None,
          ingested_at: str | None = None):
    """Process every file currently in ``landing_dir`` (availableNow) and stop.

    ``checkpoint`` defaults to a folder under the session's shared
    ``spark.checkpoint.dir``."""
    ckpt = checkpoint or f"{checkpoint_dir(spark)}/feed-stream"
    stream = feed_csv.file_cells(feed_csv.csv_options(spark.readStream)
                                 .option("pathGlobFilter", "*.csv").csv(landing_dir))
    q = (stream.writeStream
         .foreachBatch(lambda df, epoch: load_batch(df, raw_path, ingested_at))
         .option("checkpointLocation", ckpt)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    return q
