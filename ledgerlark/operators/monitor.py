"""Ingestion monitoring (B2-B6) and incremental-load selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions.text import calendar_day, date_from_filename

INGESTION_COLUMNS = ["run_id", "run_timestamp", "source_url", "source_date_expected",
                     "source_date_found", "status", "rows_loaded", "file_hash", "error_message"]


def row_digest_columns(cols: list[str]) -> Column:
    """Text image of a row: fields joined by U+0001, NULL as U+0000."""
    return F.concat_ws("\u0001", *[F.coalesce(F.col(c), F.lit("\u0000")) for c in cols])


def content_digest(raw: DataFrame, cols: list[str]) -> DataFrame:
    """Order-independent content fingerprint per file: the sums of both halves
    of each row's MD5, as decimal text. Unlike a byte hash it needs no
    task to see the whole file, so it works for files of any size; two files
    with the same multiset of rows get the same digest."""
    md5 = F.md5(row_digest_columns(cols))
    half = lambda at: F.sum(F.conv(F.substring(md5, at, 16), 16, 10).cast("decimal(20,0)")).cast("string")
    return (raw.groupBy("source_file")
            .agg(F.concat_ws("-", half(1), half(17)).alias("file_hash")))


def first_file_per_date(files: DataFrame, date_col: str = "file_date") -> DataFrame:
    """One file per date: the smallest file name (a NULL date is one group)."""
    return (files.groupBy(date_col)
            .agg(F.min("file_name").alias("file_name"))
            .join(files.drop(date_col), "file_name"))


def ingestion_log_new(status: DataFrame, hashes: DataFrame | None = None,
                      logged_dates: DataFrame | None = None,
                      source_url: str = "", run_timestamp: Column | None = None) -> DataFrame:
    """B2: one log record per date not yet logged (a date logged ``failed``
    counts as logged). ``status`` is :func:`quality.file_status` output."""
    s = status.withColumn("file_date", F.col("expected_date"))
    if logged_dates is not None:
        ld = logged_dates.select(F.col("source_date_expected").alias("file_date")).distinct()
        s = s.join(ld, s.file_date.eqNullSafe(ld.file_date), "left_anti")
    s = first_file_per_date(s)
    if hashes is not None:
        s = s.join(hashes.withColumnRenamed("source_file", "file_name"), "file_name", "left")
    else:
        s = s.withColumn("file_hash", F.lit(None).cast("string"))
    ts = run_timestamp if run_timestamp is not None else F.date_format(
        F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return s.select(
        F.sha2(F.concat_ws("|", F.col("file_name"), F.coalesce("file_hash", F.lit(""))), 256)
         .substr(1, 32).alias("run_id"),
        ts.alias("run_timestamp"), F.lit(source_url).alias("source_url"),
        F.col("file_date").alias("source_date_expected"),
        F.col("found_date").alias("source_date_found"),
        "status", F.col("rows_loaded").cast("int").alias("rows_loaded"),
        "file_hash", F.lit("").alias("error_message"))


def failed_attempt(expected_date: Column, error: Column, run_timestamp: Column,
                   source_url: str = "") -> list[Column]:
    """The columns of a failed-attempt record (rows 0, hash blank)."""
    return [F.sha2(F.concat_ws("|", expected_date, error), 256).substr(1, 32).alias("run_id"),
            run_timestamp.alias("run_timestamp"), F.lit(source_url).alias("source_url"),
            expected_date.alias("source_date_expected"), F.lit("").alias("source_date_found"),
            F.lit("failed").alias("status"), F.lit(0).alias("rows_loaded"),
            F.lit("").alias("file_hash"), error.alias("error_message")]


def failed_records(unreadable: DataFrame, run_timestamp: Column | None = None,
                   source_url: str = "") -> DataFrame:
    """One ``failed`` ingestion record per unreadable file (file_name,
    file_date, error) -- rows 0, hash blank; the run continues."""
    ts = run_timestamp if run_timestamp is not None else F.date_format(
        F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return unreadable.select(*failed_attempt(F.col("file_date"), F.col("error"), ts, source_url))


def missing_days(log: DataFrame) -> DataFrame:
    """Calendar days between the first and last logged date with no record.

    The generated calendar is bounded by the date span, not by data volume.
    File names with an impossible date are no day, neither logged nor missing."""
    d = calendar_day(F.col("source_date_expected"))
    span = log.agg(F.min(d).alias("lo"), F.max(d).alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi")).alias("day"))
    have = log.select(d.alias("day")).where(F.col("day").isNotNull()).distinct()
    return (days.join(have, "day", "left_anti")
            .select(F.col("day").cast("string").alias("missing_date"), F.lit("missing").alias("status")))


def republished(log: DataFrame) -> DataFrame:
    """Days whose file hash equals the previous calendar day's hash
    (an identical re-publish). Equi-join on (day - 1), no global window; a file
    name with an impossible date has no day before it."""
    cur = log.select(F.col("source_date_expected").alias("date"),
                     calendar_day(F.col("source_date_expected")).alias("_d"), "file_hash")
    prev = log.select(calendar_day(F.col("source_date_expected")).alias("_pd"),
                      F.col("file_hash").alias("_ph"))
    j = cur.join(prev, (F.date_sub(cur._d, 1) == prev._pd) & (cur.file_hash == prev._ph))
    return j.select("date", F.col("_pd").cast("string").alias("previous_date"), "file_hash")


def pending_files(files: DataFrame, loaded_dates: DataFrame) -> DataFrame:
    """A5: files to load now. A file is skipped when its date is already in
    the raw table; within a run the first file name per date wins, of those
    with rows where ``files`` has ``n_rows`` (a header-only file neither hides
    the day nor loads it, so its date is offered again). Files with no
    recognisable date are returned with status ``undated`` instead of being
    loaded (documented deviation)."""
    if "n_rows" in files.columns:
        files = files.where(F.col("n_rows") > 0)
    f = files.select("file_name").distinct().withColumn("file_date", date_from_filename(F.col("file_name")))
    ld = loaded_dates.select(F.col("file_date").alias("_ld")).distinct()
    todo = f.join(ld, f.file_date == ld._ld, "left_anti")
    dated = first_file_per_date(todo.where(F.col("file_date").isNotNull()))
    undated = todo.where(F.col("file_date").isNull())
    return (dated.withColumn("action", F.lit("load"))
            .unionByName(undated.withColumn("action", F.lit("undated"))))


def unchecked_files(files: DataFrame, dq_log: DataFrame) -> DataFrame:
    """Files never quality-checked (idempotence by file name)."""
    return files.select("file_name").distinct().join(
        dq_log.select("file_name").distinct(), "file_name", "left_anti")
