"""Reference tables and table copies."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_text_csv(spark: SparkSession, path: str) -> DataFrame:
    """A reference CSV, every column text as in the file's header; an
    empty field is NULL. A missing path gives None (the stage is skipped)."""
    try:
        df = (spark.read.option("header", "true").option("inferSchema", "false")
              .option("nullValue", "").csv(path))
        df.schema  # resolves the path now
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":   # absent file: the stage is skipped
            return None
        raise
    return df.select(*[F.nullif(F.col(c), F.lit("")).alias(c) for c in df.columns])


def read_catalog(spark: SparkSession, path: str) -> DataFrame | None:
    """A product catalog with ``catalog_pos``, its load sequence: ascending
    with the place in the file (files in the order Spark scans them)."""
    df = read_text_csv(spark, path)
    return None if df is None else df.withColumn("catalog_pos", F.monotonically_increasing_id())


def load_reference(spark: SparkSession, paths: dict[str, str], out_dir: str) -> dict[str, int | None]:
    """Full replace of each present reference table under ``out_dir``;
    absent ones are skipped. Returns table -> rows written (None = skipped)."""
    done: dict[str, int | None] = {}
    for name, path in paths.items():
        df = read_text_csv(spark, path)
        if df is None:
            done[name] = None
            continue
        df.write.mode("overwrite").parquet(f"{out_dir}/{name}")
        done[name] = spark.read.parquet(f"{out_dir}/{name}").count()
    return done


def copy_table(df: DataFrame, sinks: dict[str, callable]) -> dict[str, str]:
    """Read once, fan out to several sinks (CSV snapshot, table copies).

    The source is persisted for the fan-out; one sink failing does not stop
    the others. Returns sink -> "ok" or the error text."""
    cached = df.persist()
    status = {}
    try:
        for name, write in sinks.items():
            try:
                write(cached)
                status[name] = "ok"
            except Exception as ex:  # noqa: BLE001 - per-sink failure is reported
                status[name] = f"failed: {type(ex).__name__}: {ex}"
    finally:
        cached.unpersist()
    return status
