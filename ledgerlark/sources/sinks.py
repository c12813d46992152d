"""Table creation, writers and audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark import schemas
from ledgerlark.session import shuffles_dropped


COMPRESSED = {"compression": "zstd"}     # some 0.7 of Spark's default, at no more time


def create_tables(spark: SparkSession, database: str | None = None,
                  tables: dict[str, T.StructType] | None = None) -> list[str]:
    """``CREATE TABLE IF NOT EXISTS ... USING parquet`` from the schemas;
    re-runnable."""
    made = []
    for name, st in (tables or schemas.TABLES).items():
        full = f"{database}.{name}" if database else name
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in st.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {full} ({cols}) USING parquet")
        made.append(full)
    return made


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project and cast to a declared schema (missing columns become NULL)."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields])


def replace_table(df: DataFrame, name: str) -> None:
    """Drop-and-recreate semantics (overwrite with the frame's schema)."""
    with shuffles_dropped(df.sparkSession):
        df.write.mode("overwrite").options(**COMPRESSED).option("overwriteSchema", "true").saveAsTable(name)


def append_table(df: DataFrame, name: str, schema: T.StructType | None = None) -> None:
    """Append (conformed to the declared schema when given)."""
    with shuffles_dropped(df.sparkSession):
        (conform(df, schema) if schema is not None else df).write.mode("append").options(**COMPRESSED).saveAsTable(name)


def mirror_log(spark: SparkSession, csv_path: str, table: str) -> None:
    """Refresh a typed log table from its CSV (all rows replaced,
    declared schema kept, ``rows_loaded`` coerced to int)."""
    log = spark.read.option("header", "true").option("inferSchema", "false").csv(csv_path)
    log = log.withColumn("rows_loaded", F.col("rows_loaded").try_cast("int"))
    with shuffles_dropped(spark):
        conform(log, schemas.INGESTION_LOG).write.mode("overwrite").insertInto(table)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with a header row."""
    with shuffles_dropped(df.sparkSession):
        df.write.mode("overwrite").option("header", "true").csv(path)


def table_audit(spark: SparkSession, required: list[str]) -> DataFrame:
    """(table, present, n_rows) for each required table; the per-table
    counts run as Spark jobs, only the small result list is built here."""
    rows = []
    for t in required:
        present = spark.catalog.tableExists(t)
        n = spark.table(t).count() if present else None
        rows.append((t, int(present), n))
    return spark.createDataFrame(rows, "table string, present int, n_rows long")
