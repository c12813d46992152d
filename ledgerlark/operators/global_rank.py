"""Ranks over a whole table without a window in one task.

Rows of equal keys are counted first, so ties never lie on two sides of a
border; the distinct keys are range partitioned and written with their
partition's number; a partition's offset is the sum of the counts before it
(one row a partition), and only the places inside a partition come from a
window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.session import cut_lineage


def key_ranks(df: DataFrame, order: dict[str, Column], descending: tuple[str, ...] = ()) -> DataFrame:
    """One row per distinct key (columns of ``order``, named by its keys):
    ``n_tied`` rows with it and ``n_before`` rows ahead of them."""
    n = df.select(*[c.alias(name) for name, c in order.items()]).groupBy(*order).agg(F.count(F.lit(1)).alias("n_tied"))
    by = [F.desc(c) if c in descending else F.asc(c) for c in order]
    # written, so that every reader sees the same partition numbers
    placed = cut_lineage(n.repartitionByRange(*by).withColumn("_p", F.spark_partition_id()), "ranked_keys")
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy("_p").agg(F.sum("n_tied").alias("_n"))      # one row a partition
               .select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")))
    inside = Window.partitionBy("_p").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    return (placed.withColumn("_inside", F.coalesce(F.sum("n_tied").over(inside), F.lit(0)))
            .join(offsets, "_p").select(*order, "n_tied", (F.col("_offset") + F.col("_inside")).alias("n_before")))


def average_ranks(df: DataFrame, value: str, rank: str) -> DataFrame:
    """One row per distinct non-NULL ``value`` with the mean place of its rows."""
    ranks = key_ranks(df.where(F.col(value).isNotNull()), {value: F.col(value)})
    return ranks.select(value, (F.col("n_before") + (F.col("n_tied") + 1) / 2.0).alias(rank))
