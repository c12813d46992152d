"""What stage tables leave on disk."""

import os

from pyspark.sql import functions as F

from ledgerlark.session import cut_lineage


def shuffle_files(spark):
    env = spark._jvm.org.apache.spark.SparkEnv.get()
    folders = [f.getPath() for f in env.blockManager().diskBlockManager().localDirs()]
    return {f for d in folders for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_")}


def test_a_written_stage_leaves_no_shuffle_files(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, held = shuffle_files(spark), spark.conf.get(key, None)
    df = spark.range(50_000).withColumn("r", F.xxhash64("id")).repartition(5, "r")
    stage = cut_lineage(df.groupBy((F.col("r") % 100).alias("g")).count(), "few")
    assert shuffle_files(spark) <= before
    assert spark.conf.get(key, None) == held
    assert stage.agg(F.sum("count")).first()[0] == 50_000
