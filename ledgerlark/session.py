"""SparkSession construction and lineage-cut helpers."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale: AQE re-plans joins with runtime sizes (a join
# side becomes a broadcast only when its *measured* size is under the
# threshold), splits skewed shuffle partitions, and coalesces small ones.
_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # checkpoint files of frames that are no longer referenced are removed
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "ledgerlark", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; locally the
    caller passes ``local[N]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor
        conf["spark.driver.memory"] = os.environ.get("LEDGERLARK_DRIVER_MEMORY", "8g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_CKPT: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins. Only in local mode, where driver and
    executors are one process, may it be unset: a private folder is created,
    registered with ``setCheckpointDir`` and reused for the rest of the
    application. On a cluster that folder would lie on one machine, so an
    unset setting is an error there.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share (master {master})")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_CKPT:
        _LOCAL_CKPT[app] = tempfile.mkdtemp(prefix="ledgerlark-ckpt-")
        spark.sparkContext.setCheckpointDir(_LOCAL_CKPT[app])
    return _LOCAL_CKPT[app]


_STAGE_ROOTS: dict[str, str] = {}


def stage_root(spark: SparkSession) -> str:
    """This application's folder for stage tables under the shared
    checkpoint folder; removed again when the application's Python process
    exits (or by :func:`drop_stage_tables`)."""
    app = spark.sparkContext.applicationId
    if app not in _STAGE_ROOTS:
        _STAGE_ROOTS[app] = f"{checkpoint_dir(spark).rstrip('/')}/ledgerlark-{app}"
        atexit.register(_drop_quietly, spark, _STAGE_ROOTS[app])
    return _STAGE_ROOTS[app]


def drop_stage_tables(spark: SparkSession) -> None:
    """Delete this application's stage tables (frames built from them must
    not be used afterwards)."""
    app = spark.sparkContext.applicationId
    if app in _STAGE_ROOTS:
        _drop_quietly(spark, _STAGE_ROOTS[app])


def _drop_quietly(spark: SparkSession, root: str) -> None:
    try:   # any Hadoop-compatible store, while the JVM is up
        jpath = spark._jvm.org.apache.hadoop.fs.Path(root)
        jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)
        return
    except Exception:  # noqa: BLE001 - JVM already gone at interpreter exit
        pass
    local = root[len("file:"):] if root.startswith("file:") else root
    if "://" not in local:
        shutil.rmtree(local, ignore_errors=True)


_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is executed within leaves no shuffle files behind. Otherwise those of a
    finished write stay until the driver happens to collect its garbage, and those of
    all stages lie on disk together."""
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, before)


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage by writing ``df`` once as a parquet table under the shared
    ``spark.checkpoint.dir`` and reading it back.

    Compared with ``Dataset.checkpoint()`` the plan is evaluated once (a
    reliable RDD checkpoint evaluates it a second time to write it unless it
    is also cached), the copy is columnar and compressed, later readers get
    column pruning and filter pushdown, and the files survive executor loss.
    The write's shuffle files go with it.
    """
    spark = df.sparkSession
    path = f"{stage_root(spark)}/{name}-{uuid.uuid4().hex}"
    with shuffles_dropped(spark):
        df.write.mode("error").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    """The parquet table at ``path``; None if there is no such path, or no
    file in it yet. Any other failure (access, network, a broken file) is
    raised: it must not pass for an empty table."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def env_int(name: str, default: int) -> int:
    try:
        return int(os.environ.get(name, default))
    except ValueError:
        return default
