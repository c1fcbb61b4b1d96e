"""Spark session helpers.

Library code never creates a session; it receives one.  ``local_session`` is for
tests, the bench and the smoke entry point only.  On a cluster the session comes from
the platform and its settings (shuffle partitions, checkpoint folder, ...) win.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings of the local sessions (tests, bench).  AQE and its skew-join handling are
# Spark's defaults, and the plans count on them.  Library code changes nothing in a
# session it is given, except to name a checkpoint folder where none is set.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "marketlens") -> SparkSession:
    """A local session for tests and benchmarks (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("MARKETLENS_DRIVER_MEMORY", "4g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's own setting is always kept.  Only in a local session without one a
    fresh scratch folder is created (and removed when the process ends); on a cluster
    a missing setting is an error, since executors would write to their own disks.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the context  # noqa: BLE001
        sc = None
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if sc is not None and not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    if not spark.conf.get("spark.master", "local").startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    scratch = tempfile.mkdtemp(prefix="marketlens-ckpt-")
    atexit.register(shutil.rmtree, scratch, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", scratch)
    if sc is not None:
        sc.setCheckpointDir(scratch)
    return scratch


_WRITTEN: list[str] = []  # folders of intermediate tables this process has written


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder inside the shared checkpoint folder, see ``remove_scratch``."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/marketlens-{label}-{uuid.uuid4().hex[:12]}"
    _WRITTEN.append(path)
    return path


def remove_scratch(spark: SparkSession) -> None:
    """Remove the intermediate tables of this process, when nothing reads them any more."""
    jvm = spark.sparkContext._jvm
    while _WRITTEN:
        path = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read it back
    (columnar, with statistics; survives the loss of any executor).  For intermediates
    that several jobs or plan branches read."""
    path = scratch_folder(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed_copy(df: DataFrame, key: str, dealt: bool = False) -> DataFrame:
    """Like ``cut_lineage``, kept in as many buckets by ``key`` as the session shuffles into,
    so that joins and groupings by ``key`` read it without an exchange.  ``dealt``: the rows
    already lie so (``df`` is grouped by ``key`` alone).  The table's name is needed to write it only."""
    spark = df.sparkSession
    buckets, name = int(spark.conf.get("spark.sql.shuffle.partitions")), f"marketlens_{uuid.uuid4().hex}"
    (df if dealt else df.repartition(buckets, key)).write.format("parquet").option("compression", "zstd").bucketBy(
        buckets, key).sortBy(key).option("path", scratch_folder(spark, "table")).saveAsTable(name)
    copy = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # an external table's files stay
    return copy
