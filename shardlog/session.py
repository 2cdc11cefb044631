"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
_own_dirs: dict[str, str] = {}


def local_session(app: str = "shardlog", cores: int | str = 8, partitions: int = 8) -> SparkSession:
    """A session for tests and the benchmark on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", os.environ.get("SHARDLOG_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )


def use_utc(spark: SparkSession) -> SparkSession:
    """Record logs hold zone-less times; the session zone must not shift them."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a single-machine session may go without the setting: it gets a new
    folder of its own. On a cluster a machine-local folder would be lost with
    its machine, so there the setting is required.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _own_dirs:
            _own_dirs[app] = tempfile.mkdtemp(prefix="shardlog-")
        configured = _own_dirs[app]
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used before."""
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table.

    Used where a value depends on how rows were laid out (partition numbers,
    positions): once written it is the same for every later read, also after an
    executor is lost. Reading it back also gives Catalyst the true size, by which
    it decides on its own whether a side is small enough to broadcast.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
