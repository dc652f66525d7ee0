"""Session factory and the shared folder in which intermediate tables are kept."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(app_name: str = "reviewlab", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC timestamps and adaptive execution; `conf` keys use `__` for the dot."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


_SCRATCH: list[tuple[SparkSession, str]] = []


def checkpoint_root(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`, else one below the session's warehouse.

    Both lie on the file system that all executors share. On a cluster without that setting, a warehouse
    that is a folder of one machine is refused.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if not spark.sparkContext.master.startswith("local") and (warehouse.startswith("file:") or "://" not in warehouse):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{warehouse}/_scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, not yet existing path below the shared folder; `release` deletes it."""
    path = f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _SCRATCH.append((spark, path))
    return path


def materialize(df: DataFrame, name: str = "table", compression: str | None = None) -> DataFrame:
    """Compute `df` once into a Parquet table below the shared folder and read that.

    Readers survive the loss of executors, prune columns and push filters down.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release() -> None:
    """Delete the intermediate tables; results that still read them must have been written."""
    while _SCRATCH:
        spark, path = _SCRATCH.pop()
        if spark.sparkContext._jsc is None:
            continue
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _release_at_exit() -> None:
    try:
        release()
    except Exception:  # the JVM may be gone already
        pass


atexit.register(_release_at_exit)
