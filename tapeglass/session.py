"""Session settings the engine relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Timestamps written as INT96 carry no row-group statistics, so time filters would read every row group.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def build_session(app: str = "tapeglass", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the recommended settings; `conf` entries use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]):
    """Set SQL settings for the actions run inside the block, then put the old ones back."""
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the shared folder the session names in `spark.checkpoint.dir`.

    On one machine, and only there, a temporary folder stands in when the setting is missing.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = tempfile.gettempdir()
    return f"{root.rstrip('/')}/tapeglass/{purpose}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is such a file or folder; nothing below it is listed."""
    hadoop_path, files = _file_system(spark, path)
    return files.exists(hadoop_path)


def drop_folder(spark: SparkSession, path: str) -> None:
    hadoop_path, files = _file_system(spark, path)
    files.delete(hadoop_path, True)
