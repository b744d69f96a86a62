"""Packing the many small files that appends leave into few of a target size, in time order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tapeglass.session import drop_folder, scratch_folder, session_conf
from tapeglass.sources.flow_table import STORED_SCHEMA, WRITE_CONF
from tapeglass.sources.side_tables import stored_files

TARGET_BYTES = 128 << 20
LAYOUT = ["date", "timestamp", "Side", "future_strike"]


def packable_dates(spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """(date as in the folder name, files, bytes, packed) of the dates that fewer files of the target size could hold."""
    files = stored_files(spark, path).withColumn("folder", F.regexp_extract("file", "^date=([^/]+)/", 1))
    sizes = files.groupBy("folder").agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    return sizes.withColumn("packed", F.ceil(F.col("bytes") / target_bytes)).where("files > packed")


def compact(spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES) -> dict[str, int]:
    """Rewrite the dates whose files can be packed, sorted by time in ranges; the files before and after.

    Rows are copied to the scratch folder first and replace their dates from there, so a run that dies has not lost
    them; the copy is dropped once they are in place. Rows are not changed, and side tables see the new files as any
    others. Nobody else may write to these dates meanwhile.
    """
    dates = packable_dates(spark, path, target_bytes).collect()  # one row per calendar date
    if not dates:
        return {"dates": 0, "before": 0, "after": 0}
    undated = any(row.folder.startswith("__") for row in dates)
    named = [row.folder for row in dates if not row.folder.startswith("__")]
    picked = F.col("date").isin([F.lit(name).cast("date") for name in named]) if named else F.lit(False)
    rows = spark.read.schema(STORED_SCHEMA).parquet(path)
    rows = rows.where(picked | F.col("date").isNull() if undated else picked)
    folder = scratch_folder(spark, "compact")
    # Ranges of rows of about the target size; a date's files are as many as its ranges, and one more at a border.
    ranges = sum(int(row.packed) for row in dates)
    with session_conf(spark, WRITE_CONF):
        rows.write.partitionBy("date").parquet(folder)
        copied = spark.read.schema(STORED_SCHEMA).parquet(folder)
        packed = copied.repartitionByRange(ranges, *LAYOUT).sortWithinPartitions(*LAYOUT)
        writer = packed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.option("compression", "snappy").partitionBy("date").parquet(path)
    # Only now: after a failure the copy is all there is of a date that was being replaced.
    drop_folder(spark, folder)
    now = stored_files(spark, path).withColumn("folder", F.regexp_extract("file", "^date=([^/]+)/", 1))
    after = now.where(F.col("folder").isin([row.folder for row in dates])).count()
    return {"dates": len(dates), "before": sum(row["files"] for row in dates), "after": after}

