"""Side tables: summaries of a stored table's files, kept beside it and added to as files come.

A summary has rows per stored file, so it is additive: an append summarises the files it wrote and reads no other. The
rows of one refresh lie in a folder of their own, and a register says which folder holds which file. It is written last,
so a refresh that dies leaves rows that nothing refers to. Reading takes the rows of registered files that are still
there and summarises the others on the spot; answers are right whatever was refreshed, and cheap if all was.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tapeglass.session import path_exists
from tapeglass.sources.listing import list_files

REGISTER = "file string, batch string"
Summary = Callable[[DataFrame], DataFrame]


def file_key(path: Column) -> Column:
    """Date folder and name: names alone repeat over the dates that one task wrote."""
    return F.regexp_extract(path, "([^/]+/[^/]+)$", 1)


def stored_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, path, length) of the table's files."""
    listed = list_files(spark, f"{path.rstrip('/')}/**/*.parquet")
    return listed.select(file_key(F.col("path")).alias("file"), "path", "length")


def rows_of(spark: SparkSession, path: str, schema, paths: list[str] | None) -> DataFrame:
    """Rows of some files of the table, or of all for None, with the column `file`."""
    reader = spark.read.schema(schema).option("basePath", path)
    rows = reader.parquet(*([path] if paths is None else paths))
    return rows.withColumn("file", file_key(F.col("_metadata.file_path")))


def _folder(path: str, name: str) -> str:
    return f"{path.rstrip('/')}_{name}"


def _register(spark: SparkSession, path: str, name: str) -> DataFrame:
    folder = f"{_folder(path, name)}/register"
    if not path_exists(spark, folder):
        return spark.createDataFrame([], REGISTER)
    return spark.read.schema(REGISTER).parquet(folder)


def _missing(spark: SparkSession, path: str, name: str) -> tuple[list[str] | None, int]:
    """Paths of the files without a summary (None for the whole table), and how many; the driver gets those names, as it
    does for any scan of these files."""
    files = stored_files(spark, path)
    lacking = files.join(_register(spark, path, name).select("file"), "file", "left_anti")
    paths = sorted(row.path for row in lacking.select("path").collect())
    return (None if paths and len(paths) == files.count() else paths), len(paths)


def refresh(spark: SparkSession, path: str, name: str, schema, summary: Summary) -> int:
    """Summarise the files that the side table lacks; the number of files."""
    paths, count = _missing(spark, path, name)
    if not count:
        return 0
    batch, folder = uuid.uuid4().hex, _folder(path, name)
    made = f"{folder}/batch={batch}"
    summary(rows_of(spark, path, schema, paths)).write.parquet(made)
    # Every stored file has rows, and so has its summary.
    covered = spark.read.parquet(made).select("file").distinct()
    covered.withColumn("batch", F.lit(batch)).write.mode("append").parquet(f"{folder}/register")
    return count


def read_side(spark: SparkSession, path: str, name: str, schema, summary: Summary) -> DataFrame:
    """The summaries of all files that the table has now."""
    paths, count = _missing(spark, path, name)
    fresh = summary(rows_of(spark, path, schema, paths)) if count else None
    if paths is None:
        return fresh
    register = _register(spark, path, name).join(stored_files(spark, path).select("file"), "file", "left_semi")
    folder = _folder(path, name)
    batches = sorted(row.batch for row in register.select("batch").distinct().collect())
    if not batches:
        return summary(spark.createDataFrame([], schema).withColumn("file", F.lit(""))) if fresh is None else fresh
    kept = spark.read.option("basePath", folder).parquet(*[f"{folder}/batch={batch}" for batch in batches])
    rows = kept.join(register, ["file", "batch"], "left_semi").drop("batch")
    return rows if fresh is None else rows.unionByName(fresh.select(rows.columns))
