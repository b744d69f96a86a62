"""CSV event files: header row, 25 text columns, ISO-8601 timestamps with an offset."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tapeglass.operators.validation import ValidationError, missing_columns
from tapeglass.schema import FLOW_COLUMNS
from tapeglass.sources.flow_table import append_flow
from tapeglass.sources.listing import list_files, new_files, read_ledger, record_files


def scan_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """All columns as text, no inference, with the input order.

    The header of one file names the columns; Spark checks the header of every other file against it and
    fails on a difference instead of reading columns by position.
    """
    paths = [paths] if isinstance(paths, str) else paths
    header = spark.read.option("header", True).csv(paths[0])
    missing = missing_columns(header)
    if missing:
        raise ValidationError(f"missing columns: {missing}")
    rows = (
        spark.read.schema(", ".join(f"`{name}` string" for name in header.columns))
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .csv(paths)
    )
    return rows.select(
        *FLOW_COLUMNS,
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )


def ingest_csv(
    spark: SparkSession,
    patterns: str | list[str],
    out: str,
    skip_processed: bool = True,
    validate: bool = False,
    ledger: str | None = None,
) -> dict[str, object]:
    """Append the CSV files that the ledger does not hold yet to the table `out`.

    The ledger is written after the rows. A run that dies in between is repeated without harm, since rows
    whose key is already stored are dropped.
    """
    ledger = ledger or f"{out.rstrip('/')}_ledger"
    files = list_files(spark, patterns)
    if skip_processed:
        files = new_files(files, read_ledger(spark, ledger))
    # File names only: Spark's own file index holds the same list on the driver.
    paths = sorted(row.path for row in files.select("path").collect())
    if not paths:
        return {"files": 0, "read": 0, "appended": 0, "report": []}
    counts = append_flow(scan_csv(spark, paths), out, validate=validate)
    record_files(spark.createDataFrame([(p,) for p in paths], "path string"), ledger)
    return {"files": len(paths), **counts}
