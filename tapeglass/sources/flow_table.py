"""The stored flow table: Parquet partitioned by New York date, unique on the key.

Beside the 25 columns it holds what every query would compute again from them: the parsed sizes, their sum
and the New York wall clock. Queries read only the columns they name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from tapeglass.functions.mbo import sum_sizes
from tapeglass.functions.scalars import measures
from tapeglass.functions.time import wall_clock
from tapeglass.operators.dedup import dedup_first, merge_in_ranges
from tapeglass.operators.moments import moment_rows
from tapeglass.operators.rollup import rollup_cells
from tapeglass.operators.signals import minute_rows
from tapeglass.operators.validation import (
    ValidationError,
    cast_beside_raw,
    findings,
    missing_columns,
    summarize,
)
from tapeglass.schema import FLOW_COLUMNS, FLOW_SCHEMA, KEY
from tapeglass.session import drop_folder, path_exists, scratch_folder, session_conf
from tapeglass.sources.key_filters import files_with_keys, key_rows
from tapeglass.sources.side_tables import Summary, read_side, refresh, stored_files

STORED_SCHEMA = T.StructType(
    [
        *FLOW_SCHEMA.fields,
        T.StructField("mbo_sizes", T.ArrayType(T.DoubleType())),
        T.StructField("mbo_size", T.DoubleType()),
        T.StructField("wall_time", T.TimestampNTZType()),
        T.StructField("date", T.DateType()),
    ]
)
STORED_COLUMNS = STORED_SCHEMA.fieldNames()
# Where a row stood in the input. Staged rows also hold why their file was refused and what checks failed.
INPUT_ORDER = ["_file", "_block", "_row"]
FINDINGS_TYPE = T.ArrayType(
    T.StructType([T.StructField(name, T.StringType()) for name in ("column", "check", "value")])
)
STAGED_SCHEMA = T.StructType(
    [
        *STORED_SCHEMA.fields[:-1],
        T.StructField("_file", T.StringType()),
        T.StructField("_block", T.LongType()),
        T.StructField("_row", T.LongType()),
        T.StructField("_error", T.StringType()),
        T.StructField("_findings", FINDINGS_TYPE),
        STORED_SCHEMA["date"],
    ]
)

# Microsecond timestamps carry the row-group statistics that time filters need; INT96 has none.
WRITE_CONF = {"spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS"}


def read_flow(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet flow, a single file or a directory partitioned by date."""
    return spark.read.parquet(path)


def stage_rows(rows: DataFrame, folder: str) -> dict:
    """Write the rows of one ingest to scratch files; return what was observed on the way.

    `rows` holds the 25 columns as read, the input order and `_error`. They are read, cast and checked once;
    everything that follows works on the staged files, so a lost executor repeats tasks over those only.
    """
    seen = Observation("ingest")
    checked = cast_beside_raw(rows, *INPUT_ORDER, "_error").withColumns(
        {
            "mbo_size": sum_sizes(),
            "wall_time": wall_clock(F.col("timestamp")),
            "_findings": F.expr(findings(FLOW_COLUMNS, with_raw=True)),
        }
    )
    # The dates are one value per calendar date of the rows.
    staged = checked.withColumn("date", F.to_date("wall_time")).observe(
        seen,
        *measures(
            rows="count(*)",
            bad_rows="count(_findings)",
            refused="count(_error)",
            dates="collect_set(date)",
            undated="count_if(date IS NULL AND _error IS NULL)",
            first="min(unix_micros(timestamp))",
            last="max(unix_micros(timestamp))",
        ),
    )
    with session_conf(rows.sparkSession, WRITE_CONF):
        staged.select(STAGED_SCHEMA.fieldNames()).write.parquet(folder)
    return seen.get


#: The folder of rows without a date.
NO_DATE = "__HIVE_DEFAULT_PARTITION__"


def _folders(spark: SparkSession, path: str, dates: list, undated: bool) -> list[str]:
    """The folders of these dates that the table has. Other folders are not listed, so this does not grow with the table."""
    wanted = [f"{path.rstrip('/')}/date={name}" for name in [*sorted(str(d) for d in dates), *[NO_DATE] * undated]]
    return [folder for folder in wanted if path_exists(spark, folder)]


def _touched(spark: SparkSession, path: str, staged: DataFrame, seen: dict | None) -> DataFrame:
    """Rows of the existing table that can share a key with staged rows: same dates, same time range.

    Only the folders of the dates are read. The outermost times become row-group filters. With more than two dates each
    is also held against its own times, so a batch of parts of some days keeps no day whole; one row per calendar date
    comes to the driver for that. `seen` is what `stage_rows` observed, if known.
    """
    if seen is None or len(seen["dates"]) > 2:
        ranges = (
            staged.groupBy("date")
            .agg(F.min("timestamp").alias("first"), F.max("timestamp").alias("last"))
            .select("date", F.unix_micros("first").alias("first"), F.unix_micros("last").alias("last"))
            .collect()
        )
    else:
        ranges = [T.Row(date=d, first=seen["first"], last=seen["last"]) for d in seen["dates"]]
        ranges += [T.Row(date=None, first=None, last=None)] * bool(seen["undated"])
    dated = [r for r in ranges if r.date is not None]
    folders = _folders(spark, path, [r.date for r in dated], len(dated) < len(ranges))
    if not folders:
        return spark.createDataFrame([], STORED_SCHEMA)
    rows = spark.read.schema(STORED_SCHEMA).option("basePath", path).parquet(*folders)
    keep = F.col("date").isNull()
    if dated:
        first, last = min(r["first"] for r in dated), max(r["last"] for r in dated)
        keep = keep | (
            (F.col("timestamp") >= F.timestamp_micros(F.lit(first)))
            & (F.col("timestamp") <= F.timestamp_micros(F.lit(last)))
        )
    if len(dated) <= 2:
        return rows.where(keep)
    days = spark.createDataFrame([tuple(r) for r in ranges], "_day date, _first long, _last long")
    at = F.unix_micros("timestamp")
    inside = F.col("date").eqNullSafe(F.col("_day")) & (
        F.col("date").isNull() | ((at >= F.col("_first")) & (at <= F.col("_last")))
    )
    return rows.where(keep).join(F.broadcast(days), inside, "left_semi")


#: Side tables by name: what each keeps of stored rows.
SUMMARIES: dict[str, Summary] = {"keys": key_rows, "rollup": rollup_cells, "moments": moment_rows, "minutes": minute_rows}


def refresh_side_tables(spark: SparkSession, path: str, names: Iterable[str] = tuple(SUMMARIES)) -> dict[str, int]:
    """Summarise the files that the side tables lack; the number of files by side table."""
    with session_conf(spark, WRITE_CONF):
        return {name: refresh(spark, path, name, STORED_SCHEMA, SUMMARIES[name]) for name in names}


def side_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The summaries of all files of the table: refreshed ones as stored, others made on the spot."""
    return read_side(spark, path, name, STORED_SCHEMA, SUMMARIES[name])


def _candidates(spark: SparkSession, path: str, staged: DataFrame) -> DataFrame:
    """Rows of the stored files that may hold a key of the staged rows, by the side table `keys`.

    The driver gets the names of these files, as it does for any scan of them.
    """
    wanted = files_with_keys(side_table(spark, path, "keys"), staged)
    names = sorted(row.path for row in stored_files(spark, path).join(wanted, "file").select("path").collect())
    if not names:
        return spark.createDataFrame([], STORED_SCHEMA)
    return spark.read.schema(STORED_SCHEMA).option("basePath", path).parquet(*names)


def append_staged(spark: SparkSession, folder: str, path: str, by_files: bool = False, seen: dict | None = None) -> int:
    """Append the staged rows whose key the table lacks; existing rows win, first input row wins.

    `by_files` has the side table `keys` choose the stored files to look into; `seen` is what `stage_rows` observed, if
    known.
    """
    staged = spark.read.schema(STAGED_SCHEMA).parquet(folder).where(F.col("_error").isNull())
    new = staged.drop("_error", "_findings")
    if not path_exists(spark, path):
        existing = spark.createDataFrame([], T.StructType([STORED_SCHEMA[name] for name in ("date", *KEY)]))
    elif by_files:
        existing = _candidates(spark, path, staged).select("date", *KEY)
    else:
        existing = _touched(spark, path, staged, seen).select("date", *KEY)
    # Ranges of date and time even out busy days over many files and give each file a narrow time range. The strike is
    # left to the sort: grouping changes zeros and NaNs of a float, which would cost a second shuffle.
    fresh = merge_in_ranges(existing, new, INPUT_ORDER, ["date", "timestamp", "Side"], known_rows=seen and seen["rows"]).select(STORED_COLUMNS)
    written = Observation("append")
    with session_conf(spark, WRITE_CONF):
        (
            fresh.observe(written, F.count(F.lit(1)).alias("rows"))
            .write.mode("append")
            .option("compression", "snappy")
            .partitionBy("date")
            .parquet(path)
        )
    return written.get["rows"]


def append_flow(
    rows: DataFrame,
    path: str,
    strict: bool = True,
    validate: bool = False,
    on_staged: Callable[[DataFrame], None] | None = None,
    side_tables: Iterable[str] = (),
    on_refused: Callable[[DataFrame, int], None] | None = None,
    report: bool = True,
) -> dict[str, object]:
    """Cast, check, deduplicate and append raw or typed rows; returns the counts and the report.

    `strict` aborts on values that cannot be cast, `validate` on any finding; both do so before the table is
    touched. `rows` may hold the columns `_file`, `_block`, `_row` (input order) and `_error`; without them
    the order of the frame decides. `on_staged` gets the staged frame, refused files included, and `on_refused` that frame
    and how many files were refused, maybe none. `side_tables` are refreshed after the append; with `keys` among them it
    looks into the stored files only that may hold its keys. Without `report` findings that abort nothing are not looked
    up, and the report is empty.
    """
    spark = rows.sparkSession
    missing = missing_columns(rows)
    if missing:
        raise ValidationError(f"missing columns: {missing}")
    defaults = {
        "_file": F.lit(""),
        "_block": F.lit(0).cast("long"),
        "_row": F.monotonically_increasing_id(),
        "_error": F.lit(None).cast("string"),
    }
    rows = rows.withColumns({k: v for k, v in defaults.items() if k not in rows.columns})
    folder = scratch_folder(spark, "stage")
    try:
        metrics = stage_rows(rows, folder)
        staged = spark.read.schema(STAGED_SCHEMA).parquet(folder)
        # At most one row per column and check; good input needs no second look.
        asked = metrics["bad_rows"] and (report or strict or validate)
        found = [tuple(r) for r in summarize(staged, "_findings").collect()] if asked else []
        fatal = [r for r in found if validate or (strict and r[1] == "bad_cast")]
        if fatal:
            raise ValidationError("; ".join(f"{c}: {k} x{n} ({v!r})" for c, k, n, v in fatal))
        if on_staged is not None:
            on_staged(staged)
        if on_refused is not None:
            on_refused(staged, metrics["refused"])
        appended = append_staged(spark, folder, path, "keys" in side_tables, metrics)
    finally:
        drop_folder(spark, folder)
    if appended:
        refresh_side_tables(spark, path, side_tables)
    return {"read": metrics["rows"], "appended": appended, "report": found if report else []}


def create_flow(rows: DataFrame, path: str, order: list[str]) -> None:
    """Write a new plain flow Parquet (25 columns, no partitions), deduplicated keep-first."""
    with session_conf(rows.sparkSession, WRITE_CONF):
        firsts = dedup_first(rows, order).select(FLOW_COLUMNS)
        firsts.write.option("compression", "snappy").parquet(path)
