"""The calendar of expected minute files and the gaps in what has landed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

# The file name pattern and the default first and last minute.
FIRST_MINUTE = "0921"
LAST_MINUTE = "1600"


def file_name(date: Column, minute: Column) -> Column:
    """`loaded_lob_{YYYYMMDD}__{YYYYMMDD}_{HHMM}.csv.gz`."""
    day = F.date_format(date, "yyyyMMdd")
    return F.format_string("loaded_lob_%s__%s_%s.csv.gz", day, day, minute)


def dates_frame(spark: SparkSession, dates: list[str]) -> DataFrame:
    """A `date` frame from YYYYMMDD texts."""
    return spark.createDataFrame([(d,) for d in dates], "d string").select(
        F.to_date("d", "yyyyMMdd").alias("date")
    )


def expected_minutes(
    dates: DataFrame, start: str = FIRST_MINUTE, end: str = LAST_MINUTE
) -> DataFrame:
    """One row (date, minute HHMM, file_name) per expected file; `start` and `end` are inclusive."""
    first, last = (int(at[:2]) * 60 + int(at[2:]) for at in (start, end))
    if last < first:
        return dates.select("date", F.lit("").alias("minute"), F.lit("").alias("file_name")).limit(0)
    of_day = dates.select(
        "date", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("at")
    )
    minute = F.format_string("%02d%02d", F.floor(F.col("at") / 60), F.col("at") % 60)
    return of_day.select("date", minute.alias("minute")).withColumn(
        "file_name", file_name(F.col("date"), F.col("minute"))
    )


def coverage_gaps(expected: DataFrame, landed: DataFrame) -> DataFrame:
    """Expected files that are not among the landed ones (a frame with `path` or `file_name`)."""
    if "file_name" not in landed.columns:
        landed = landed.select(F.element_at(F.split("path", "/"), -1).alias("file_name"))
    return expected.join(landed.select("file_name"), "file_name", "left_anti").select(
        "date", "minute", "file_name"
    )


def gap_intervals(gaps: DataFrame) -> DataFrame:
    """(date, from, to, count) of the runs of missing minutes, both ends inclusive, from `coverage_gaps`.

    Minutes of one run differ from their place in the day's list by the same number. A date has 1,440 minutes at most.
    """
    clock = F.substring("minute", 1, 2).cast("int") * 60 + F.substring("minute", 3, 2).cast("int")
    place = F.row_number().over(Window.partitionBy("date").orderBy("minute"))
    runs = gaps.select("date", "minute", (clock - place).alias("run")).groupBy("date", "run")
    found = runs.agg(F.min("minute").alias("from"), F.max("minute").alias("to"), F.count(F.lit(1)).alias("count"))
    return found.select("date", "from", "to", "count")
