"""Ordered results: top-N of grouped results, and first or last N of raw events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tapeglass.functions.scalars import finite_or_null
from tapeglass.functions.time import time_bucket


def check_range(name: str, value: int, low: int, high: int) -> None:
    if not low <= value <= high:
        raise ValueError(f"{name} must lie between {low} and {high}, got {value}")


def ordered(df: DataFrame, by: list[str], limit: int | None, most: int) -> DataFrame:
    """Order a grouped result, NULLs last, and keep the first `limit` rows (None keeps all)."""
    if limit is not None:
        check_range("limit", limit, 1, most)
    df = finite_or_null(df).orderBy([F.col(name).asc_nulls_last() for name in by])
    return df if limit is None else df.limit(limit)


def _cut_minute(df: DataFrame, n: int, last: bool, time: str, counts: DataFrame | None) -> Column:
    """Start of the minute that holds the n-th timed event from the front or the back, as a scalar subquery.

    Events are counted per minute before the shuffle, unless (minute, events) `counts` are at hand. The running sums go
    over one row per day and then over the minutes of one day. With fewer than n timed events it is the farthest
    minute; NULL without any.
    """

    def nearest(bucket: str) -> Column:
        return F.desc(bucket) if last else F.asc(bucket)

    def reached(counts: DataFrame, bucket: str, wanted: Column) -> DataFrame:
        """Buckets up to the one that holds the wanted event, with the events before each."""
        running = Window.orderBy(nearest(bucket)).rowsBetween(Window.unboundedPreceding, -1)
        before = F.coalesce(F.sum("events").over(running), F.lit(0))
        return counts.withColumn("before", before).where(F.col("before") < wanted)

    if counts is None:
        timed = df.where(F.col(time).isNotNull())
        minutes = timed.groupBy(time_bucket(time, minutes=1).alias("minute")).agg(F.count(F.lit(1)).alias("events"))
    else:
        known = counts.where("minute IS NOT NULL AND events > 0")
        minutes = known.groupBy("minute").agg(F.sum("events").alias("events"))
    days = minutes.groupBy(F.to_date("minute").alias("day")).agg(F.sum("events").alias("events"))
    farthest = F.min_by if last else F.max_by
    day = reached(days, "day", F.lit(n)).agg(
        farthest("day", "day").alias("day"), farthest("before", "day").alias("day_before")
    )
    inside = minutes.join(F.broadcast(day), F.to_date("minute") == F.col("day"))
    rows = reached(inside, "minute", F.lit(n) - F.col("day_before"))
    return rows.agg((F.min if last else F.max)("minute").alias("cut")).scalar()


def cut_by_time(
    df: DataFrame, n: int, last: bool = False, time: str = "timestamp", counts: DataFrame | None = None
) -> DataFrame:
    """A superset of the first (or last) `n` rows by `time`, whole minutes up to the one of the n-th row.

    `time` is a TIMESTAMP_NTZ. The cut is part of the plan: it reads the time column once more, or the (minute, events)
    `counts` of just these rows, and is found when the result runs, for any size alike. Where there is a `date` column it prunes partitions. Rows without a time
    stay, since they come last in either direction.
    """
    cut = _cut_minute(df, n, last, time, counts)
    upto = cut + F.expr("INTERVAL '1' MINUTE")
    kept = F.col(time) >= cut if last else F.col(time) < upto
    df = df.where(kept | F.col(time).isNull())
    if "date" in df.columns:
        day = F.to_date(cut)
        in_days = F.col("date") >= day if last else F.col("date") <= day
        df = df.where(in_days | F.col("date").isNull())
    return df


def first_events(df: DataFrame, n: int, by: list[str], counts: DataFrame | None = None) -> DataFrame:
    """The first `n` raw rows in the order `by`, whose first column is the time."""
    return cut_by_time(df, n, False, by[0], counts).orderBy([F.col(name).asc_nulls_last() for name in by]).limit(n)


def last_events(df: DataFrame, n: int, by: list[str], counts: DataFrame | None = None) -> DataFrame:
    """The last `n` raw rows in the order `by`, whose first column is the time, returned in that order."""
    return last_n(cut_by_time(df, n, True, by[0], counts), n, by)


def last_n(df: DataFrame, n: int, by: list[str]) -> DataFrame:
    """The last `n` rows of a grouped result in the order `by`, returned in that order."""
    tail = df.orderBy([F.col(name).desc_nulls_last() for name in by]).limit(n)
    return tail.orderBy([F.col(name).asc_nulls_last() for name in by])
