"""Registered queries over stored tables and what is kept beside them: sums, moments, counts and key filters by file."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

import tapeglass as tg
from ingest_checks import in_order, stored_rows
from tapeglass.functions.scalars import finite_or_null
from tapeglass.session import scratch_folder
from tapeglass.sources.events_view import load_flow

#: Widths of buckets: a name as SQL writes it, and the options of the queries.
WIDTHS = {
    "5 seconds": {"bucket_seconds": 5},
    "1 minute": {"bucket_minutes": 1},
    "5 minutes": {"bucket_minutes": 5},
    "45 minutes": {"bucket_minutes": 45},
}
APPENDS = 3
SAMPLED_EVENTS, SAMPLED_CORRELATION, SAMPLED_SIZES = 1000, 50_000, 10_000


def appended(spark: SparkSession, sf_dir: str, appends: int = APPENDS, side_tables: tuple = ()) -> str:
    """A table of several appends; the second holds what came between the rows of the first, and so on."""
    path = f"{scratch_folder(spark, 'appends')}/flow"
    rows = load_flow(spark, sf_dir, "event_id")
    for part in range(appends):
        tg.append_flow(in_order(rows.where(F.col("event_id") % appends == part)), path, side_tables=side_tables)
    return path


def rollup_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bucketed series of several widths from the stored sums."""
    cells = tg.side_table(spark, appended(spark, sf_dir, side_tables=("rollup",)), "rollup")

    def series(name: str, width: str, found: DataFrame, *values: str) -> DataFrame:
        columns = [F.round(v, 6).alias(c) for c, v in zip("abc", values)]
        none = [F.lit(None).cast("double").alias(c) for c in "abc"[len(values) :]]
        return found.select(F.lit(name).alias("series"), F.lit(width).alias("width"), "time_bucket", *columns, *none)

    made = []
    for width, options in WIDTHS.items():
        made += [
            series("basis", width, tg.rollup_basis(cells, **options), "es_price", "spx_price", "basis"),
            series("net_flow", width, tg.rollup_net_flow(cells, **options), "call_delta_flow", "put_delta_flow", "net_delta"),
            series("spread", width, tg.rollup_spread(cells, **options), "spread", "spx_price"),
            series("gex", width, tg.rollup_gex_intraday(cells, **options), "long_gex", "short_gex", "net_gex"),
        ]
    return reduce(DataFrame.unionByName, made)


def rollup_strikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heatmap and depth from the stored sums; the third append was not refreshed."""
    path = appended(spark, sf_dir)
    tg.refresh_side_tables(spark, path, ["rollup"])
    rows = load_flow(spark, sf_dir, "event_id").where("event_id % 100 = 7")
    tg.append_flow(in_order(rows), path)
    cells = tg.side_table(spark, path, "rollup")
    bid = tg.FlowFilter(side="Bid")
    heat = tg.rollup_heatmap(cells, bid, 15).select("time_bucket", "future_strike", F.lit("Bid").alias("Side"), "total_size")
    depth = tg.rollup_depth(cells, tg.ALL_ROWS).select(F.lit(None).cast("timestamp_ntz").alias("time_bucket"), "future_strike", "Side", "total_size", "event_count")
    return heat.withColumn("event_count", F.lit(None).cast("long")).unionByName(depth)


def moments_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correlation of the session from moments stored by file."""
    parts = tg.side_table(spark, appended(spark, sf_dir, side_tables=("moments",)), "moments")
    return tg.correlation_from_moments(parts.where("in_session"))


def one_scan_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    flow = tg.apply_filters(load_flow(spark, sf_dir))
    return tg.correlation_from_moments(tg.moments(flow, []))


def indexed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last pulling/stacking rows of a stored table, found by its counts per minute."""
    path = appended(spark, sf_dir, side_tables=("minutes",))
    flow, minutes = tg.read_flow(spark, path), tg.side_table(spark, path, "minutes")
    first = tg.pulling_stacking(flow, limit=700, only_events=True, minutes=minutes).withColumn("part", F.lit("first"))
    last = tg.recent_pulling_stacking(flow, n=500, minutes=minutes).withColumn("part", F.lit("last"))
    return first.unionByName(last)


def filtered_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appends that look into the files only that may hold their keys; the last one repeats rows of all others."""
    path = appended(spark, sf_dir, side_tables=("keys",))
    again = load_flow(spark, sf_dir, "event_id").where("event_id % 5 = 1")
    tg.append_flow(in_order(again), path, side_tables=("keys",))
    return stored_rows(tg.read_flow(spark, path))


def compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of a table of ten appends after its files were packed."""
    path = appended(spark, sf_dir, 10)
    tg.compact(spark, path)
    return stored_rows(tg.read_flow(spark, path))


def sample_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    flow = tg.apply_filters(load_flow(spark, sf_dir))
    rows = flow.select("timestamp", "Side", "future_strike", "spx_price", "MBO_pulling_stacking")
    return finite_or_null(tg.exact_sample(rows, SAMPLED_EVENTS, ["timestamp", "Side", "future_strike"]))


def sample_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tg.correlation(load_flow(spark, sf_dir), tg.ALL_ROWS, rows=SAMPLED_CORRELATION)


def sample_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tg.histogram_values(load_flow(spark, sf_dir), tg.ALL_ROWS, rows=SAMPLED_SIZES)


def queries() -> dict:
    return {
        "rollup_buckets": rollup_buckets,
        "rollup_strikes": rollup_strikes,
        "moments_correlation": moments_correlation,
        "one_scan_correlation": one_scan_correlation,
        "indexed_events": indexed_events,
        "filtered_append": filtered_append,
        "compacted": compacted,
        "sample_events": sample_events,
        "sample_correlation": sample_correlation,
        "sample_sizes": sample_sizes,
    }
