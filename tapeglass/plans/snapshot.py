"""All queries with the snapshot settings, exported as JSON with a manifest.

Snapshot settings: no session filter, 5-second buckets, no limits unless given. Queries that group alike share one
pass: the table is read eight times (twice for the correlation) for 23 results, and every
shared pass ends in a small frame.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache, partial

from pyspark.sql import DataFrame, Observation, functions as F

from tapeglass.functions.mbo import with_mbo_size
from tapeglass.functions.scalars import expiry_4, measures
from tapeglass.functions.time import FILE_TIMES, time_bucket
from tapeglass.operators.correlation import correlation, matrix_record
from tapeglass.operators.filters import ALL_ROWS, FlowFilter, apply_filters
from tapeglass.operators.greeks import METRICS, gex_measures
from tapeglass.operators.ordering import ordered
from tapeglass.operators.signals import (
    basis_measures,
    kpi_from_strikes,
    kpi_measures,
    net_flow_measures,
    pulling_stacking,
)
from tapeglass.operators.volume import heatmap, size_counts, spread_from_sides, spread_measures
from tapeglass.schema import CALL_GREEKS

# Bucket width, and row limits for a snapshot that is to be small.
BUCKET_SECONDS = 5
SMALL_LIMITS = {
    "pulling_stacking": 10000,
    "heatmap": 5000,
    "depth": 2000,
    "surface": 5000,
    "vanna_charm": 1000,
    "theta": 5000,
    "scatter": 5000,
    "gex": 500,
    "gex_intraday": 1000,
}


def bucket_panel(flow: DataFrame, f: FlowFilter) -> DataFrame:
    """Everything grouped by time bucket alone: basis, net flow, spread and intraday exposure."""
    bucket = time_bucket(seconds=BUCKET_SECONDS)
    sized = with_mbo_size(apply_filters(flow, f)).withColumn("time_bucket", bucket)
    return sized.groupBy("time_bucket").agg(
        *basis_measures(), *net_flow_measures(), *spread_measures(), *gex_measures()[1:]
    )


def expiry_panel(flow: DataFrame, f: FlowFilter) -> DataFrame:
    """Sums and counts by (spx_strike, t): the surfaces and theta directly, the strike profiles by adding up."""
    sized = with_mbo_size(apply_filters(flow, f))
    averaged = [*CALL_GREEKS, "put_vanna", "put_charm", "put_theta", "spx_price"]
    return sized.groupBy("spx_strike", expiry_4()).agg(
        *measures(
            events="count(*)",
            **{f"sum_{c}": f"sum(CAST({c} AS DOUBLE))" for c in averaged},
            **{f"n_{c}": f"count({c})" for c in averaged},
        ),
        *gex_measures()[1:],
    )


def pair_panel(flow: DataFrame, f: FlowFilter) -> DataFrame:
    """Headline measures and sizes by (spx_strike, future_strike, Side): kpi and depth add them up."""
    sized = with_mbo_size(apply_filters(flow, f))
    return sized.groupBy("spx_strike", "future_strike", "Side").agg(
        *kpi_measures(), *measures(size="sum(mbo_size)")
    )


def snapshot_queries(
    flow: DataFrame,
    f: FlowFilter = ALL_ROWS,
    keep: Callable[[DataFrame], DataFrame] = lambda panel: panel,
    limits: dict[str, int] | None = None,
) -> dict[str, Callable[[], DataFrame]]:
    """The 23 results by name, each built when called; `keep` is applied to the panels they share.

    Results are whole; `limits`, such as SMALL_LIMITS, keeps the first rows of the results it names.
    """
    most = (limits or {}).get

    @cache
    def buckets() -> DataFrame:
        return keep(bucket_panel(flow, f))

    @cache
    def expiries() -> DataFrame:
        return keep(expiry_panel(flow, f))

    @cache
    def pairs() -> DataFrame:
        return keep(pair_panel(flow, f))

    def by_bucket(*columns: str, limit: int | None = None) -> DataFrame:
        return ordered(buckets().select("time_bucket", *columns), ["time_bucket"], limit, 10000)

    def by_expiry(limit: int | None, **means: str) -> DataFrame:
        columns = [f"try_divide(sum_{c}, n_{c}) AS {name}" for name, c in means.items()]
        rows = expiries().selectExpr("spx_strike", "t", *columns)
        return ordered(rows, ["spx_strike", "t"], limit, 50000)

    def by_strike(limit: int | None, **columns: str) -> DataFrame:
        rows = expiries().groupBy("spx_strike").agg(*measures(**columns))
        return ordered(rows, ["spx_strike"], limit, 50000)

    def mean(column: str) -> str:
        return f"try_divide(sum(sum_{column}), sum(n_{column}))"

    def depth() -> DataFrame:
        sums = measures(event_count="sum(events)", total_size="sum(size)")
        rows = pairs().groupBy("future_strike", "Side").agg(*sums)
        return ordered(rows, ["future_strike", "Side"], most("depth"), 20000)

    exposure = {name: f"sum({name})" for name in ("long_gex", "short_gex", "net_gex")}
    queries = {
        "kpi": lambda: kpi_from_strikes(pairs()),
        "basis": lambda: by_bucket("es_price", "spx_price", "basis"),
        "pulling_stacking": lambda: pulling_stacking(flow, f, most("pulling_stacking"), in_order=True),
        "net_flow": lambda: by_bucket("call_delta_flow", "put_delta_flow", "net_delta"),
        "heatmap": lambda: heatmap(flow, f, limit=most("heatmap"), bucket_seconds=BUCKET_SECONDS),
        # Counts per size instead of a few sizes in no order: complete, and still small.
        "histogram": lambda: size_counts(flow, f).orderBy("mbo_value"),
        "spread": lambda: ordered(spread_from_sides(buckets()), ["time_bucket"], None, 0),
        "depth": depth,
    }
    for greek in CALL_GREEKS:
        queries[f"surface_{greek}"] = partial(by_expiry, most("surface"), greek_value=greek)
    for metric in METRICS:
        queries[f"vanna_charm_{metric}"] = partial(
            by_strike,
            most("vanna_charm"),
            call_value=mean(f"call_{metric}"),
            put_value=mean(f"put_{metric}"),
        )
    queries |= {
        "theta": partial(
            by_expiry, most("theta"), call_theta="call_theta", put_theta="put_theta"
        ),
        "scatter": partial(
            by_strike,
            most("scatter"),
            call_vega=mean("call_vega"),
            call_vomma=mean("call_vomma"),
            mbo_count="sum(events)",
        ),
        "gex": partial(by_strike, most("gex"), spx_price=mean("spx_price"), **exposure),
        "gex_intraday": lambda: by_bucket(
            "spx_price", "net_gex", "long_gex", "short_gex", limit=most("gex_intraday")
        ),
        "correlation": lambda: matrix_record(correlation(flow, f)),
    }
    return queries


def export_snapshot(
    flow: DataFrame, out_dir: str, f: FlowFilter = ALL_ROWS, limits: dict[str, int] | None = None
) -> DataFrame:
    """Write every result as JSON lines under `out_dir/<name>`; return the manifest (name, records, bytes).

    Records are counted while they are written and sizes come from the file listing, so no result is
    computed twice.
    """
    spark = flow.sparkSession
    panels, records = [], []

    def keep(panel: DataFrame) -> DataFrame:
        panels.append(panel.persist())
        return panel

    try:
        for name, build in snapshot_queries(flow, f, keep, limits).items():
            counted = Observation(name)
            (
                build()
                .observe(counted, F.count(F.lit(1)).alias("records"))
                .write.mode("overwrite")
                .options(**FILE_TIMES, ignoreNullFields="false")
                .json(f"{out_dir}/{name}")
            )
            records.append((name, counted.get["records"]))
    finally:
        for panel in panels:
            panel.unpersist()
    sizes = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(out_dir)
        .groupBy(F.element_at(F.split("path", "/"), -2).alias("name"))
        .agg(F.sum("length").alias("bytes"))
    )
    manifest = spark.createDataFrame(records, "name string, records bigint")
    return manifest.join(F.broadcast(sizes), "name", "left").orderBy("name")
