"""Order-size queries: heatmap, spread, depth and size distribution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tapeglass.functions.mbo import explode_mbo, with_mbo_size
from tapeglass.functions.scalars import measures
from tapeglass.operators.filters import FlowFilter, apply_filters
from tapeglass.operators.greeks import bucket_column
from tapeglass.operators.ordering import check_range, ordered
from tapeglass.operators.sampling import exact_sample
from tapeglass.schema import KEY


def heatmap_cells(
    flow: DataFrame, f: FlowFilter | None = None, bucket_minutes: int = 1, bucket_seconds: int | None = None
) -> DataFrame:
    """Total size by (time bucket, future strike), in no order."""
    bucket = bucket_column(bucket_minutes, bucket_seconds)
    sized = with_mbo_size(apply_filters(flow, f)).withColumn("time_bucket", bucket)
    return sized.groupBy("time_bucket", "future_strike").agg(F.sum("mbo_size").alias("total_size"))


def heatmap(
    flow: DataFrame,
    f: FlowFilter | None = None,
    bucket_minutes: int = 1,
    limit: int | None = None,
    bucket_seconds: int | None = None,
) -> DataFrame:
    """Total size by (time bucket, future strike)."""
    cells = heatmap_cells(flow, f, bucket_minutes, bucket_seconds)
    return ordered(cells, ["time_bucket", "future_strike"], limit, 50000)


def volume_over_time(heatmap_df: DataFrame) -> DataFrame:
    """Heatmap cells, best those of `heatmap_cells`, summed over strikes, NULL counted as 0."""
    total = measures(total_size="sum(coalesce(total_size, 0D))")
    return ordered(heatmap_df.groupBy("time_bucket").agg(*total), ["time_bucket"], None, 0)


def spread_measures() -> list[Column]:
    """Means of the two sides, and their row counts to tell which buckets hold both."""
    ask, bid = "Side = 'Ask'", "Side = 'Bid'"
    return measures(
        ask_strike=f"avg(CASE WHEN {ask} THEN future_strike END)",
        bid_strike=f"avg(CASE WHEN {bid} THEN future_strike END)",
        ask_spx_price=f"avg(CASE WHEN {ask} THEN spx_price END)",
        ask_rows=f"count_if({ask})",
        bid_rows=f"count_if({bid})",
    )


def spread_from_sides(sides: DataFrame) -> DataFrame:
    """Spread and price of the timed buckets that hold both sides."""
    return sides.where("time_bucket IS NOT NULL AND ask_rows > 0 AND bid_rows > 0").selectExpr(
        "time_bucket", "ask_strike - bid_strike AS spread", "ask_spx_price AS spx_price"
    )


def spread(
    flow: DataFrame,
    f: FlowFilter | None = None,
    bucket_minutes: int = 1,
    limit: int | None = None,
    bucket_seconds: int | None = None,
) -> DataFrame:
    """Mean ask strike minus mean bid strike by time bucket, with the mean price of the ask rows.

    One aggregation holds both sides side by side, so the self-join of the two legs is not needed.
    """
    bucket = bucket_column(bucket_minutes, bucket_seconds)
    sides = (
        apply_filters(flow, f)
        .withColumn("time_bucket", bucket)
        .groupBy("time_bucket")
        .agg(*spread_measures())
    )
    return ordered(spread_from_sides(sides), ["time_bucket"], limit, 50000)


def depth_cells(flow: DataFrame, f: FlowFilter | None = None) -> DataFrame:
    """Event count and total size by (future strike, Side), in no order."""
    sized = with_mbo_size(apply_filters(flow, f))
    return sized.groupBy("future_strike", "Side").agg(
        *measures(event_count="count(*)", total_size="sum(mbo_size)")
    )


def depth(flow: DataFrame, f: FlowFilter | None = None, limit: int | None = None) -> DataFrame:
    """Event count and total size by (future strike, Side); strike bounds apply to the SPX strike."""
    return ordered(depth_cells(flow, f), ["future_strike", "Side"], limit, 20000)


def depth_ladder(depth_df: DataFrame, top: int = 40) -> DataFrame:
    """Bid size up, ask size down, for the `top` strikes of the largest combined size."""
    size_of = "coalesce(sum(CASE WHEN Side = '{}' THEN total_size END), 0D)"
    ladder = depth_df.groupBy(F.expr("future_strike AS strike")).agg(
        *measures(bid=size_of.format("Bid"), ask=f"0D - {size_of.format('Ask')}")
    )
    combined = F.expr("abs(bid) + abs(ask)")
    return ladder.orderBy(combined.desc(), F.asc("strike")).limit(top).orderBy("strike")


def histogram_values(
    flow: DataFrame, f: FlowFilter | None = None, fraction: float | None = None, seed: int = 42, rows: int | None = None
) -> DataFrame:
    """Every single order size; `rows` asks for those of exactly so many sampled events, `fraction` for a seeded share."""
    events = apply_filters(flow, f)
    if rows is not None:
        sizes = [name for name in ("mbo_sizes",) if name in events.columns]
        events = exact_sample(events.select(*KEY, "MBO", *sizes), rows, KEY, seed)
    if fraction is not None:
        events = events.sample(fraction=fraction, seed=seed)
    return explode_mbo(events)


def size_counts(flow: DataFrame, f: FlowFilter | None = None) -> DataFrame:
    """Number of occurrences of each order size; sizes repeat, so this is small against the events."""
    values = histogram_values(flow, f)
    return values.groupBy("mbo_value").agg(*measures(occurrences="count(*)"))


def histogram_bins(
    flow: DataFrame, f: FlowFilter | None = None, bins: int = 40
) -> DataFrame:
    """Positive order sizes counted in `bins` equal bins from 0 to the largest size, empty bins included.

    Both the largest size and the bins come from the counts per size, so the events are read once: the two
    branches share one shuffle.
    """
    check_range("bins", bins, 5, 200)
    return bin_counts(size_counts(flow, f), bins)


def bin_counts(sizes: DataFrame, bins: int) -> DataFrame:
    """Equal-width bins over a (mbo_value, occurrences) frame."""
    # The test on occurrences is always true; it keeps the two branches the same up to the shuffle.
    positive = sizes.where("mbo_value > 0 AND occurrences > 0")
    largest = positive.selectExpr("max(mbo_value) AS largest").where("largest IS NOT NULL")
    step = f"(largest / {bins}D)"
    position = f"CAST(least(floor(mbo_value / {step}), {bins - 1}) AS INT)"
    counted = (
        positive.crossJoin(F.broadcast(largest))
        .groupBy(F.expr(f"{position} AS bin"))
        .agg(*measures(filled="sum(occurrences)"))
    )
    every_bin = (
        sizes.sparkSession.range(bins, numPartitions=1)
        .crossJoin(F.broadcast(largest))
        .selectExpr("CAST(id AS INT) AS bin", f"id * {step} AS lower_edge")
    )
    return (
        every_bin.join(F.broadcast(counted), "bin", "left")
        .selectExpr(
            "bin",
            "lower_edge",
            "CAST(CAST(round(lower_edge, 0) AS BIGINT) AS STRING) AS range",
            "coalesce(filled, 0L) AS count",
        )
        .orderBy("bin")
    )
