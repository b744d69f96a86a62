"""Price and flow signals: headline figures, basis, net flow, pulling and stacking."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, functions as F

from tapeglass.functions.mbo import with_mbo_size
from tapeglass.functions.scalars import PS_EVENT, es_points, finite_or_null, measures
from tapeglass.functions.time import in_session, time_bucket
from tapeglass.operators.filters import FlowFilter, apply_filters
from tapeglass.operators.greeks import bucket_column
from tapeglass.operators.ordering import check_range, first_events, last_events, ordered

PS_COLUMNS = ["timestamp", "spx_price", "MBO_pulling_stacking"]
PS_ORDER = ["timestamp", "Side", "future_strike"]


def kpi_measures() -> list[Column]:
    return measures(
        events="count(*)",
        first_time="min(timestamp)",
        last_time="max(timestamp)",
        price_sum="sum(CAST(spx_price AS DOUBLE))",
        price_rows="count(spx_price)",
        ps_events=f"sum({PS_EVENT})",
    )


def kpi_from_strikes(by_strike: DataFrame) -> DataFrame:
    """The headline row from `kpi_measures` grouped at least by spx_strike and future_strike."""
    row = by_strike.agg(
        *measures(
            total_events="coalesce(sum(events), 0L)",
            unique_strikes="count(DISTINCT spx_strike)",
            start_date="min(first_time)",
            end_date="max(last_time)",
            unique_es_strikes="count(DISTINCT future_strike)",
            avg_spx_price="try_divide(sum(price_sum), sum(price_rows))",
            total_ps_events="sum(ps_events)",
        )
    )
    return finite_or_null(row)


def kpi(flow: DataFrame, f: FlowFilter | None = None) -> DataFrame:
    """One row: event, strike and pulling/stacking counts, time range and mean price.

    Grouping by the two strikes first turns the distinct counts into counts over a few thousand strike pairs;
    on the events themselves they would triple every row before the shuffle.
    """
    pairs = apply_filters(flow, f).groupBy("spx_strike", "future_strike").agg(*kpi_measures())
    return kpi_from_strikes(pairs)


def basis_measures(es_scale: float = 100.0) -> list[Column]:
    points = es_points(es_scale)
    return measures(
        es_price=f"avg({points})", spx_price="avg(spx_price)", basis=f"avg({points} - spx_price)"
    )


def basis(
    flow: DataFrame,
    f: FlowFilter | None = None,
    bucket_minutes: int = 1,
    limit: int | None = None,
    es_scale: float = 100.0,
    bucket_seconds: int | None = None,
) -> DataFrame:
    """Mean ES price in points, mean SPX price and mean difference by time bucket."""
    bucket = bucket_column(bucket_minutes, bucket_seconds)
    events = apply_filters(flow, f).withColumn("time_bucket", bucket)
    means = events.groupBy("time_bucket").agg(*basis_measures(es_scale))
    return ordered(means, ["time_bucket"], limit, 50000)


def net_flow_measures() -> list[Column]:
    return measures(
        call_delta_flow="sum(call_delta * mbo_size)",
        put_delta_flow="sum(-put_delta * mbo_size)",
        net_delta="sum((call_delta - put_delta) * mbo_size)",
    )


def net_flow(
    flow: DataFrame,
    f: FlowFilter | None = None,
    bucket_minutes: int = 1,
    limit: int | None = None,
    bucket_seconds: int | None = None,
) -> DataFrame:
    """Delta-weighted size by time bucket: call, put and net."""
    bucket = bucket_column(bucket_minutes, bucket_seconds)
    sized = with_mbo_size(apply_filters(flow, f)).withColumn("time_bucket", bucket)
    return ordered(sized.groupBy("time_bucket").agg(*net_flow_measures()), ["time_bucket"], limit, 50000)


def minute_rows(rows: DataFrame) -> DataFrame:
    """Events and pulling/stacking events of stored rows (with `wall_time` and `file`) by file, minute and session."""
    session = F.coalesce(in_session("wall_time"), F.lit(False)).alias("in_session")
    minute = time_bucket("wall_time", minutes=1).alias("minute")
    return rows.groupBy("file", "date", minute, session).agg(*measures(events="count(*)", ps_events=f"sum({PS_EVENT})"))


def _counts(minutes: DataFrame | None, f: FlowFilter | None, only_events: bool) -> DataFrame | None:
    """(minute, events) of the rows that the filter keeps, from `minute_rows`."""
    if minutes is None:
        return None
    if replace(f or FlowFilter(), market_hours=True) != FlowFilter():
        raise ValueError("counts by minute know the session only, no other filter")
    kept = minutes.where("in_session") if (f or FlowFilter()).market_hours else minutes
    return kept.select("minute", F.col("ps_events" if only_events else "events").alias("events"))


def _ps_events(flow: DataFrame, f: FlowFilter | None, only_events: bool) -> DataFrame:
    events = apply_filters(flow, f)
    if only_events:
        events = events.where("MBO_pulling_stacking != 0")
    # The date partition lets the time cut skip whole days.
    partition = [name for name in ("date",) if name in events.columns]
    return events.select(*dict.fromkeys(PS_COLUMNS + PS_ORDER + partition))


def pulling_stacking(
    flow: DataFrame,
    f: FlowFilter | None = None,
    limit: int | None = None,
    only_events: bool = False,
    in_order: bool = False,
    minutes: DataFrame | None = None,
) -> DataFrame:
    """Time, price and pulling/stacking mark; `only_events` drops the rows marked 0.

    All rows by default, sorted by time if `in_order` asks for it; with a limit the earliest ones in time order. With the
    table's `minutes` (`minute_rows`) a limit finds its last minute without a look at the events.
    """
    events = _ps_events(flow, f, only_events)
    if limit is not None:
        check_range("limit", limit, 1, 100000)
        events = first_events(events, limit, PS_ORDER, _counts(minutes, f, only_events))
    elif in_order:
        events = events.orderBy([F.col(name).asc_nulls_last() for name in PS_ORDER])
    return finite_or_null(events.select(PS_COLUMNS))


def recent_pulling_stacking(
    flow: DataFrame, f: FlowFilter | None = None, n: int = 500, only_events: bool = False, minutes: DataFrame | None = None
) -> DataFrame:
    """The last `n` rows of the pulling/stacking series, in time order; `minutes` as for `pulling_stacking`."""
    events = _ps_events(flow, f, only_events)
    last = last_events(events, n, PS_ORDER, _counts(minutes, f, only_events))
    return finite_or_null(last.select(PS_COLUMNS))


def ps_split(ps: DataFrame) -> DataFrame:
    """Add the price under `pulling` where the mark is negative and under `stacking` where it is positive."""
    return ps.selectExpr(
        "*",
        "CASE WHEN MBO_pulling_stacking < 0 THEN spx_price END AS pulling",
        "CASE WHEN MBO_pulling_stacking > 0 THEN spx_price END AS stacking",
    )
