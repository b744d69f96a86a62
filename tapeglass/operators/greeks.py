"""Greek profiles by strike and expiry, and gamma exposure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from tapeglass.functions.mbo import with_mbo_size
from tapeglass.functions.scalars import IS_ASK, IS_BID, SIDE_SIGN, expiry_4, measures
from tapeglass.functions.time import time_bucket
from tapeglass.operators.filters import FlowFilter, apply_filters
from tapeglass.operators.ordering import check_range, ordered
from tapeglass.schema import GREEKS

METRICS = ["vanna", "charm"]


def surface(
    flow: DataFrame, greek: str = "call_vega", f: FlowFilter | None = None, limit: int | None = None
) -> DataFrame:
    """Mean of one greek by (spx_strike, t rounded to four places)."""
    if greek not in GREEKS:
        raise ValueError(f"unknown greek {greek}; choose one of {GREEKS}")
    grouped = apply_filters(flow, f).groupBy("spx_strike", expiry_4())
    return ordered(grouped.agg(*measures(greek_value=f"avg({greek})")), ["spx_strike", "t"], limit, 50000)


def surface_all(
    flow: DataFrame, f: FlowFilter | None = None, greeks: list[str] | None = None
) -> DataFrame:
    """Mean of several greeks (all 16 by default) by (spx_strike, t), in one pass over the table."""
    grouped = apply_filters(flow, f).groupBy("spx_strike", expiry_4())
    means = grouped.agg(*measures(**{g: f"avg({g})" for g in greeks or GREEKS}))
    return ordered(means, ["spx_strike", "t"], None, 0)


def vanna_charm(
    flow: DataFrame, metric: str = "vanna", f: FlowFilter | None = None, limit: int | None = None
) -> DataFrame:
    """Mean call and put vanna (or charm) by strike."""
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    means = apply_filters(flow, f).groupBy("spx_strike").agg(
        *measures(call_value=f"avg(call_{metric})", put_value=f"avg(put_{metric})")
    )
    return ordered(means, ["spx_strike"], limit, 10000)


def theta(flow: DataFrame, f: FlowFilter | None = None, limit: int | None = None) -> DataFrame:
    """Mean call and put theta by (spx_strike, t rounded to four places)."""
    means = apply_filters(flow, f).groupBy("spx_strike", expiry_4()).agg(
        *measures(call_theta="avg(call_theta)", put_theta="avg(put_theta)")
    )
    return ordered(means, ["spx_strike", "t"], limit, 50000)


def scatter(flow: DataFrame, f: FlowFilter | None = None, limit: int | None = None) -> DataFrame:
    """Mean call vega, mean call vomma and event count by strike."""
    means = apply_filters(flow, f).groupBy("spx_strike").agg(
        *measures(call_vega="avg(call_vega)", call_vomma="avg(call_vomma)", mbo_count="count(*)")
    )
    return ordered(means, ["spx_strike"], limit, 50000)


def gex_measures() -> list[Column]:
    """Mean price and the call-gamma exposure sums; needs `mbo_size`."""
    exposure = "call_gamma * mbo_size"
    return measures(
        spx_price="avg(spx_price)",
        long_gex=f"sum({exposure} * {IS_BID})",
        short_gex=f"sum({exposure} * {IS_ASK})",
        net_gex=f"sum({exposure} * {SIDE_SIGN})",
    )


def gex_cells(flow: DataFrame, f: FlowFilter | None = None) -> DataFrame:
    """Gamma exposure by strike, in no order."""
    return with_mbo_size(apply_filters(flow, f)).groupBy("spx_strike").agg(*gex_measures())


def gex(flow: DataFrame, f: FlowFilter | None = None, limit: int | None = None) -> DataFrame:
    """Gamma exposure by strike: call gamma times size, Bid rows long, Ask rows short."""
    return ordered(gex_cells(flow, f), ["spx_strike"], limit, 5000)


def gex_intraday(
    flow: DataFrame,
    f: FlowFilter | None = None,
    bucket_minutes: int = 5,
    limit: int | None = None,
    bucket_seconds: int | None = None,
) -> DataFrame:
    """Gamma exposure by time bucket."""
    bucket = bucket_column(bucket_minutes, bucket_seconds)
    sized = with_mbo_size(apply_filters(flow, f)).withColumn("time_bucket", bucket)
    return ordered(sized.groupBy("time_bucket").agg(*gex_measures()), ["time_bucket"], limit, 10000)


def bucket_column(minutes: int, seconds: int | None = None) -> Column:
    """The bucket of a query: whole minutes from 1 to 60, or seconds when given."""
    if seconds is not None:
        return time_bucket(seconds=seconds)
    check_range("bucket_minutes", minutes, 1, 60)
    return time_bucket(minutes=minutes)
