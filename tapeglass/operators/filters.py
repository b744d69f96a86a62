"""The filter set that every query accepts."""

from __future__ import annotations

import math
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, functions as F, types as T

from tapeglass.functions.time import in_session, instant_literal, wall_clock, wall_literal
from tapeglass.schema import SIDES


@dataclass(frozen=True)
class FlowFilter:
    """Row filters; every bound is inclusive and None means no bound.

    `start` and `end` without an offset are New York wall-clock time. A `side` outside Bid and Ask is ignored.
    """

    start: str | datetime | None = None
    end: str | datetime | None = None
    side: str | None = None
    strike_min: float | None = None
    strike_max: float | None = None
    t_min: float | None = None
    t_max: float | None = None
    market_hours: bool = True


ALL_ROWS = FlowFilter(market_hours=False)


def _time_bounds(flow: DataFrame, f: FlowFilter) -> DataFrame:
    """Bounds on the column as it is stored, so that they reach the scan, and on the date partitions."""
    stored_instant = isinstance(flow.schema["timestamp"].dataType, T.TimestampType)

    def bound(value):
        if stored_instant:
            return F.lit(instant_literal(value))
        return F.lit(wall_literal(value).isoformat()).cast("timestamp_ntz")

    dated = "date" in flow.columns
    if f.start:
        flow = flow.where(F.col("timestamp") >= bound(f.start))
        if dated:
            flow = flow.where(F.col("date") >= F.lit(wall_literal(f.start).date()))
    if f.end:
        flow = flow.where(F.col("timestamp") <= bound(f.end))
        if dated:
            flow = flow.where(F.col("date") <= F.lit(wall_literal(f.end).date()))
    return flow


def apply_filters(flow: DataFrame, f: FlowFilter | None = None) -> DataFrame:
    """Filter the flow and turn `timestamp` into New York wall clock (TIMESTAMP_NTZ)."""
    f = f or FlowFilter()
    flow = _time_bounds(flow, f)
    if f.side in SIDES:
        flow = flow.where(F.col("Side") == f.side)
    # Strikes are integers: whole bounds compare without a cast and are pushed to the scan.
    if f.strike_min is not None:
        flow = flow.where(F.col("spx_strike") >= math.ceil(f.strike_min))
    if f.strike_max is not None:
        flow = flow.where(F.col("spx_strike") <= math.floor(f.strike_max))
    if f.t_min is not None:
        flow = flow.where(F.col("t") >= F.lit(float(f.t_min)))
    if f.t_max is not None:
        flow = flow.where(F.col("t") <= F.lit(float(f.t_max)))
    if isinstance(flow.schema["timestamp"].dataType, T.TimestampType):
        stored = "wall_time" in flow.columns
        wall = F.col("wall_time") if stored else wall_clock(F.col("timestamp"))
        flow = flow.withColumn("timestamp", wall).drop("wall_time")
    if f.market_hours:
        flow = flow.where(in_session())
    return flow
