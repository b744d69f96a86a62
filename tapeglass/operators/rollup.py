"""Partial sums by (5 seconds, future strike, side), from which bucketed queries of any multiple are answered.

Sums and counts add up, so cells of several appends, of late ones and of files that hold the same five seconds stand side
by side until a query adds them. The closing instant belongs to the session and what follows it does not, so cells tell
session rows from others. Results are those of the queries over the events.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, functions as F

from tapeglass.functions.scalars import IS_ASK, IS_BID, SIDE_SIGN, es_points, measures
from tapeglass.functions.time import in_session, time_bucket, wall_literal
from tapeglass.operators.filters import FlowFilter
from tapeglass.operators.greeks import bucket_column
from tapeglass.operators.ordering import ordered
from tapeglass.operators.volume import spread_from_sides
from tapeglass.schema import SIDES

CELL_SECONDS = 5
#: Price scale that the stored means of the ES price are in.
ES_SCALE = 100.0
CELL = ["date", "cell", "future_strike", "Side", "in_session"]


def rollup_cells(rows: DataFrame) -> DataFrame:
    """Partial sums of stored rows (with `wall_time`, `mbo_size` and `file`) by file and cell."""
    points = es_points(ES_SCALE)
    sums = measures(
        events="count(*)",
        size_sum="sum(mbo_size)",
        es_sum=f"sum(CAST({points} AS DOUBLE))",
        es_rows=f"count({points})",
        price_sum="sum(CAST(spx_price AS DOUBLE))",
        price_rows="count(spx_price)",
        basis_sum=f"sum(CAST({points} - spx_price AS DOUBLE))",
        basis_rows=f"count({points} - spx_price)",
        call_flow="sum(call_delta * mbo_size)",
        put_flow="sum(-put_delta * mbo_size)",
        net_flow="sum((call_delta - put_delta) * mbo_size)",
        exposure="sum(call_gamma * mbo_size)",
    )
    cell = time_bucket("wall_time", seconds=CELL_SECONDS)
    session = F.coalesce(in_session("wall_time"), F.lit(False))
    return rows.withColumns({"cell": cell, "in_session": session}).groupBy("file", *CELL).agg(*sums)


def _kept(cells: DataFrame, f: FlowFilter | None) -> DataFrame:
    """Cells of the rows that the filter keeps; bounds that cut through cells cannot be answered."""
    f = f or FlowFilter()
    if any(bound is not None for bound in (f.strike_min, f.strike_max, f.t_min, f.t_max)):
        raise ValueError("the rollup holds no SPX strikes and expiries")

    def cell_start(bound, name: str):
        moment = wall_literal(bound)
        if moment.microsecond or moment.second % CELL_SECONDS:
            raise ValueError(f"{name} must lie on a border of {CELL_SECONDS} seconds")
        return F.lit(moment.isoformat()).cast("timestamp_ntz")

    if f.start:
        cells = cells.where((F.col("cell") >= cell_start(f.start, "start")) & (F.col("date") >= F.lit(wall_literal(f.start).date())))
    if f.end:
        # Bounds are inclusive: the last microsecond of a cell.
        after = cell_start(wall_literal(f.end) + timedelta(microseconds=1), "the microsecond after end")
        cells = cells.where((F.col("cell") < after) & (F.col("date") <= F.lit(wall_literal(f.end).date())))
    if f.side in SIDES:
        cells = cells.where(F.col("Side") == f.side)
    return cells.where("in_session") if f.market_hours else cells


def _bucketed(cells: DataFrame, f: FlowFilter | None, minutes: int, seconds: int | None) -> DataFrame:
    if seconds is not None and seconds % CELL_SECONDS:
        raise ValueError(f"bucket_seconds must be a multiple of {CELL_SECONDS}")
    bucket_column(minutes, seconds)  # checks the range
    width = {"seconds": seconds} if seconds is not None else {"minutes": minutes}
    return _kept(cells, f).withColumn("time_bucket", time_bucket("cell", **width))


def _mean(total: str, rows: str) -> str:
    return f"try_divide(sum({total}), sum({rows}))"


def _by_bucket(cells: DataFrame, f: FlowFilter | None, minutes: int, seconds: int | None, sums: list[Column]) -> DataFrame:
    return _bucketed(cells, f, minutes, seconds).groupBy("time_bucket").agg(*sums)


def rollup_basis(cells: DataFrame, f: FlowFilter | None = None, bucket_minutes: int = 1, bucket_seconds: int | None = None) -> DataFrame:
    """As `basis`."""
    means = measures(
        es_price=_mean("es_sum", "es_rows"), spx_price=_mean("price_sum", "price_rows"), basis=_mean("basis_sum", "basis_rows")
    )
    return ordered(_by_bucket(cells, f, bucket_minutes, bucket_seconds, means), ["time_bucket"], None, 0)


def rollup_net_flow(cells: DataFrame, f: FlowFilter | None = None, bucket_minutes: int = 1, bucket_seconds: int | None = None) -> DataFrame:
    """As `net_flow`."""
    sums = measures(call_delta_flow="sum(call_flow)", put_delta_flow="sum(put_flow)", net_delta="sum(net_flow)")
    return ordered(_by_bucket(cells, f, bucket_minutes, bucket_seconds, sums), ["time_bucket"], None, 0)


def rollup_heatmap(cells: DataFrame, f: FlowFilter | None = None, bucket_minutes: int = 1, bucket_seconds: int | None = None) -> DataFrame:
    """As `heatmap`."""
    grouped = _bucketed(cells, f, bucket_minutes, bucket_seconds).groupBy("time_bucket", "future_strike")
    return ordered(grouped.agg(*measures(total_size="sum(size_sum)")), ["time_bucket", "future_strike"], None, 0)


def rollup_spread(cells: DataFrame, f: FlowFilter | None = None, bucket_minutes: int = 1, bucket_seconds: int | None = None) -> DataFrame:
    """As `spread`."""

    def strike(side: str) -> str:
        here = f"CASE WHEN Side = '{side}' AND future_strike IS NOT NULL THEN"
        return f"try_divide(sum({here} CAST(future_strike AS DOUBLE) * events END), sum({here} events END))"

    ask = "CASE WHEN Side = 'Ask' THEN {} END"
    sums = measures(
        ask_strike=strike("Ask"),
        bid_strike=strike("Bid"),
        ask_spx_price=_mean(ask.format("price_sum"), ask.format("price_rows")),
        ask_rows="count_if(Side = 'Ask')",
        bid_rows="count_if(Side = 'Bid')",
    )
    sides = _by_bucket(cells, f, bucket_minutes, bucket_seconds, sums)
    return ordered(spread_from_sides(sides), ["time_bucket"], None, 0)


def rollup_gex_intraday(cells: DataFrame, f: FlowFilter | None = None, bucket_minutes: int = 5, bucket_seconds: int | None = None) -> DataFrame:
    """As `gex_intraday`."""
    sums = measures(
        spx_price=_mean("price_sum", "price_rows"),
        long_gex=f"sum(exposure * {IS_BID})",
        short_gex=f"sum(exposure * {IS_ASK})",
        net_gex=f"sum(exposure * {SIDE_SIGN})",
    )
    return ordered(_by_bucket(cells, f, bucket_minutes, bucket_seconds, sums), ["time_bucket"], None, 0)


def rollup_depth(cells: DataFrame, f: FlowFilter | None = None) -> DataFrame:
    """As `depth`."""
    grouped = _kept(cells, f).groupBy("future_strike", "Side")
    return ordered(grouped.agg(*measures(event_count="sum(events)", total_size="sum(size_sum)")), ["future_strike", "Side"], None, 0)
