"""The flow table derived from the benchmark `events` table, for checks and timings.

The expressions mean the same in Spark SQL and in other ANSI engines, so a check can derive the same table
independently. Divisions are by DOUBLE: a decimal literal would lose digits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _dyadic(numerator: str, divisor: int, then: str = "") -> str:
    return f"CAST(CAST(({numerator}) AS DOUBLE) / {divisor}{then} AS FLOAT)"


def _negative(numerator: str, divisor: int) -> str:
    return f"CAST(-CAST(({numerator}) AS DOUBLE) / {divisor} AS FLOAT)"


def _digits(expression: str) -> str:
    return f"CAST({expression} AS VARCHAR(10))"


FLOW_FROM_EVENTS = {
    "timestamp": "CASE WHEN event_id % 101 = 17 THEN NULL ELSE ts END",
    "Side": "CASE WHEN event_id % 67 = 5 THEN NULL WHEN event_id % 2 = 0 THEN 'Bid' ELSE 'Ask' END",
    "future_strike": "CAST(5250 + user_id % 89 AS FLOAT)",
    "MBO": (
        "CASE WHEN event_id % 211 = 3 THEN '[1.0,' ELSE CASE event_id % 5 WHEN 0 THEN '[]'"
        f" WHEN 1 THEN concat('[', {_digits('user_id % 9 + 1')}, '.0]')"
        f" WHEN 2 THEN concat('[', {_digits('user_id % 7 + 1')}, '.0, 6.0]')"
        f" WHEN 3 THEN concat('[1.0, ', {_digits('user_id % 5 + 1')}, '.0, 2.5]') ELSE NULL END END"
    ),
    "MBO_pulling_stacking": "CAST(CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN -1 ELSE 0 END AS SMALLINT)",
    "current_es_price": "CAST(528000 + event_id % 400 AS FLOAT)",
    "spx_strike": "CAST(5230 + user_id % 97 AS INT)",
    "t": (
        "CASE WHEN event_id % 53 = 7 THEN NULL WHEN event_id % 59 = 11 THEN CAST('Infinity' AS FLOAT)"
        f" ELSE {_dyadic('event_id % 12', 365)} END"
    ),
    "spx_price": "CAST(5270 + CAST((event_id % 64) AS DOUBLE) / 16 AS FLOAT)",
    "call_charm": _dyadic("user_id % 16 - 8", 16384),
    "call_delta": _dyadic("user_id % 128", 128),
    "call_gamma": _dyadic("user_id % 32", 4096),
    "call_rho": _dyadic("user_id % 61", 32),
    "call_theta": _negative("event_id % 37", 8),
    "call_vanna": _dyadic("user_id % 23 - 11", 128),
    "call_vega": _dyadic("user_id % 29", 16),
    "call_vomma": f"CASE WHEN event_id % 50 = 0 THEN NULL WHEN event_id % 499 = 5 THEN CAST('NaN' AS FLOAT) ELSE {_dyadic('event_id % 41 - 20', 8)} END",
    "put_charm": _dyadic("user_id % 13 - 6", 16384),
    "put_delta": _dyadic("user_id % 128", 128, " - 1"),
    "put_gamma": _dyadic("user_id % 31", 4096),
    "put_rho": _negative("user_id % 59", 32),
    "put_theta": _negative("event_id % 31", 8),
    "put_vanna": _dyadic("user_id % 19 - 9", 128),
    "put_vega": _dyadic("user_id % 27", 16),
    "put_vomma": _dyadic("event_id % 43 - 20", 8),
}


def flow_expressions() -> list[str]:
    return [f"{expression} AS {name}" for name, expression in FLOW_FROM_EVENTS.items()]


def flow_from_events(events: DataFrame, *keep: str) -> DataFrame:
    """The 25 flow columns of an events frame, and the events columns named in `keep`."""
    return events.selectExpr(*keep, *flow_expressions())


EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)


def load_flow(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    return flow_from_events(spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet"), *keep)
