"""The flow table: one row per (timestamp, Side, future_strike) order-book event."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names, their order and their types are the data contract.
GREEK_NAMES = ["charm", "delta", "gamma", "rho", "theta", "vanna", "vega", "vomma"]
CALL_GREEKS = [f"call_{g}" for g in GREEK_NAMES]
PUT_GREEKS = [f"put_{g}" for g in GREEK_NAMES]
GREEKS = CALL_GREEKS + PUT_GREEKS
SIDES = ["Bid", "Ask"]
KEY = ["timestamp", "Side", "future_strike"]

FLOW_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("Side", T.StringType()),
        T.StructField("future_strike", T.FloatType()),
        T.StructField("MBO", T.StringType()),
        T.StructField("MBO_pulling_stacking", T.ShortType()),
        T.StructField("current_es_price", T.FloatType()),
        T.StructField("spx_strike", T.IntegerType()),
        T.StructField("t", T.FloatType()),
        T.StructField("spx_price", T.FloatType()),
        *[T.StructField(g, T.FloatType()) for g in GREEKS],
    ]
)
FLOW_COLUMNS = FLOW_SCHEMA.fieldNames()

# The zone whose wall clock the exchange session, the buckets and the dates follow.
MARKET_ZONE = "America/New_York"
