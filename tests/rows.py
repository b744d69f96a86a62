"""Hand-made flow rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tapeglass.schema import FLOW_SCHEMA

# The query view: wall-clock timestamps, everything else as stored.
VIEW_SCHEMA = T.StructType(
    [
        T.StructField(f.name, T.TimestampNTZType() if f.name == "timestamp" else f.dataType)
        for f in FLOW_SCHEMA.fields
    ]
)

DEFAULTS = {f.name: 1.0 if isinstance(f.dataType, T.FloatType) else 1 for f in FLOW_SCHEMA.fields}
DEFAULTS |= {
    "timestamp": datetime(2025, 4, 14, 10, 0),
    "Side": "Bid",
    "MBO": "[1.0]",
    "MBO_pulling_stacking": 0,
    "spx_strike": 5300,
    "future_strike": 5300.0,
    "t": 0.01,
    "spx_price": 5300.0,
    "current_es_price": 530100.0,
}


def flow_of(spark: SparkSession, *rows: dict) -> DataFrame:
    return spark.createDataFrame([tuple({**DEFAULTS, **r}.values()) for r in rows], VIEW_SCHEMA)


CSV_COLUMNS = FLOW_SCHEMA.fieldNames()


def csv_line(**values: str) -> str:
    row = {name: "1.0" for name in CSV_COLUMNS} | {
        "timestamp": "2025-04-22T15:47:00.237904-04:00",
        "Side": "Ask",
        "future_strike": "5362.0",
        "MBO": '"[4.0]"',
        "MBO_pulling_stacking": "0",
        "spx_strike": "5362",
    }
    row |= values
    return ",".join(row[name] for name in CSV_COLUMNS)


def write_csv(path, *lines: str, header: str | None = None) -> str:
    path.write_text("\n".join([header or ",".join(CSV_COLUMNS), *lines]) + "\n")
    return str(path)


def column(df: DataFrame, name: str) -> list:
    return [row[0] for row in df.select(F.col(name)).collect()]
