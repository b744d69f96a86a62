"""Small expressions shared by the queries.

They are written as SQL text: one parse per expression builds a plan several times faster than a chain of
column calls, which matters for queries with dozens of measures.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

IS_BID = "CASE WHEN Side = 'Bid' THEN 1D ELSE 0D END"
IS_ASK = "CASE WHEN Side = 'Ask' THEN 1D ELSE 0D END"
# NULL and unknown sides count as negative.
SIDE_SIGN = "CASE WHEN Side = 'Bid' THEN 1D ELSE -1D END"
PS_EVENT = "CASE WHEN MBO_pulling_stacking != 0 THEN 1 ELSE 0 END"


def finite_or_null(df: DataFrame) -> DataFrame:
    """Replace NaN and both infinities by NULL in every floating-point column."""

    def finite(field: T.StructField) -> str:
        name = f"`{field.name}`"
        if not isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            return name
        return f"CASE WHEN NOT (isnan({name}) OR abs({name}) = double('inf')) THEN {name} END AS {name}"

    return df.selectExpr(*[finite(field) for field in df.schema.fields])


def es_points(scale: float) -> str:
    """ES price in index points, kept in single precision."""
    return f"CAST(current_es_price / {float(scale)!r}D AS FLOAT)"


def expiry_4() -> Column:
    """Time to expiry rounded to four places, halves away from zero.

    Plain double arithmetic: `round` on a FLOAT goes through a decimal object per row. Values too large to have
    decimal places, infinities and NaN stay as they are.
    """
    rounded = "CAST(signum(t) * floor(abs(t) * 10000D + 0.5D) / 10000D AS FLOAT)"
    return F.expr(f"CASE WHEN abs(t) < 1e9D THEN {rounded} ELSE t END AS t")


def measures(**columns: str) -> list[Column]:
    """Aggregates by output name, each given as SQL text."""
    return [F.expr(f"{text} AS `{name}`") for name, text in columns.items()]
