"""Order sizes: the MBO column is a JSON array of doubles held as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# NULL for NULL, scalars and malformed text.
PARSED_SIZES = "from_json(MBO, 'array<double>')"


def _sum_of(sizes: str) -> str:
    """Sum of the non-NULL sizes; NULL when there is none."""
    return f"aggregate({sizes}, CAST(NULL AS DOUBLE), (total, size) -> coalesce(total + size, size, total))"


def parse_sizes() -> Column:
    """The MBO text as ARRAY<DOUBLE>."""
    return F.expr(PARSED_SIZES)


def sum_sizes(sizes: str = "mbo_sizes") -> Column:
    return F.expr(_sum_of(sizes))


def _sizes(flow: DataFrame) -> str:
    return "mbo_sizes" if "mbo_sizes" in flow.columns else PARSED_SIZES


def with_mbo_size(flow: DataFrame) -> DataFrame:
    """Add `mbo_size`, taking the cheapest source the frame offers.

    Stored tables carry the parsed sum, so their queries never touch the JSON text.
    """
    if "mbo_size" in flow.columns:
        return flow
    return flow.withColumn("mbo_size", sum_sizes(_sizes(flow)))


def explode_mbo(flow: DataFrame) -> DataFrame:
    """One row `mbo_value` per single order size; empty and NULL arrays give no row."""
    return flow.select(F.expr(f"explode({_sizes(flow)}) AS mbo_value"))
