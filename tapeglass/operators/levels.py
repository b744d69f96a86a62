"""Price levels and near-price profile, from gamma exposure by strike (a few hundred rows)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tapeglass.functions.scalars import measures

NET = "coalesce(net_gex, 0D)"
PRICE = "avg(coalesce(spx_price, 0D))"
# The highest crossing.
FLIP_POINT = "max_by(flip, CASE WHEN flip IS NOT NULL THEN spx_strike END)"


def _strike_of_largest(amount: str) -> str:
    """Strike of the largest amount; the lowest strike wins a tie."""
    return f"max_by(spx_strike, struct({amount}, -spx_strike))"


def _with_flip(gex_df: DataFrame) -> DataFrame:
    """Mark each strike whose exposure is at most 0 right below a strike with positive exposure.

    The window has no partition key on purpose: its input is one row per strike, already aggregated.
    """
    above = f"lag(struct(spx_strike, {NET} AS net)) OVER (ORDER BY spx_strike DESC)"
    return gex_df.selectExpr("*", f"{above} AS above").selectExpr(
        "*",
        f"CASE WHEN above.net > 0 AND {NET} <= 0 THEN (above.spx_strike + spx_strike) / 2D END AS flip",
    )


def gex_levels(gex_df: DataFrame) -> DataFrame:
    """One row of levels, or none for empty input.

    The price is the plain mean of the per-strike mean prices.
    """
    levels = _with_flip(gex_df).agg(
        *measures(
            strikes="count(*)",
            price=PRICE,
            total_net_gex=f"sum({NET})",
            pin_strike=_strike_of_largest(f"abs({NET})"),
            long_wall=_strike_of_largest("coalesce(long_gex, 0D)"),
            short_wall=_strike_of_largest("coalesce(short_gex, 0D)"),
            flip_point=FLIP_POINT,
        )
    )
    return levels.where("strikes > 0").selectExpr(
        "price",
        "total_net_gex",
        "pin_strike",
        "long_wall",
        "short_wall",
        "flip_point",
        "CASE WHEN total_net_gex > 0 THEN 'LONG GAMMA' ELSE 'SHORT GAMMA' END AS regime",
        "coalesce(price > flip_point, false) AS above_flip",
    )


def gex_flip(gex_df: DataFrame) -> DataFrame:
    """The flip point alone: one row, NULL when exposure never turns from positive."""
    return _with_flip(gex_df).agg(*measures(flip_point=FLIP_POINT))


def gex_profile(
    gex_df: DataFrame, levels_df: DataFrame | None = None, band: float = 0.08, near: float = 2.0
) -> DataFrame:
    """Strikes within `band` of the price, with a flag on those at most `near` points away.

    Without `levels_df` the price is computed beside the rows, so the events are aggregated once.
    """
    if levels_df is None:
        priced = gex_df.selectExpr("*", f"{PRICE} OVER () AS price")
    else:
        priced = gex_df.crossJoin(F.broadcast(levels_df.select("price")))
    low, high = f"price * {1 - band!r}D", f"price * {1 + band!r}D"
    return (
        priced.where(f"spx_strike BETWEEN {low} AND {high}")
        .selectExpr("*", f"abs(spx_strike - price) <= {float(near)!r}D AS near_price")
        .orderBy("spx_strike")
    )
