"""Pearson correlation of the 16 greeks, as a long frame and as a matrix."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import DataFrame, functions as F

from tapeglass.functions.scalars import measures
from tapeglass.operators.filters import FlowFilter, apply_filters
from tapeglass.operators.sampling import exact_sample
from tapeglass.schema import GREEKS, KEY

# Bands on the absolute correlation, strongest first, and the name below the last bound.
STRENGTH_BANDS = [(0.9, "near-perfect"), (0.7, "strong"), (0.5, "moderate"), (0.3, "weak")]
STRENGTH_REST = "near-zero"
DRILL_BANDS = [(0.85, "very strong"), (0.6, "moderate-to-strong"), (0.3, "weak")]
DRILL_REST = "near-zero"

GREEK_ARRAY = "array(" + ", ".join(f"'{g}'" for g in GREEKS) + ")"


def _place(name: str) -> str:
    return f"array_position({GREEK_ARRAY}, {name})"


PAIRS = list(combinations_with_replacement(range(len(GREEKS)), 2))


def _centred(events: DataFrame) -> DataFrame:
    """The greeks as doubles less their mean; NULL and non-finite values count as 0.

    The means are one broadcast row. A constant column is centred on its value, so that it becomes exactly 0.
    """
    finite = "CASE WHEN abs({0}) < double('inf') THEN CAST({0} AS DOUBLE) ELSE 0D END AS {0}"
    greeks = events.selectExpr(*[finite.format(g) for g in GREEKS])
    centre = "CASE WHEN min({0}) = max({0}) THEN min({0}) ELSE avg({0}) END"
    centres = greeks.agg(*measures(**{f"at_{g}": centre.format(g) for g in GREEKS}))
    return greeks.crossJoin(F.broadcast(centres)).selectExpr(*[f"{g} - at_{g} AS {g}" for g in GREEKS])


def _products(events: DataFrame) -> DataFrame:
    """One row per pair of greeks (i <= j): `cell` = 16 i + j and the sum of products of the centred values.

    Generated code handles up to 100 columns, fewer than the 136 sums. Each event is therefore taken twice,
    once for either half of the pairs, which is still several times faster than one wide aggregation.
    """
    width, half = len(GREEKS), len(PAIRS) // 2
    columns = {}
    for k, (one, two) in enumerate(zip(PAIRS[:half], PAIRS[half:])):
        left, right = (f"if(half, {GREEKS[a]}, {GREEKS[b]})" for a, b in zip(one, two))
        columns[f"s{k}"] = f"sum({left} * {right})"
    halves = (
        _centred(events)
        .selectExpr("explode(array(true, false)) AS half", *GREEKS)
        .groupBy("half")
        .agg(*measures(**columns))
    )
    cells = ", ".join(
        f"struct(if(half, {a * width + b}, {c * width + d}) AS cell, s{k} AS total)"
        for k, ((a, b), (c, d)) in enumerate(zip(PAIRS[:half], PAIRS[half:]))
    )
    return halves.selectExpr(f"inline(array({cells}))")


def correlation(
    flow: DataFrame,
    f: FlowFilter | None = None,
    sample: float | None = None,
    seed: int = 42,
    rows: int | None = None,
) -> DataFrame:
    """256 rows (greek_i, greek_j, r), rounded to four places; no rows for empty input.

    NULL and non-finite values count as 0, the diagonal is 1 and a pair with a constant column is 0. The
    whole table counts; `rows` asks for a sample of exactly so many rows, `sample` for a seeded fraction instead.
    """
    events = apply_filters(flow, f)
    if rows is not None:
        events = exact_sample(events.select(*KEY, *GREEKS), rows, KEY, seed)
    if sample is not None:
        events = events.sample(fraction=sample, seed=seed)
    # At most 136 entries, one per pair.
    return correlation_cells(_products(events).selectExpr("map_from_entries(collect_list(struct(cell, total))) AS s"))


def correlation_cells(totals: DataFrame) -> DataFrame:
    """The 256 rows from one row with a map `s` of pair (16 i + j, i <= j) to its sum of centred products."""
    width = len(GREEKS)
    row, across = f"k div {width}", f"k % {width}"
    product = f"s[int(least({row}, {across}) * {width} + greatest({row}, {across}))]"
    deviations = " * ".join(f"sqrt(s[int(({at}) * {width + 1})])" for at in (row, across))
    r = f"coalesce(round(try_divide({product}, {deviations}), 4), 0D)"
    cell = (
        f"named_struct('greek_i', {GREEK_ARRAY}[int({row})], 'greek_j', {GREEK_ARRAY}[int({across})],"
        f" 'r', CASE WHEN {row} = {across} THEN 1D ELSE {r} END)"
    )
    return totals.where("size(s) > 0").selectExpr(
        f"inline(transform(sequence(0, {width * width - 1}), k -> {cell}))"
    )


def correlation_matrix(long_df: DataFrame, lower_only: bool = False) -> DataFrame:
    """One row per greek with one column per greek; `lower_only` blanks the cells right of the diagonal."""
    if lower_only:
        long_df = long_df.where(f"{_place('greek_j')} <= {_place('greek_i')}")
    wide = measures(**{g: f"max(CASE WHEN greek_j = '{g}' THEN r END)" for g in GREEKS})
    return long_df.groupBy("greek_i").agg(*wide).orderBy(F.expr(_place("greek_i")))


def matrix_record(long_df: DataFrame) -> DataFrame:
    """The whole matrix as one record {columns, matrix}; an empty input gives an empty matrix."""
    cell = f"struct({_place('greek_i')} AS i, {_place('greek_j')} AS j, r)"
    width = len(GREEKS)
    rows = (
        f"transform(sequence(1, size(cells), {width}),"
        f" start -> transform(slice(cells, start, {width}), c -> c.r))"
    )
    return long_df.selectExpr(f"array_sort(collect_list({cell})) AS cells").selectExpr(
        f"{GREEK_ARRAY} AS columns",
        f"CASE WHEN size(cells) > 0 THEN {rows} ELSE CAST(array() AS ARRAY<ARRAY<DOUBLE>>) END AS matrix",
    )


def _band(bands: list[tuple[float, str]], rest: str) -> str:
    steps = " ".join(f"WHEN abs(r) > {bound}D THEN '{name}'" for bound, name in bands)
    return f"CASE {steps} ELSE '{rest}' END"


def label_correlation(long_df: DataFrame) -> DataFrame:
    """Add leg and greek of both columns, and the strength and direction bands of r."""
    leg = "CASE WHEN startswith({0}, 'call_') THEN 'C' ELSE 'P' END"
    greek = "split_part({0}, '_', 2)"
    return long_df.selectExpr(
        "greek_i",
        "greek_j",
        "r",
        f"{leg.format('greek_i')} AS leg_i",
        f"{greek.format('greek_i')} AS name_i",
        f"{leg.format('greek_j')} AS leg_j",
        f"{greek.format('greek_j')} AS name_j",
        f"{greek.format('greek_i')} = {greek.format('greek_j')} AS same_greek",
        f"{leg.format('greek_i')} <> {leg.format('greek_j')} AS cross_leg",
        f"{_band(STRENGTH_BANDS, STRENGTH_REST)} AS strength",
        "CASE WHEN r > 0 THEN 'positive' ELSE 'negative' END AS direction",
        f"{_band(DRILL_BANDS, DRILL_REST)} AS drill_band",
        "CASE WHEN r < 0 THEN 'opposite' ELSE 'together' END AS drill_direction",
    )
