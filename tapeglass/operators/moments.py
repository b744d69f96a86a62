"""Correlation from mergeable moments: counts, means and co-moments of the greeks, updated pairwise.

One scan: an Arrow batch gives its mean and its centred products in one matrix product, and two sets of moments merge with
a term for the distance of their means, which stays exact where sums of squares would cancel. Moments of files, dates or
tasks merge in any grouping, so stored ones answer any range of dates without reading events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tapeglass.functions.time import in_session
from tapeglass.operators.correlation import PAIRS, correlation_cells
from tapeglass.schema import GREEKS

MOMENTS = "n long, means array<double>, products array<double>, lows array<double>, highs array<double>"


class _Moments:
    """Moments of one group; `products` is the whole symmetric matrix."""

    def __init__(self, n, means, products, lows, highs):
        self.n, self.means, self.products, self.lows, self.highs = n, means, products, lows, highs

    @classmethod
    def of(cls, values):
        means = values.mean(axis=0)
        centred = values - means
        return cls(len(values), means, centred.T @ centred, values.min(axis=0), values.max(axis=0))

    @classmethod
    def from_row(cls, n, means, products, lows, highs):
        import numpy as np

        matrix = np.zeros((len(GREEKS), len(GREEKS)))
        for (i, j), total in zip(PAIRS, products):
            matrix[i, j] = matrix[j, i] = total
        return cls(n, np.array(means), matrix, np.array(lows), np.array(highs))

    def merged(self, other):
        import numpy as np

        n, apart = self.n + other.n, other.means - self.means
        products = self.products + other.products + np.outer(apart, apart) * (self.n * other.n / n)
        means = self.means + apart * (other.n / n)
        return _Moments(n, means, products, np.minimum(self.lows, other.lows), np.maximum(self.highs, other.highs))

    def row(self) -> tuple:
        products = [float(self.products[i, j]) for i, j in PAIRS]
        return self.n, self.means.tolist(), products, self.lows.tolist(), self.highs.tolist()


def _emitted(held: dict, schema):
    import pyarrow as pa

    rows = [(*key, *moments.row()) for key, moments in held.items()]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _schema(df: DataFrame, by: list[str]) -> str:
    kinds = dict(df.dtypes)
    return ", ".join([*[f"`{c}` {kinds[c]}" for c in by], MOMENTS])


def _arrow(ddl: str):
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def moments(rows: DataFrame, by: list[str]) -> DataFrame:
    """Moments of the greeks by the columns `by`, a row per group and task; merge them with `merged_moments`.

    NULL and non-finite values count as 0. The groups of one task must fit in its memory.
    """
    ddl = _schema(rows, by)
    schema = _arrow(ddl)
    finite = "CASE WHEN abs({0}) < double('inf') THEN CAST({0} AS DOUBLE) ELSE 0D END AS {0}"
    narrow = rows.selectExpr(*[f"`{c}`" for c in by], *[finite.format(g) for g in GREEKS])

    def run(batches):
        import numpy as np

        held: dict = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            values = np.column_stack([batch.column(len(by) + i).to_numpy() for i in range(len(GREEKS))])
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(len(by))))) if by else [()] * batch.num_rows
            places: dict = {}
            for place, key in enumerate(keys):
                places.setdefault(key, []).append(place)
            for key, at in places.items():
                own = _Moments.of(values if len(at) == len(values) else values[at])
                held[key] = held[key].merged(own) if key in held else own
        yield from _emitted(held, schema)

    return narrow.mapInArrow(run, ddl)


def merged_moments(parts: DataFrame, by: list[str]) -> DataFrame:
    """One row per group from any number of rows: each task merges what it reads, then one task per group the rest."""
    ddl = _schema(parts, by)
    schema = _arrow(ddl)

    def run(batches):
        held: dict = {}
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                key, own = row[: len(by)], _Moments.from_row(*row[len(by) :])
                held[key] = held[key].merged(own) if key in held else own
        yield from _emitted(held, schema)

    columns = [*by, "n", "means", "products", "lows", "highs"]
    folded = parts.select(columns).mapInArrow(run, ddl)
    dealt = folded.repartition(*by) if by else folded.repartition(1)
    return dealt.mapInArrow(run, ddl)


def moment_rows(rows: DataFrame) -> DataFrame:
    """Moments of stored rows (with `wall_time` and `file`) by file, date and session."""
    session = F.coalesce(in_session("wall_time"), F.lit(False))
    return moments(rows.withColumn("in_session", session), ["file", "date", "in_session"])


def correlation_from_moments(parts: DataFrame) -> DataFrame:
    """As `correlation`, from moments of the rows that count; no rows without any."""
    whole = merged_moments(parts, [])
    # A constant column has no deviation, whatever is left of rounding.
    constant = [f"lows[{i}] = highs[{i}]" for i in range(len(GREEKS))]
    width = len(GREEKS)
    entries = ", ".join(
        f"struct({i * width + j} AS cell, CASE WHEN {constant[i]} OR {constant[j]} THEN 0D ELSE products[{k}] END AS total)"
        for k, (i, j) in enumerate(PAIRS)
    )
    return correlation_cells(whole.selectExpr(f"map_from_entries(array({entries})) AS s"))
