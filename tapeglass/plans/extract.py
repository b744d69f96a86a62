"""Filtered extract of events to files."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tapeglass.functions.time import FILE_TIMES
from tapeglass.operators.filters import FlowFilter
from tapeglass.operators.signals import pulling_stacking

FORMATS = ["json", "csv"]


def extract(flow: DataFrame, f: FlowFilter | None = None, limit: int | None = None) -> DataFrame:
    """All events that pass every filter, as time, price and pulling/stacking mark; with a limit the earliest."""
    return pulling_stacking(flow, f, limit)


def write_extract(
    flow: DataFrame,
    path: str,
    f: FlowFilter | None = None,
    limit: int | None = None,
    fmt: str = "json",
) -> None:
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}")
    writer = extract(flow, f, limit).write.mode("overwrite").options(**FILE_TIMES)
    if fmt == "json":
        writer.option("ignoreNullFields", "false").json(path)
    else:
        writer.option("header", True).csv(path)
