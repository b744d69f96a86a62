"""Casts from text with a report on what does not fit the declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T

from tapeglass.functions.mbo import PARSED_SIZES, parse_sizes
from tapeglass.functions.scalars import measures
from tapeglass.schema import FLOW_SCHEMA, KEY, SIDES

REPORT_SCHEMA = "column string, check string, n_bad bigint, sample string"
# Fixed format of timestamps in files: date, T, time, maybe a fraction, offset. Anything else, like a time alone or
# a text without offset, would be read as some instant that depends on the day or the session.
TIMESTAMP_FORMAT = "^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,9})?[+-][0-9]{2}:?[0-9]{2}$"
CAST_FIELDS = [f for f in FLOW_SCHEMA.fields if not isinstance(f.dataType, T.StringType)]


class ValidationError(ValueError):
    """Raised before anything is written when the input does not fit the schema."""


def missing_columns(df: DataFrame) -> list[str]:
    return [name for name in FLOW_SCHEMA.fieldNames() if name not in df.columns]


def schema_issues(typed: DataFrame) -> list[tuple[str, str, int, str | None]]:
    """Missing columns and wrong types; any timestamp type will do, and the type of Side is not checked."""
    issues = [(name, "missing_column", 1, None) for name in missing_columns(typed)]
    for field in FLOW_SCHEMA.fields:
        if field.name not in typed.columns or field.name == "Side":
            continue
        actual = typed.schema[field.name].dataType
        if field.name == "timestamp":
            fits = isinstance(actual, (T.TimestampType, T.TimestampNTZType))
        else:
            fits = actual == field.dataType
        if not fits:
            issues.append((field.name, "type_mismatch", 1, actual.simpleString()))
    return issues


def cast_text(value: str, field: T.StructField) -> str:
    """The text as the field's type; NULL if it cannot be read."""
    cast = f"try_cast({value} AS {field.dataType.simpleString()})"
    if isinstance(field.dataType, T.TimestampType):
        return f"CASE WHEN {value} RLIKE '{TIMESTAMP_FORMAT}' THEN {cast} END"
    return cast


def cast_beside_raw(raw: DataFrame, *keep: str) -> DataFrame:
    """The typed columns, the parsed sizes and the columns as read under `raw`: every value is cast once.

    What cannot be cast or parsed becomes NULL; the row checks count it. Sizes that are there already stay.
    """
    present = [f for f in FLOW_SCHEMA.fields if f.name in raw.columns]
    sizes = [f"{PARSED_SIZES} AS mbo_sizes"] if "MBO" in raw.columns else []
    if "mbo_sizes" in raw.columns:
        sizes = ["mbo_sizes"]
    texts = {name for name, kind in raw.dtypes if kind == "string"}

    def cast(field: T.StructField) -> str:
        typed = f"try_cast({field.name} AS {field.dataType.simpleString()})"
        return cast_text(field.name, field) if field.name in texts else typed

    return raw.selectExpr(
        *keep,
        f"struct({', '.join(f.name for f in present)}) AS raw",
        *[f"{cast(f)} AS {f.name}" for f in present],
        *sizes,
    )


BAD_SIDE = f"(Side IS NOT NULL AND Side NOT IN ({', '.join(repr(s) for s in SIDES)}))"


def row_checks(columns: list[str], with_raw: bool) -> dict[tuple[str, str], tuple[str, str]]:
    """(column, check) to (is bad, value to show), over typed rows with `mbo_sizes` and maybe `raw`."""
    checks = {}
    for field in CAST_FIELDS if with_raw else []:
        if field.name in columns:
            text = f"raw.{field.name}"
            checks[field.name, "bad_cast"] = (
                f"({text} IS NOT NULL AND {field.name} IS NULL)",
                f"CAST({text} AS STRING)",
            )
    for name in KEY:
        if name in columns:
            absent = f"raw.{name}" if with_raw else name
            checks[name, "null_key"] = (f"({absent} IS NULL)", "CAST(NULL AS STRING)")
    if "Side" in columns:
        checks["Side", "side_domain"] = (BAD_SIDE, "Side")
    if "MBO" in columns:
        checks["MBO", "bad_json"] = ("(MBO IS NOT NULL AND mbo_sizes IS NULL)", "MBO")
    return checks


def findings(columns: list[str], with_raw: bool) -> str:
    """The failed checks of a row as an array of (column, check, value); NULL for a good row.

    For rows on their way to files: good rows cost a few null tests, the array is built for bad rows only.
    Read it back from the files to filter on it, as the optimizer takes very long over a filter on this text.
    """
    checks = row_checks(columns, with_raw)
    tests = [bad for bad, _ in checks.values()]
    any_bad = f"greatest({', '.join(tests)})" if len(tests) > 1 else tests[0]
    failed = ", ".join(
        f"if({bad}, named_struct('column', '{column}', 'check', '{check}', 'value', {shown}), NULL)"
        for (column, check), (bad, shown) in checks.items()
    )
    return f"CASE WHEN {any_bad} THEN array_compact(array({failed})) END"


def summarize(rows: DataFrame, found: str) -> DataFrame:
    """Report rows (column, check, n_bad, sample) from stored findings; `sample` is the smallest bad value."""
    return (
        rows.where(f"{found} IS NOT NULL")
        .selectExpr(f"inline({found})")
        .groupBy("column", "check")
        .agg(*measures(n_bad="count(*)", sample="min(value)"))
    )


def validation_report(df: DataFrame, raw: bool = True) -> DataFrame:
    """Rows (column, check, n_bad, sample) for every check that found something; no rows means valid.

    `raw` frames hold text still to be cast; typed frames get the type check instead. All row checks share
    one pass.
    """
    found = (
        [(name, "missing_column", 1, None) for name in missing_columns(df)] if raw else schema_issues(df)
    )
    issues = df.sparkSession.createDataFrame(found, REPORT_SCHEMA)
    if not row_checks(df.columns, with_raw=raw):
        return issues
    if raw:
        rows = cast_beside_raw(df)
    else:
        rows = df.withColumn("mbo_sizes", parse_sizes()) if "MBO" in df.columns else df
    # Good rows cost null tests; bad ones give a row per failed check. The outer form keeps the optimizer from
    # copying the whole text into a filter, which it takes very long over.
    failed = rows.selectExpr(f"inline_outer({findings(df.columns, with_raw=raw)})").where("`column` IS NOT NULL")
    bad = failed.groupBy("column", "check").agg(*measures(n_bad="count(*)", sample="min(value)"))
    return issues.unionByName(bad) if found else bad


def bad_sides(df: DataFrame) -> DataFrame:
    """Every Side value outside the domain with its row count."""
    return df.where(BAD_SIDE).groupBy("Side").agg(*measures(n_bad="count(*)"))
