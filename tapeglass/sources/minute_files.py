"""Minute files: a gzip of a gzip of one JSON array of records, maybe wrapped in CSV quotes.

Spark has no expression for a gzip inside a gzip, so a file is unpacked in a Python task, and its values get their types
there too: the array is cut into frames of some thousand records, and each frame becomes one Arrow batch whose columns
are converted at once. A file is held as its text and the typed columns of the frames so far, never as many copies.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tapeglass.operators.validation import TIMESTAMP_FORMAT
from tapeglass.schema import FLOW_COLUMNS, FLOW_SCHEMA

# A file above either limit is set aside: it is unpacked and parsed in one task.
MAX_PACKED_BYTES = 128 << 20
MAX_UNPACKED_BYTES = 1 << 30
FRAME_RECORDS = 4096

DECODED_SCHEMA = T.StructType(
    [
        *FLOW_SCHEMA.fields,
        T.StructField("mbo_sizes", T.ArrayType(T.DoubleType())),
        T.StructField("_file", T.StringType()),
        T.StructField("_block", T.LongType()),
        T.StructField("_row", T.LongType()),
        T.StructField("_error", T.StringType()),
    ]
)

SPACES = " \t\r\n"
_SPACES = re.compile(f"[{SPACES}]*")
_TIMESTAMP = re.compile(TIMESTAMP_FORMAT)
_NUMBER = re.compile(r"[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?|[+-]?(NaN|Infinity)")
# Stands for a value that does not fit its column.
_WRONG = object()


class Refused(ValueError):
    """Why a file is set aside as a whole."""


def _text_of(content: bytes) -> str:
    """The JSON array of a file, without white space around it and without CSV quotes."""
    import gzip
    import io

    if len(content) > MAX_PACKED_BYTES:
        raise ValueError(f"more than {MAX_PACKED_BYTES} bytes")
    unpacked = gzip.GzipFile(fileobj=gzip.GzipFile(fileobj=io.BytesIO(content))).read(MAX_UNPACKED_BYTES + 1)
    if len(unpacked) > MAX_UNPACKED_BYTES:
        raise ValueError(f"more than {MAX_UNPACKED_BYTES} bytes unpacked")
    body = unpacked.decode("utf-8").strip(SPACES)
    return body[1:-1].replace('\\"', '"') if len(body) > 1 and body[0] == body[-1] == '"' else body


def _frames(body: str, size: int):
    """The records of a JSON array, `size` at a time."""
    refusal = Refused("not a JSON array of records")
    read = json.JSONDecoder().raw_decode
    if body[:1] != "[":
        raise refusal
    at, frame = _SPACES.match(body, 1).end(), []
    more = body[at : at + 1] != "]"
    while more:
        try:
            record, at = read(body, at)
        except (ValueError, RecursionError):
            raise refusal from None
        if not isinstance(record, dict):
            raise refusal
        frame.append(record)
        if len(frame) == size:
            yield frame
            frame = []
        at = _SPACES.match(body, at).end()
        more = body[at : at + 1] == ","
        if more:
            at = _SPACES.match(body, at + 1).end()
    if body[at : at + 1] != "]" or body[at + 1 :].strip(SPACES):
        raise refusal
    if frame:
        yield frame


def _plain_number(value):
    """A JSON number, or the number that a text holds; anything else is wrong."""
    if isinstance(value, str):
        text = value.strip()
        return float(text) if _NUMBER.fullmatch(text) else _WRONG
    return value if isinstance(value, (int, float)) and not isinstance(value, bool) else _WRONG


def _plain_sizes(value):
    """The sizes of one MBO value: a list of numbers, or the text of one."""
    if isinstance(value, str):
        try:
            value = json.loads(value)
        except ValueError:
            return _WRONG
    if not isinstance(value, list):
        return _WRONG
    made = [None if size is None else _plain_number(size) for size in value]
    return _WRONG if any(size is _WRONG for size in made) else [None if s is None else float(s) for s in made]


def _first_wrong(values: list) -> int | None:
    return next((i for i, value in enumerate(values) if value is _WRONG), None)


def _numbers(values: tuple, field: T.StructField):
    """(Arrow column, place of the first value that does not fit) of numbers; 1 and 1.0 both stand for an integer."""
    import numpy as np
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(field.dataType)
    if not set(map(type, values)) <= {float, int, type(None)}:
        values = [None if v is None else _plain_number(v) for v in values]
        if (wrong := _first_wrong(values)) is not None:
            return None, wrong
    absent = np.array([v is None for v in values])
    made = np.array([0.0 if v is None else v for v in values], dtype=np.float64)
    if isinstance(field.dataType, T.IntegralType):
        limits = np.iinfo(kind.to_pandas_dtype())
        cut = np.trunc(made)
        unfit = ~((cut >= limits.min) & (cut <= limits.max))
        if unfit.any():
            return None, int(np.argmax(unfit))
        return pa.array(cut.astype(kind.to_pandas_dtype()), kind, mask=absent), None
    with np.errstate(over="ignore"):
        return pa.array(made.astype(kind.to_pandas_dtype()), kind, mask=absent), None


def _instants(values: tuple):
    """As `_numbers`, of texts of one fixed format; places beyond microseconds are cut."""
    import numpy as np
    import pyarrow as pa

    kind = pa.timestamp("us", tz="UTC")
    fits = _TIMESTAMP.match
    for i, value in enumerate(values):
        if value is not None and not (isinstance(value, str) and fits(value)):
            return None, i
    absent = np.array([v is None for v in values])
    # The offset ends the text: +hh:mm or +hhmm.
    local, minutes = [], []
    for value in values:
        if value is None:
            local.append("1970-01-01T00:00:00")
            minutes.append(0)
            continue
        cut = max(value.rfind("+"), value.rfind("-"))
        hours, rest = int(value[cut + 1 : cut + 3]), int(value[-2:])
        minutes.append((hours * 60 + rest) * (-1 if value[cut] == "-" else 1) if rest < 60 and hours * 60 + rest <= 18 * 60 else 10_000)
        local.append(value[: min(cut, 26)])
    offset = np.array(minutes)
    if (offset == 10_000).any():
        return None, int(np.argmax(offset == 10_000))
    try:
        made = np.array(local, dtype="datetime64[us]")
    except ValueError:
        return None, next(i for i, text in enumerate(local) if not _is_instant(text))
    return pa.array(made - offset.astype("timedelta64[m]"), pa.timestamp("us"), mask=absent).cast(kind), None


def _is_instant(text: str) -> bool:
    import numpy as np

    try:
        np.datetime64(text, "us")
    except ValueError:
        return False
    return True


def _texts(values: tuple):
    import pyarrow as pa

    if not set(map(type, values)) <= {str, type(None)}:
        values = [v if v is None or isinstance(v, str) else json.dumps(v, separators=(",", ":")) for v in values]
    return pa.array(values, pa.string()), None


def _typed(frame: list[dict]):
    """(Arrow columns of a frame, (record, column place, column) of the first value that does not fit, absent columns)."""
    import operator

    import pyarrow as pa

    try:
        columns = list(zip(*map(operator.itemgetter(*FLOW_COLUMNS), frame)))
    except KeyError:
        absent = [name for record in frame for name in FLOW_COLUMNS if name not in record]
        return None, None, absent
    made, wrongs = [], []
    for place, (field, values) in enumerate(zip(FLOW_SCHEMA.fields, columns)):
        if field.name == "MBO":
            sizes = [[] if v is None else _plain_sizes(v) for v in values]
            wrong = _first_wrong(sizes)
            column = pa.array(["[]" if v is None else v if isinstance(v, str) else json.dumps(v, separators=(",", ":")) for v in values])
        elif isinstance(field.dataType, T.TimestampType):
            column, wrong = _instants(values)
        elif isinstance(field.dataType, T.StringType):
            column, wrong = _texts(values)
        else:
            column, wrong = _numbers(values, field)
        made.append(column)
        if wrong is not None:
            wrongs.append((wrong, place, field.name))
    if wrongs:
        return None, min(wrongs), []
    return [*made, pa.array(sizes, pa.list_(pa.float64()))], None, []


def _decoded(path: str, content: bytes, schema):
    """Arrow batches of one file, or one row with the reason why it is refused."""
    import numpy as np
    import pyarrow as pa

    frames, absent, unreadable = [], {}, None
    try:
        for frame in _frames(_text_of(content), FRAME_RECORDS):
            columns, wrong, missing = _typed(frame)
            absent |= dict.fromkeys(missing)
            unreadable = unreadable or wrong
            frames.append(columns)
        if absent:
            raise Refused(f"missing columns: {', '.join(absent)}")
        if unreadable:
            raise Refused(f"unreadable {unreadable[2]}")
    except Exception as failure:
        error = str(failure) if isinstance(failure, Refused) else f"{type(failure).__name__}: {failure}"
        values = {"_file": path, "_block": 0, "_row": 0, "_error": error}
        yield pa.RecordBatch.from_arrays([pa.array([values.get(f.name)], f.type) for f in schema], schema=schema)
        return
    first = 0
    for columns in frames:
        rows = len(columns[0])
        where = [pa.array([path] * rows), pa.array(np.zeros(rows, np.int64)), pa.array(np.arange(first, first + rows)), pa.nulls(rows, pa.string())]
        yield pa.RecordBatch.from_arrays([*columns, *where], schema=schema)
        first += rows


def decode_minute_files(files: DataFrame) -> DataFrame:
    """Typed rows of the files (path, content), with parsed sizes and input order; a refused file gives one row.

    A file is refused as a whole, with the reason in `_error`, when it cannot be unpacked or is too large, is no
    JSON array of records, has a record without one of the columns, or holds a value that does not fit its column.
    Numbers may be quoted. Files are independent: each is one unit of work of about one minute of events, and
    nothing is shuffled.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(DECODED_SCHEMA)

    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                yield from _decoded(path.as_py(), content.as_py(), schema)

    return files.select("path", "content").mapInArrow(run, DECODED_SCHEMA)


def scan_minute_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Batch scan of minute files."""
    paths = [paths] if isinstance(paths, str) else paths
    return decode_minute_files(spark.read.format("binaryFile").load(paths))


def quarantined(rows: DataFrame) -> DataFrame:
    """One row (path, error) per refused file."""
    return rows.where(F.col("_error").isNotNull()).select(
        F.col("_file").alias("path"), F.col("_error").alias("error")
    )
