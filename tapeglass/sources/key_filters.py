"""Which stored files may hold a key: time range and Bloom filter of every file, as a side table.

A filter is built in the task that reads the file, without a shuffle; a file that several tasks read has a row for each.
Keys are held against the files of their date whose time range covers them, minute by minute, and then against the
filter; a file without a candidate is not opened.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tapeglass.schema import KEY

#: Sixteen bits per key and seven positions: one foreign key in some thousand passes.
BITS_PER_KEY, POSITIONS = 16, 7
SEGMENTS = "file string, date date, first long, last long, rows long, bits binary"
MINUTE_MICROS = 60_000_000


def _hashes() -> list:
    return [F.xxhash64(*KEY).alias("h1"), F.xxhash64(F.lit(7), *KEY).alias("h2")]


def _positions(one, two, bits: int):
    """Bit positions of keys in a filter of `bits` bits, a power of two; a row per position."""
    import numpy as np

    steps = np.arange(POSITIONS, dtype=np.uint64)[:, None]
    with np.errstate(over="ignore"):
        return (one.view(np.uint64) + steps * (two.view(np.uint64) | np.uint64(1))) & np.uint64(bits - 1)


def bloom(one, two) -> bytes:
    """The filter of keys with these two hashes."""
    import numpy as np

    bits = max(64, 1 << (len(one) * BITS_PER_KEY - 1).bit_length())
    held = np.zeros(bits, bool)
    held[_positions(one, two, bits).ravel()] = True
    return np.packbits(held, bitorder="little").tobytes()


def may_hold(packed: bytes, one, two):
    """Which of the keys the filter does not rule out."""
    import numpy as np

    held = np.frombuffer(packed, np.uint8)
    at = _positions(one, two, len(held) * 8)
    return ((held[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=0)


def key_rows(rows: DataFrame) -> DataFrame:
    """(file, date, first, last, rows, bits) of stored rows with `file`; times in microseconds, NULL without any."""
    narrow = rows.select("file", "date", F.unix_micros("timestamp").alias("at"), *_hashes())
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(SEGMENTS))

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        held: list = []
        now = None

        def segment():
            whole = pa.Table.from_batches(held)
            times = pc.min_max(whole.column("at")).as_py()
            one, two = (np.asarray(whole.column(h).combine_chunks()) for h in ("h1", "h2"))
            values = [*now, times["min"], times["max"], len(one), bloom(one, two)]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)

        for batch in batches:
            # A task reads one file after the other.
            files, dates = batch.column("file").to_pylist(), batch.column("date").to_pylist()
            start = 0
            for i in range(1, batch.num_rows + 1):
                if i < batch.num_rows and files[i] == files[start]:
                    continue
                if now is not None and now != (files[start], dates[start]):
                    yield segment()
                    held.clear()
                now = (files[start], dates[start])
                held.append(batch.slice(start, i - start))
                start = i
        if held:
            yield segment()

    return narrow.mapInArrow(run, SEGMENTS)


def files_with_keys(segments: DataFrame, rows: DataFrame) -> DataFrame:
    """(file) of the segments that may hold a key of `rows` (with `date`)."""
    keys = rows.select("date", F.unix_micros("timestamp").alias("at"), *_hashes()).distinct()
    # Rows without a time have no date; they are few and lie in files of their own.
    undated = keys.where("date IS NULL").select(F.lit(1).alias("one")).distinct()
    without = segments.where("date IS NULL").withColumn("one", F.lit(1)).join(undated, "one", "left_semi").select("file")
    minutes = F.sequence(F.floor(F.col("first") / MINUTE_MICROS), F.floor(F.col("last") / MINUTE_MICROS))
    spans = segments.where("date IS NOT NULL").select("file", "date", "first", "last", F.explode(minutes).alias("minute"))
    timed = keys.where("date IS NOT NULL").withColumn("minute", F.floor(F.col("at") / MINUTE_MICROS))
    covered = timed.join(spans, ["date", "minute"]).where("at BETWEEN first AND last")
    asked = covered.select("file", "h1", "h2", F.lit(None).cast("binary").alias("bits"))
    wanted = asked.select("file").distinct()
    filters = segments.join(wanted, "file", "left_semi").select("file", F.lit(0).cast("long").alias("h1"), F.lit(0).cast("long").alias("h2"), "bits")
    # A file's filters come first, then the keys that its times cover, however many.
    stream = filters.unionByName(asked).repartition("file").sortWithinPartitions("file", F.col("bits").isNull())

    def run(batches):
        import numpy as np
        import pyarrow as pa

        now, held, done = None, [], False
        for batch in batches:
            files, bits = batch.column("file").to_pylist(), batch.column("bits")
            one, two = (np.asarray(batch.column(h)) for h in ("h1", "h2"))
            found, start = [], 0
            for i, file in enumerate(files):
                if file != now:
                    now, held, done = file, [], False
                if bits[i].is_valid:
                    held.append(bits[i].as_py())
                if not bits[i].is_valid and (i == 0 or files[i - 1] != file or bits[i - 1].is_valid):
                    start = i
                last = i + 1 == len(files) or files[i + 1] != file
                if last and not bits[i].is_valid and not done:
                    done = any(may_hold(own, one[start : i + 1], two[start : i + 1]).any() for own in held)
                    found += [file] * done
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["file"])

    return stream.mapInArrow(run, "file string").unionByName(without).distinct()
