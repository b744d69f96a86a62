"""Document fingerprints as quartile bucket digests, and their comparison.

Byte triplets of a sliding window of ten bytes are hashed into BUCKETS counters. Their bytes stand apart: neighbouring
bytes tell the language of a text more than the text. The digest holds the logarithm of
the byte length and, two bits a bucket, the quartile of the bucket's count among all counts of the document. Two
digests differ by the sum of their quartile steps, an opposite pair counting double, plus a bounded length term.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tapeglass.llm.common import range_limits, range_of, ranges

BUCKETS = 256
# Offsets of the second and third byte of each triplet.
TRIPLETS = ((2, 5), (3, 7), (4, 9))
STEP_COST = np.array([0, 1, 2, 6])
LENGTH_STEPS = 8  # to a doubling of the length
LENGTH_COST = 32
WORST = 6 * BUCKETS + LENGTH_COST


def digest(data: bytes) -> bytes:
    """Length byte and bucket quartiles; texts of under six bytes have the quartiles of no triplets."""
    raw = np.frombuffer(data, np.uint8).astype(np.uint32)
    counts = np.zeros(BUCKETS, np.int64)
    for kind, (b, c) in enumerate(TRIPLETS):
        if len(raw) > c:
            mixed = raw[:-c] | (raw[b : len(raw) - c + b] << 8) | (raw[c:] << 16) | np.uint32(kind << 24)
            # Multiplication carries into the top eight bits; the shift brings the high bytes down first.
            mixed ^= mixed >> 13
            counts += np.bincount((mixed * np.uint32(0x9E3779B1)) >> 24, minlength=BUCKETS)
    ranked = np.sort(counts)
    limits = ranked[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    quartiles = (counts[:, None] > limits).sum(axis=1).astype(np.uint8).reshape(-1, 4)
    packed = quartiles[:, 0] | quartiles[:, 1] << 2 | quartiles[:, 2] << 4 | quartiles[:, 3] << 6
    length = min(255, int(LENGTH_STEPS * np.log2(len(data) + 1)))
    return bytes([length]) + packed.tobytes()


_PAIRS = np.arange(256)
_STEPS = [(_PAIRS >> s) & 3 for s in (0, 2, 4, 6)]
#: Cost of two packed bytes.
BYTE_COST = sum(STEP_COST[np.abs(q[:, None] - q[None, :])] for q in _STEPS)


def difference(a: bytes, b: bytes) -> int:
    """0 to WORST."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    return int(BYTE_COST[x[1:], y[1:]].sum()) + min(LENGTH_COST, abs(int(x[0]) - int(y[0])))


def likeness(a: bytes, b: bytes) -> float:
    """1 for equal digests, 0 for the greatest difference."""
    return 1.0 - difference(a, b) / WORST


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint hex) of every whole text; NULL counts as empty, equal texts have equal fingerprints."""

    def run(frames):
        for frame in frames:
            frame["fingerprint"] = [digest((t or "").encode()).hex() for t in frame.pop("_text")]
            yield frame

    kind = dict(docs.dtypes)[key]
    return docs.select(F.col(key), F.col(text).alias("_text")).mapInPandas(run, f"`{key}` {kind}, fingerprint string")


def edited_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", range_rows: int = 2048) -> DataFrame:
    """Fingerprints of every text and of the text whose last quarter is replaced with the next document's beginning.

    Documents are taken in ascending order of key, equal keys by text, NULL keys first and NULL texts as empty; the
    last one is followed by the first, so a single document follows itself. Ranges of keys go to one task each,
    together with the first document of the next range, found in the keys alone. An empty table gives no rows.
    Columns: key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    limits = range_limits(rows, "key", ranges(rows.count(), range_rows))

    def ranged(df: DataFrame) -> DataFrame:
        return df.withColumn("part", range_of(F.col("key"), limits).cast("int"))

    # First key of each range, at most one row a range, and the range whose last document it follows.
    firsts = (
        ranged(rows.select("key"))
        .groupBy("part")
        .agg(F.min("key").alias("head"), F.bool_or(F.col("key").isNull()).alias("with_null"))
        .orderBy("part")
        .collect()
    )
    heads = docs.sparkSession.createDataFrame(
        [(f["part"], None if f["with_null"] else f["head"], firsts[i - 1]["part"]) for i, f in enumerate(firsts)],
        "head_part int, head long, before int",
    )
    follows = (F.col("part") == F.col("head_part")) & F.col("key").eqNullSafe(F.col("head"))
    places = F.array(F.struct("part", F.lit(False).alias("guest")))
    also = F.array(F.struct(F.col("before").alias("part"), F.lit(True).alias("guest")))
    together = (
        ranged(rows)
        .join(F.broadcast(heads), follows, "left")
        .select("key", "text", F.explode(F.when(F.col("before").isNull(), places).otherwise(F.concat(places, also))).alias("at"))
        .select("at.part", "at.guest", "key", "text")
    )
    ordered = together.repartitionById(len(limits) + 1, "part").sortWithinPartitions("part", "guest", "key", "text")

    def compare(batches):
        import pyarrow as pa

        def pairs():
            part, last, done = None, None, True
            for batch in batches:
                columns = [batch.column(c).to_pylist() for c in ("part", "key", "text", "guest")]
                for own, doc, body, guest in zip(*columns):
                    if own != part:
                        part, last, done = own, None, False
                    if done:
                        continue  # a second first document with the same key
                    this = (doc, body, digest(body.encode()))
                    if last:
                        yield last, this
                    last, done = this, guest

        def row(now, following):
            doc, body, own = now
            _, other, next_print = following
            tail = len(body) // 4
            edited = (body[: len(body) - tail] + other[:tail]).encode()
            edited_print = digest(edited)
            return {
                "doc_id": doc, "n_chars": len(body), "edited_sha256": hashlib.sha256(edited).hexdigest(),
                "fingerprint": own.hex(), "edited_fingerprint": edited_print.hex(),
                "near_edited": likeness(own, edited_print), "near_next": likeness(own, next_print),
            }

        schema = pa.schema([
            ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
            ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
            ("near_edited", pa.float64()), ("near_next", pa.float64()),
        ])
        held = []
        for now, following in pairs():
            held.append(row(now, following))
            if len(held) == 1000:
                yield pa.RecordBatch.from_pylist(held, schema=schema)
                held = []
        yield pa.RecordBatch.from_pylist(held, schema=schema)

    return ordered.mapInArrow(
        compare,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    ).withColumnRenamed("doc_id", key)
