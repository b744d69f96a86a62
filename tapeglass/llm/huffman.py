"""Token ids as canonical, length-limited Huffman code in independent blocks.

A written folder holds
  code/    one row: `ids` and `lengths`, parallel arrays that fix the canonical code, and the longest length `bits`;
  blocks/  rows (part, block, start, doc_ids, doc_tokens, checkpoints, bits). `part` numbers ranges of ascending
           doc_id; the blocks of a part follow each other and `start` counts the part's ids before the block. Every
           document begins at a byte of `bits`. `checkpoints` are the bit offsets (unsigned 64 bit, little-endian)
           of every SEGMENT-th id of each document, its first included: what lies between two of them decodes alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tapeglass.llm.common import range_limits, ranges, staged
from tapeglass.llm.tokens import encoded_batches, narrow

MAX_BITS = 20
SEGMENT = 256
BLOCK_IDS = 1 << 18
PART_IDS = 1 << 23
BLOCKS = (
    "part int, block int, start long, doc_ids array<long>, doc_tokens array<long>, checkpoints binary, bits binary"
)


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Code lengths, at most `limit`, of least total size for ascending counts (package-merge)."""
    n = len(counts)
    if n > 1 << limit:
        raise ValueError(f"{n} ids do not fit codes of {limit} bits")
    if n < 2:
        return np.ones(n, np.int64)
    base = np.asarray(counts, np.int64)
    level, packed = base, [np.zeros(n, bool)]
    for _ in range(limit - 1):
        pairs = level[: len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        values = np.concatenate([base, pairs])
        order = np.argsort(values, kind="stable")
        level = values[order]
        packed.append(order >= n)
    lengths, wanted = np.zeros(n, np.int64), 2 * n - 2
    for is_pair in reversed(packed):
        pairs = int(is_pair[:wanted].sum())
        lengths[: wanted - pairs] += 1
        wanted = 2 * pairs
    return lengths


class Code:
    """The canonical code of parallel ids and lengths: shorter codes first, then smaller ids."""

    def __init__(self, ids, lengths):
        ids, lengths = np.asarray(ids, np.int64), np.asarray(lengths, np.int64)
        order = np.lexsort((ids, lengths))
        self.ids, self.lengths = ids[order], lengths[order]
        self.bits = int(self.lengths.max(initial=1))
        spans = 1 << (self.bits - self.lengths)
        firsts = np.cumsum(spans) - spans  # of each code in the table of all bit strings of the longest length
        size = int(self.ids.max(initial=0)) + 1
        self.code_of, self.length_of = np.zeros(size, np.uint64), np.zeros(size, np.int64)
        self.code_of[self.ids] = firsts >> (self.bits - self.lengths)
        self.length_of[self.ids] = self.lengths
        self._spans = spans

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Id and length by the next `bits` bits."""
        symbols = np.zeros(1 << self.bits, np.uint32)
        lengths = np.ones(1 << self.bits, np.uint8)
        filled = int(self._spans.sum())
        symbols[:filled] = np.repeat(self.ids, self._spans)
        lengths[:filled] = np.repeat(self.lengths, self._spans)
        return symbols, lengths

    def encode(self, ids: np.ndarray, docs: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
        """Coded ids of documents of the given numbers of ids, each from a byte on.

        Returns the bytes, the byte at which each document begins (and the end), and the bit offset of every id.
        """
        sizes = self.length_of[ids]
        ends = np.cumsum(sizes)
        last = np.cumsum(docs)
        total = np.where(docs > 0, ends[np.maximum(last, 1) - 1], 0) if len(ids) else np.zeros(len(docs), np.int64)
        total = np.maximum.accumulate(total)
        own = np.diff(total, prepend=0)
        begins = np.concatenate([[0], np.cumsum((own + 7) // 8)])
        offsets = ends - sizes + np.repeat(begins[:-1] * 8 - (total - own), docs)
        words = np.zeros(int(begins[-1]) // 4 + 3)
        if len(ids):
            word = offsets >> 5
            value = self.code_of[ids] << (64 - sizes - (offsets & 31)).astype(np.uint64)
            # Codes share no bit, so sums below 2**32 are exact in doubles.
            words += np.bincount(word, (value >> np.uint64(32)).astype(float), len(words))
            words += np.bincount(word + 1, (value & np.uint64(0xFFFFFFFF)).astype(float), len(words))
        return words.astype(">u4").tobytes()[: int(begins[-1])], begins, offsets


def decode_segments(bits: bytes, offsets: np.ndarray, sizes: np.ndarray, tables) -> np.ndarray:
    """The ids of segments that begin at bit offsets, all segments step by step side by side."""
    symbols, lengths = tables
    width = np.uint32(32 - (len(symbols).bit_length() - 1))
    raw = np.frombuffer(bits + b"\0\0\0\0", np.uint8).astype(np.uint32)
    window = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
    out = np.empty(int(sizes.sum()), np.uint32)
    begins = np.cumsum(sizes) - sizes
    order = np.argsort(-sizes, kind="stable")
    at, to, left = offsets[order].astype(np.int64), begins[order], -sizes[order]
    for step in range(int(sizes.max(initial=0))):
        live = int(np.searchsorted(left, -step, "left"))
        now = at[:live]
        seen = (window[now >> 3] << (now & 7).astype(np.uint32)) >> width
        out[to[:live] + step] = symbols[seen]
        at[:live] += lengths[seen]
    return out


def encode_texts(docs: DataFrame, tokenizer: str, spaces: str, end_id: int, key="doc_id", text="text") -> DataFrame:
    """(doc_id, ids binary, width, counts): ids of the whole text (NULL: empty) and `end_id`, `width` bytes each.

    The last row of every task holds no document, but in `counts` how often each id stands in the task's documents.
    """

    def run(batches):
        import pyarrow as pa

        schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("width", pa.int32()), ("counts", pa.binary())])
        total = np.zeros(0, np.int64)
        for keys, ids, own in encoded_batches(batches, tokenizer, spaces, end_id):
            total = _counted(total, np.frombuffer(b"".join(ids), own.dtype))
            columns = [keys, ids, [own.dtype.itemsize] * len(ids), [None] * len(ids)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
        yield pa.RecordBatch.from_pylist([{"counts": total.astype("<i8").tobytes()}], schema=schema)

    return narrow(docs, key, text).mapInArrow(run, "doc_id long, ids binary, width int, counts binary")


def _counted(total: np.ndarray, ids: np.ndarray) -> np.ndarray:
    seen = np.bincount(ids, minlength=len(total))
    seen[: len(total)] += total
    return seen


def _arrays(batch) -> Iterator[np.ndarray]:
    for ids, width in zip(batch.column("ids"), batch.column("width").to_pylist()):
        yield np.frombuffer(ids.as_buffer(), f"<u{width}")


def id_counts(coded: DataFrame) -> DataFrame:
    """(id, n) over all documents, added up in every task first; from the tasks' own counts where there are any."""
    told = "counts" in coded.columns

    def run(batches):
        import pyarrow as pa

        total = np.zeros(0, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                few = batch.slice(at, 256)
                if told:
                    for counts in few.column("counts"):
                        own = np.frombuffer(counts.as_buffer(), "<i8")
                        longer, shorter = (own, total) if len(own) > len(total) else (total, own)
                        total = longer.copy()
                        total[: len(shorter)] += shorter
                else:
                    total = _counted(total, np.concatenate(list(_arrays(few))))
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], ["id", "n"])

    read = coded.select("counts").where("counts IS NOT NULL") if told else coded.select("ids", "width")
    return read.mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_ids(coded: DataFrame, path: str, max_bits: int = MAX_BITS, part_ids: int = PART_IDS) -> None:
    """Write (doc_id, ids, width) rows in ascending doc_id order; `coded` is read three times, so stage it before. Rows
    with `counts`, as `encode_texts` gives them, tell how often ids stand in the others.

    The driver receives the counts, one row per distinct id (bounded by the vocabulary), and the cuts between
    parts. NULL doc_ids come first, rows of one doc_id stay together, repeated rows are all written. An empty
    table writes an empty code and no blocks.
    """
    spark = coded.sparkSession
    counts = sorted((r["n"], r["id"]) for r in id_counts(coded).collect())
    ids = [i for _, i in counts]
    lengths = code_lengths(np.array([n for n, _ in counts], np.int64), max_bits)
    code = Code(ids, lengths)
    row = [(code.ids.tolist(), code.lengths.tolist(), code.bits)]
    spark.createDataFrame(row, "ids array<long>, lengths array<long>, bits int").coalesce(1).write.parquet(f"{path}/code")

    documents = coded.where("ids IS NOT NULL").select("doc_id", "ids", "width")
    limits = np.array(range_limits(documents, "doc_id", ranges(sum(n for n, _ in counts), part_ids)), np.int64)

    def code_documents(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                few = batch.slice(at, 256)
                arrays = list(_arrays(few))
                sizes = np.array([len(a) for a in arrays], np.int64)
                data, begins, offsets = code.encode(np.concatenate(arrays).astype(np.int64), sizes)
                firsts = np.cumsum(sizes) - sizes
                marks = [(offsets[f : f + n : SEGMENT] - 8 * b).astype("<u8").tobytes() for f, n, b in zip(firsts, sizes, begins)]
                keys = few.column("doc_id")
                part = np.searchsorted(limits, keys.fill_null(-(1 << 63)).to_numpy(zero_copy_only=False), "left")
                bits = [data[a:b] for a, b in zip(begins[:-1], begins[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part, pa.int32()), keys, pa.array(sizes), pa.array(marks, pa.binary()), pa.array(bits, pa.binary())],
                    ["part", "doc_id", "n", "marks", "bits"],
                )

    def block_documents(batches):
        import pyarrow as pa

        part, block, start, own = None, 0, 0, []

        def flush():
            nonlocal block, start, own
            marks, place = [], 0
            for _, _, mark, bits in own:
                marks.append(np.frombuffer(mark, "<u8") + np.uint64(8 * place))
                place += len(bits)
            tokens = [n for _, n, _, _ in own]
            row = {
                "part": part, "block": block, "start": start, "doc_ids": [d for d, _, _, _ in own],
                "doc_tokens": tokens, "checkpoints": np.concatenate(marks).astype("<u8").tobytes(),
                "bits": b"".join(bits for _, _, _, bits in own),
            }
            block, start, own = block + 1, start + sum(tokens), []
            return pa.RecordBatch.from_pylist([row], schema=schema)

        schema = pa.schema([
            ("part", pa.int32()), ("block", pa.int32()), ("start", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
            ("doc_tokens", pa.list_(pa.int64())), ("checkpoints", pa.binary()), ("bits", pa.binary()),
        ])
        held = 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("part", "doc_id", "n", "marks", "bits"))):
                if own and (row[0] != part or held >= BLOCK_IDS):
                    yield flush()
                    held = 0
                if row[0] != part:
                    part, block, start = row[0], 0, 0
                own.append(row[1:])
                held += row[2]
        if own:
            yield flush()

    made = documents.mapInArrow(code_documents, "part int, doc_id long, n long, marks binary, bits binary")
    ordered = made.repartitionById(len(limits) + 1, "part").sortWithinPartitions("part", "doc_id", "n", "bits")
    ordered.mapInArrow(block_documents, BLOCKS).write.option("compression", "uncompressed").parquet(f"{path}/blocks")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids binary of little-endian unsigned 32 bit), start counting all ids before.

    Blocks are decoded independently; the ids of each part, one row a part, are added up and broadcast.
    """
    kept = spark.read.schema("ids array<long>, lengths array<long>, bits int").parquet(f"{path}/code").first()
    ids, lengths = (kept["ids"], kept["lengths"]) if kept else ([], [])
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")

    def decode(batches):
        import pyarrow as pa

        tables = Code(ids, lengths).tables()
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                tokens = np.array(row["doc_tokens"], np.int64)
                segments = -(-tokens // SEGMENT)
                sizes = np.full(int(segments.sum()), SEGMENT, np.int64)
                lasts = np.cumsum(segments) - 1
                sizes[lasts] = tokens - (segments - 1) * SEGMENT
                found = decode_segments(row["bits"], np.frombuffer(row["checkpoints"], "<u8"), sizes, tables)
                ends = np.cumsum(tokens)
                raw = found.astype("<u4").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["part"]] * len(tokens), pa.int32()),
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(row["start"] + ends - tokens),
                        pa.array(tokens),
                        pa.array([raw[4 * (e - n) : 4 * e] for e, n in zip(ends, tokens)], pa.binary()),
                    ],
                    ["part", "doc_id", "start", "n_tokens", "ids"],
                )

    totals = blocks.select("part", F.aggregate("doc_tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.groupBy("part").agg(F.sum("n").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    found = blocks.mapInArrow(decode, "part int, doc_id long, start long, n_tokens long, ids binary")
    return found.join(F.broadcast(shifts), "part").select(
        "doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids"
    )


def huffman_round_trip(docs: DataFrame, path: str, tokenizer: str, spaces: str, end_id: int) -> DataFrame:
    """Encode, write to `path` and read back."""
    write_ids(staged(encode_texts(docs, tokenizer, spaces, end_id), "token-ids"), path)
    return read_ids(docs.sparkSession, path)
