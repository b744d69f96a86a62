"""Packing documents into token windows filled with lexical neighbours.

Full windows of a document are sequences of their own; what is left of each document, its tail, is packed. Tails are
ordered by a min-hash of their token pairs, so that similar ones lie close, and dealt in ranges to tasks. In a task
they form index shards of SHARD_TAILS tails. A shard's BM25 inverted index over token ids, weighted with document
frequencies over the whole corpus, returns the neighbours of a seed tail; unused ones fill the seed's window in order
of score. The last one is cut where the window is full, and its rest stays to be used. Tails left when a shard
ends go on to the task's next shard, so that only the last window of a task has padding.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tapeglass.llm.common import ranges, staged
from tapeglass.llm.tokens import encoder, narrow, slices

WINDOW = 1024
SHARD_TAILS = 512
TASK_TOKENS = 2_000_000
MARKED_TEXTS = 32
K1, B = 1.2, 0.75
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, `offset` long"
)


def _signature(ids: np.ndarray) -> int:
    """Min-hash of the pairs of neighbouring ids."""
    if len(ids) < 2:
        return 0
    pairs = ids[:-1].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + ids[1:].astype(np.uint64)
    pairs ^= pairs >> np.uint64(32)
    return int((pairs * np.uint64(0xD6E8FEB86659FD93)).min() >> np.uint64(1))


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _cut_documents(docs: DataFrame, tokenizer: str, spaces: str, end_id: int, window: int, key: str, text: str) -> DataFrame:
    """A row per document (doc_id, doc_tokens, crcs of its full windows, tail, signature), and a row per task and
    thousands of documents that holds only `frequencies`: documents by token id, unsigned 32 bit."""

    def run(batches):
        import pyarrow as pa

        own = encoder(tokenizer, spaces, end_id)
        schema = pa.schema([
            ("doc_id", pa.int64()), ("doc_tokens", pa.int64()), ("crcs", pa.list_(pa.int64())),
            ("tail", pa.binary()), ("signature", pa.int64()), ("frequencies", pa.binary()),
        ])
        frequencies = np.zeros(own.size, np.uint32)
        seen = np.zeros((MARKED_TEXTS, own.size), bool)
        for batch in batches:
            for few in slices(batch):
                rows = []
                for doc, raw in zip(few.column(0).to_pylist(), own.encode(few.column(1).to_pylist())):
                    ids = np.frombuffer(raw, own.dtype)
                    # Documents by id: marks of some documents side by side are counted at once.
                    seen[len(rows) % MARKED_TEXTS, ids] = True
                    if len(rows) % MARKED_TEXTS == MARKED_TEXTS - 1:
                        frequencies += seen.sum(axis=0, dtype=np.uint32)
                        seen[:] = False
                    full = len(ids) // window * window
                    crcs = [_crc(ids[i : i + window]) for i in range(0, full, window)]
                    tail = ids[full:]
                    rows.append((doc, len(ids), crcs, tail.tobytes(), _signature(tail), None))
                frequencies += seen.sum(axis=0, dtype=np.uint32)
                seen[:] = False
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
        last = {"frequencies": frequencies.tobytes()}
        yield pa.RecordBatch.from_pylist([last], schema=schema)

    return narrow(docs, key, text).mapInArrow(
        run, "doc_id long, doc_tokens long, crcs array<long>, tail binary, signature long, frequencies binary"
    )


def _document_frequencies(rows: DataFrame, size: int) -> np.ndarray:
    """Documents by token id; the driver receives one row per id that occurs, bounded by the vocabulary."""

    def run(batches):
        import pyarrow as pa

        total = np.zeros(size, np.int64)
        for batch in batches:
            for raw in batch.column(0):
                total += np.frombuffer(raw.as_buffer(), np.uint32)
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], ["id", "n"])

    counted = rows.where("frequencies IS NOT NULL").select("frequencies").mapInArrow(run, "id long, n long")
    found = np.zeros(size, np.int64)
    table = counted.groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    found[table.column("id").to_numpy()] = table.column("n").to_numpy()
    return found


class Shard:
    """BM25 inverted index over tails."""

    def __init__(self, tails: list[np.ndarray], idf: np.ndarray, mean: float):
        counted = [np.unique(t, return_counts=True) for t in tails]
        sizes = np.array([len(t) for t in tails])
        self.terms_of = [terms for terms, _ in counted]
        terms = np.concatenate(self.terms_of).astype(np.int64)
        tf = np.concatenate([n for _, n in counted]).astype(float)
        docs = np.repeat(np.arange(len(tails)), [len(t) for t in self.terms_of])
        weight = idf[terms] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * sizes[docs] / mean))
        order = np.argsort(terms, kind="stable")
        self.docs, self.weight = docs[order], weight[order]
        self.known, self.first, self.held = np.unique(terms[order], return_index=True, return_counts=True)

    def scores(self, seed: int) -> np.ndarray:
        """Score of every tail for the terms of the seed."""
        at = np.searchsorted(self.known, self.terms_of[seed])
        first, held = self.first[at], self.held[at]
        step = np.repeat(first - (np.cumsum(held) - held), held) + np.arange(int(held.sum()))
        return np.bincount(self.docs[step], self.weight[step], len(self.terms_of))


def _fill(tails: list[list], idf: np.ndarray, mean: float, window: int, at_end: bool):
    """Sequences of the tails of one shard as lists of pieces, and the tails that fill no window.

    A tail is [doc_id, doc_tokens, start, ids]. At the end of the task the last window is given out with padding.
    """
    shard = Shard([t[3] for t in tails], idf, mean)
    unused = np.ones(len(tails), bool)
    left = int(sum(len(t[3]) for t in tails))
    sequences = []
    seed = 0
    while left >= window or (at_end and left):
        while not unused[seed]:
            seed += 1
        order = np.argsort(-np.where(unused, shard.scores(seed), -1.0), kind="stable")
        pieces, room = [], window
        for i in (seed, *order.tolist()):
            if not unused[i]:
                continue
            doc, tokens, start, ids = tails[i]
            taken = min(room, len(ids))
            pieces.append((doc, tokens, start, ids[:taken]))
            if taken < len(ids):
                tails[i] = [doc, tokens, start + taken, ids[taken:]]
            else:
                unused[i] = False
            room -= taken
            if not room or not unused.any():
                break
        left -= window - room
        sequences.append(pieces)
    return sequences, [t for t, free in zip(tails, unused) if free]


def pack(
    docs: DataFrame, tokenizer: str, spaces: str, end_id: int, window: int = WINDOW,
    task_tokens: int = TASK_TOKENS, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of sequences of `window` ids.

    Every id of every document, its end id included, lies in exactly one piece; offsets have no gaps from 0. NULL
    texts count as empty and give their end id, repeated rows are packed each, NULL keys are reported as NULL, an
    empty table gives no rows. Other columns are not read.
    """
    rows = staged(_cut_documents(docs, tokenizer, spaces, end_id, window, key, text), "cut-documents")
    whole = rows.where("frequencies IS NULL")
    size = encoder(tokenizer, spaces, end_id).size
    frequencies = _document_frequencies(rows, size)
    width = encoder(tokenizer, spaces, end_id).dtype.str
    total, in_tails = whole.agg(F.count(F.lit(1)), F.sum(F.col("doc_tokens") % window)).first()
    idf = np.log1p((total - frequencies + 0.5) / (frequencies + 0.5))
    mean = max(1.0, (in_tails or 0) / max(1, total))
    parts = ranges(in_tails or 0, task_tokens)

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        made = TaskContext.get().partitionId() << 40
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        kinds = [pa.int64()] * len(names)
        out: list[tuple] = []
        tails: list[list] = []

        def give(sequences):
            nonlocal made
            for pieces in sequences:
                at = 0
                for doc, tokens, start, ids in pieces:
                    out.append((doc, start, len(ids), _crc(ids), tokens, made, at))
                    at += len(ids)
                made += 1

        def flushed():
            columns = list(zip(*out)) or [()] * len(names)
            done = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
            out.clear()
            return done

        for batch in batches:
            for doc, tokens, crcs, tail in zip(*(c.to_pylist() for c in batch.columns)):
                for i, crc in enumerate(crcs):
                    out.append((doc, i * window, window, crc, tokens, made, 0))
                    made += 1
                if tail:
                    tails.append([doc, tokens, len(crcs) * window, np.frombuffer(tail, width)])
                if len(tails) >= SHARD_TAILS:
                    sequences, tails = _fill(tails, idf, mean, window, False)
                    give(sequences)
            yield flushed()
        if tails:
            give(_fill(tails, idf, mean, window, True)[0])
        yield flushed()

    dealt = whole.repartitionByRange(parts, "signature", "doc_id")
    ordered = dealt.sortWithinPartitions("signature", "doc_id", "doc_tokens", "tail")
    return ordered.select("doc_id", "doc_tokens", "crcs", "tail").mapInArrow(run, PIECES)
