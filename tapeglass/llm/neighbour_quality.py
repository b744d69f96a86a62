"""Quality scores by nearest-neighbour voting on latent-semantic vectors.

A text is described twice. Its terms are words and triplets of characters, hashed and weighted by TF-IDF with document
frequencies over all documents. Its kinds are counts of triplets of character classes, and two measures of repetition.
Centred and projected on the leading singular vectors of a labelled sample, texts of one vocabulary or one kind of
writing lie in one direction. Every document's two vectors are compared with all labelled ones by exact cosines, in
blocks, and the labels of the nearest ones by the mean of both vote with their similarity.
"""

from __future__ import annotations

import pickle
import re
import zlib

import numpy as np
from pyspark.sql import DataFrame, functions as F

#: Labelled documents that the vectors and votes come from, at most; the ones with the smallest hash of their key.
SAMPLE = 4096
DIMENSIONS = 24
NEIGHBOURS = 32
SHARPNESS = 4
SMOOTHING = 0.25
CLASSES = 11
ACCEPT_FROM = 0.3
#: Hash values of words, and as many of character triplets.
TERM_BITS = 14
TERMS = 2 << TERM_BITS
TERM_DIMENSIONS = 48
#: Rounds of the subspace iteration that finds the singular vectors of the terms.
ROUNDS = 8


def _class_table() -> bytes:
    """Character class by byte: line end, space, lower, upper, digit, . , | other ASCII, lead byte, later byte."""
    table = np.full(256, 8, np.uint8)
    table[128:], table[192:] = 10, 9
    table[ord("a") : ord("z") + 1], table[ord("A") : ord("Z") + 1], table[ord("0") : ord("9") + 1] = 2, 3, 4
    for i, signs in enumerate(("\n", " \t\r")):
        table[[ord(c) for c in signs]] = i
    for i, sign in enumerate(".,|"):
        table[ord(sign)] = 5 + i
    return table.tobytes()


CLASS_OF = _class_table()
FEATURES = CLASSES**3 + 2


def features(text: str | None) -> np.ndarray:
    """Square roots of the triplets' shares, and of the shares of repeated neighbours and of repeated words."""
    data = (text or "").encode()
    found = np.zeros(FEATURES, np.float32)
    kinds = np.frombuffer(data.translate(CLASS_OF), np.uint8).astype(np.int32)
    if len(kinds) > 2:
        triplets = (kinds[:-2] * CLASSES + kinds[1:-1]) * CLASSES + kinds[2:]
        found[: CLASSES**3] = np.bincount(triplets, minlength=CLASSES**3) / len(triplets)
    words = data.split()
    if len(words) > 1:
        found[-2] = sum(map(bytes.__eq__, words, words[1:])) / (len(words) - 1)
        found[-1] = 1 - len(set(words)) / len(words)
    return np.sqrt(found)


def terms(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hash values of the words and of the character triplets in a text, ascending, and how often each stands there."""
    lower = (text or "").lower()
    found = re.findall(r"\w+", lower)
    words = np.fromiter((zlib.crc32(w.encode()) for w in found), np.uint32, len(found)) >> np.uint32(32 - TERM_BITS)
    signs = np.frombuffer(lower.encode("utf-32-le"), np.uint32)
    triplets = (signs[:-2] * np.uint32(0x9E3779B1) + signs[1:-1]) * np.uint32(0x85EBCA77) + signs[2:]
    triplets = ((triplets ^ (triplets >> np.uint32(15))) * np.uint32(0xC2B2AE3D)) >> np.uint32(32 - TERM_BITS)
    counts = np.bincount(np.concatenate([words, triplets + np.uint32(1 << TERM_BITS)]), minlength=TERMS)
    held = np.flatnonzero(counts)
    return held.astype(np.uint16), counts[held].astype(np.uint32)


class Terms:
    """TF-IDF weights and the projection on the leading singular vectors of the labelled texts' weights."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], documents: int, frequencies: np.ndarray):
        self.idf = np.log((1 + documents) / (1 + frequencies)).astype(np.float32)
        self.mean, self.axes = np.zeros(TERMS, np.float32), np.zeros((TERMS, 0), np.float32)
        sparse = [self._weights(*row) for row in rows]
        for at, weights in sparse:
            self.mean[at] += weights / len(sparse)
        axes = np.random.default_rng(0).standard_normal((TERMS, min(TERM_DIMENSIONS, len(rows)))).astype(np.float32)
        for _ in range(ROUNDS if rows else 0):
            made = self._projected(sparse, axes)
            back = -np.outer(self.mean, made.sum(axis=0))
            for (at, weights), row in zip(sparse, made):
                back[at] += np.outer(weights, row)
            axes = np.linalg.qr(back)[0]
        if rows:
            _, strength, turned = np.linalg.svd(self._projected(sparse, axes), full_matrices=False)
            self.axes = np.ascontiguousarray((axes @ turned.T)[:, strength > 1e-4 * max(1.0, strength[0])])
        self.offset = self.mean @ self.axes

    def _weights(self, at: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        weights = (1 + np.log(counts.astype(np.float32))) * self.idf[at]
        return at, weights / max(float(np.linalg.norm(weights)), 1e-9)

    def _projected(self, sparse, axes: np.ndarray) -> np.ndarray:
        offset = self.mean @ axes
        return np.stack([weights @ axes[at] - offset for at, weights in sparse])

    def vectors(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        weighted = (self._weights(*row) for row in rows)
        return np.stack([weights @ self.axes[at] - self.offset for at, weights in weighted])


class Voters:
    """Labelled vectors and the projections they come from."""

    def __init__(self, rows: np.ndarray, term_rows: list, labels: np.ndarray, documents: int, frequencies: np.ndarray):
        self.labels = labels.astype(np.float32)
        self.terms = Terms(term_rows, documents, frequencies)
        self.term_vectors = self._unit(self.terms.vectors(term_rows)) if term_rows else None
        self.prior = float(labels.mean()) if len(labels) else 0.5
        self.mean = rows.mean(axis=0) if len(rows) else np.zeros(FEATURES, np.float32)
        centred = rows - self.mean
        _, axes = np.linalg.eigh(centred.T.astype(float) @ centred) if len(rows) else (None, np.zeros((FEATURES, 0)))
        self.axes = axes[:, ::-1][:, :DIMENSIONS].astype(np.float32)
        self.vectors = self._unit(centred @ self.axes)

    @staticmethod
    def _unit(vectors: np.ndarray) -> np.ndarray:
        return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Share of label 1 among the nearest voters, weighted by similarity and smoothed with the overall share."""
        if not len(self.labels):
            return np.full(len(texts), self.prior)
        rows = np.stack([features(t) for t in texts])
        cosines = self._unit((rows - self.mean) @ self.axes) @ self.vectors.T
        cosines += self._unit(self.terms.vectors([terms(t) for t in texts])) @ self.term_vectors.T
        cosines /= 2
        count = min(NEIGHBOURS, cosines.shape[1])
        near = np.argpartition(cosines, cosines.shape[1] - count, axis=1)[:, -count:]
        weights = np.maximum(np.take_along_axis(cosines, near, axis=1), 0.0).astype(float) ** SHARPNESS
        votes = (weights * self.labels[near]).sum(axis=1) + SMOOTHING * self.prior
        return votes / (weights.sum(axis=1) + SMOOTHING)


def held_out(key: str = "doc_id"):
    """Rows whose labels are never learned from."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % 5 == 0


def _term_frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """Number of rows, and rows by term; the driver receives one row per term, bounded by the number of hash values."""

    def run(batches):
        import pyarrow as pa

        total = np.zeros(TERMS + 1, np.int64)
        for batch in batches:
            total[TERMS] += batch.num_rows
            for text in batch.column(0):
                total[terms(text.as_py())[0]] += 1
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["term", "n"])

    counted = texts.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    found = np.zeros(TERMS + 1, np.int64)
    found[counted.column("term").to_numpy()] = counted.column("n").to_numpy()
    return int(found[TERMS]), found[:TERMS]


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, key: str = "doc_id", text: str = "text", label: str = "quality") -> Voters:
    """Voters from at most `sample` labelled documents, put together in one task; the driver receives the vectors and
    projections alone. Terms are weighted by how many of all `docs` have them.

    Labels other than 0 and 1, of absent documents or of held-out rows are not used. Without any, all scores are 0.5.
    NULL texts count as empty; repeated documents and repeated labels are voters each, and ties of votes share. Other
    columns are not read.
    """
    known = labels.where(F.col(label).isin(0, 1) & ~held_out(key) & F.col(key).isNotNull())
    known = known.select(F.col(key).cast("long").alias("_key"), F.col(label).cast("int").alias("_label"))
    chosen = known.orderBy(F.xxhash64("_key"), "_key", "_label").limit(sample)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(1).to_pylist()
            made = [features(t).tobytes() for t in texts]
            held = [[part.tobytes() for part in terms(t)] for t in texts]
            columns = [batch.column(0), *(pa.array(c, pa.binary()) for c in (made, [h[0] for h in held], [h[1] for h in held]))]
            yield pa.RecordBatch.from_arrays(columns, ["label", "features", "terms", "counts"])

    texts = docs.select(F.col(key).cast("long").alias("_key"), F.col(text).alias("_text"))
    rows = texts.join(F.broadcast(chosen), "_key").select("_label", "_text")
    made = rows.mapInArrow(run, "label int, features binary, terms binary, counts binary")
    documents, frequencies = _term_frequencies(docs.select(F.col(text)))

    def train(batches):
        import pyarrow as pa

        found = sorted(row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("features", "terms", "counts", "label"))))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(_trained(found, documents, frequencies))], pa.binary())], ["voters"])

    # One task holds the sample, whose size is bounded.
    packed = made.repartition(1).mapInArrow(train, "voters binary").first()
    return pickle.loads(packed["voters"]) if packed else _trained([], documents, frequencies)


def _trained(rows: list[tuple], documents: int, frequencies: np.ndarray) -> Voters:
    """Voters of (features, terms, counts, label) rows."""
    matrix = np.frombuffer(b"".join(f for f, *_ in rows), np.float32).reshape(-1, FEATURES)
    held = [(np.frombuffer(at, np.uint16), np.frombuffer(counts, np.uint32)) for _, at, counts, _ in rows]
    return Voters(matrix, held, np.array([y for *_, y in rows]), documents, frequencies)


def quality_scores(docs: DataFrame, voters: Voters, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) of every row from its whole text alone; NULL counts as empty and every text has a score.

    Repeated rows are scored each, equal texts alike; an empty table gives no rows. Long texts are read whole, other
    columns not at all.
    """

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                few = batch.slice(at, 512)
                scores = pa.array(voters.scores(few.column(1).to_pylist()).astype(float))
                yield pa.RecordBatch.from_arrays([few.column(0), scores], [key, "score"])

    kind = dict(docs.dtypes)[key]
    return docs.select(F.col(key), F.col(text)).mapInArrow(run, f"`{key}` {kind}, score double")


def accepted(docs: DataFrame, voters: Voters, text: str = "text", accept_from: float = ACCEPT_FROM) -> DataFrame:
    """The rows of `docs` whose score reaches `accept_from`, with all their columns as they are.

    Rows are kept or dropped each by its own text, NULL as empty; repeated rows alike. An empty table stays empty.
    """

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                few = batch.slice(at, 512)
                yield few.filter(pa.array(voters.scores(few.column(text).to_pylist()) >= accept_from))

    return docs.mapInArrow(run, docs.schema)
