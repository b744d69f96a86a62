"""Exact search of the highest inner products with KD-trees.

Vectors are dealt to cells by median splits that a bounded sample gives, and cells of many vectors to shards of a
bounded number by the hash of their key, so that equal vectors, however many, fill no shard of their own. Each shard
has a KD-tree: median splits of the widest dimension down to leaves, every node with the tight box of its vectors. The
inner product of a query and any vector in a box is at most the sum, dimension by dimension, of the larger of the
query's products with both sides of the box.

A query asks its own cell first, then the next cells in the order of their bounds, then all that are left; after each
round the score of its k-th best hit so far goes on with it, and cells whose bound lies below are not asked. Inside a
tree nodes are taken best first by their bound until it lies below that score or the k-th best of the tree. Nothing
else is left out, so results are exact whatever the sample is.
"""

from __future__ import annotations

import heapq
import pickle

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from tapeglass.llm.common import staged

#: Vectors that the splits into cells come from, at most: the ones with the smallest hash of their key.
SAMPLE = 8192
#: Cells at most; their boxes go to the tasks that choose cells for queries.
CELLS = 1024
SHARD_ROWS = 4096
LEAF_ROWS = 128
#: Queries that one task takes through one tree.
QUERY_ROWS = 1024
#: Cells that a query asks in the second round.
NEXT_CELLS = 2
LONG = np.iinfo(np.int64)


def whole_components(vector: Column, scale: float = 64.0) -> Column:
    """floor(scale * x) of all components as long; NULL if one is NULL or not finite. Beyond the range of long they
    are the nearest long."""
    values = F.transform(vector, lambda x: x.cast("double"))
    fit = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(fit, F.transform(values, lambda x: F.floor(x * scale).cast("long")))


def _matrix(column, dims: int, kind) -> np.ndarray:
    """Rows of a list column of longs; short ones end in zeros, which add nothing to a product."""
    made = np.zeros((len(column), dims), np.int64)
    lengths = np.diff(np.asarray(column.offsets))
    rows = np.repeat(np.arange(len(column)), lengths)
    places = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    made[rows, places] = np.asarray(column.flatten())
    return made.astype(kind)


class Tree:
    """KD-tree over the rows of a matrix, and the highest products with a query."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf_rows: int = LEAF_ROWS):
        order = np.lexsort((ids,))
        self.low, self.high, self.child, self.span = [], [], [], []
        self._grow(order, vectors, 0, leaf_rows)
        self.low, self.high = np.array(self.low), np.array(self.high)
        self.ids, self.vectors = ids[order], vectors[order]

    def _grow(self, order: np.ndarray, vectors: np.ndarray, start: int, leaf_rows: int) -> int:
        """Add the node of the rows in `order`, which it rearranges, and all below it; its number."""
        own, node = vectors[order], len(self.child)
        low, high = own.min(axis=0), own.max(axis=0)
        self.low.append(low)
        self.high.append(high)
        self.span.append((start, start + len(order)))
        self.child.append(None)
        if len(order) > leaf_rows and (high > low).any():
            # Half of the rows on either side, whatever ties there are.
            half = len(order) // 2
            order[:] = order[np.argsort(own[:, int(np.argmax(high - low))], kind="stable")]
            left = self._grow(order[:half], vectors, start, leaf_rows)
            self.child[node] = (left, self._grow(order[half:], vectors, start + half, leaf_rows))
        return node

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The highest product possible in each node's box, by query."""
        return box_bounds(queries, self.low, self.high)

    def best(self, query: np.ndarray, own_id: int, bounds: np.ndarray, k: int, least) -> tuple[np.ndarray, np.ndarray]:
        """(scores, ids) of the k highest products of at least `least`, ties to smaller ids; without the query's own."""
        scores, ids = self.vectors[:0] @ query, self.ids[:0]
        waiting = [(-bounds[0], 0)]
        while waiting and (least is None or -waiting[0][0] >= least):
            _, node = heapq.heappop(waiting)
            if self.child[node]:
                for child in self.child[node]:
                    if least is None or bounds[child] >= least:
                        heapq.heappush(waiting, (-bounds[child], child))
                continue
            start, end = self.span[node]
            found = self.vectors[start:end] @ query
            fit = self.ids[start:end] != own_id
            if least is not None:
                fit &= found >= least
            scores = np.concatenate([scores, found[fit]])
            ids = np.concatenate([ids, self.ids[start:end][fit]])
            if len(scores) > k:
                keep = np.lexsort((ids, -scores))[:k]
                scores, ids = scores[keep], ids[keep]
            if len(scores) == k:
                least = scores.min() if least is None else max(least, scores.min())
        return scores, ids


def box_bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T


def _splits(rows: np.ndarray, depth: int) -> list:
    """A tree of median splits: [dimension, value, left, right], or None for a cell."""
    if not depth or len(rows) < 2:
        return None
    spread = rows.max(axis=0) - rows.min(axis=0) if rows.shape[1] else np.zeros(0)
    if not len(spread) or not spread.any():
        return None
    at = int(np.argmax(rows.astype(float).var(axis=0)))
    if not spread[at]:
        at = int(np.argmax(spread))
    value = np.sort(rows[:, at], kind="stable")[len(rows) // 2]
    left = rows[:, at] < value
    if not left.any():
        left = rows[:, at] <= value
        value += 1
    return [at, value, _splits(rows[left], depth - 1), _splits(rows[~left], depth - 1)]


def _cells(rows: np.ndarray, splits, first: int, size: int) -> np.ndarray:
    """The cell of each row: the leaf of the splits it falls in, numbered from left to right with gaps."""
    found = np.full(len(rows), first, np.int64)
    if splits is not None and len(rows):
        at, value, left, right = splits
        below = rows[:, at] < value
        found[below] = _cells(rows[below], left, first, size // 2)
        found[~below] = _cells(rows[~below], right, first + size // 2, size // 2)
    return found


class Index:
    """`vectors` (id, v, cell, shard) and `trees` (shard, cell, tree), both staged; `boxes` by cell on the driver."""

    def __init__(self, vectors: DataFrame, sample: int = SAMPLE, shard_rows: int = SHARD_ROWS, leaf_rows: int = LEAF_ROWS):
        rows = staged(vectors, "kd-vectors")
        total, dims, most = rows.agg(
            F.count(F.lit(1)), F.max(F.size("v")), F.max(F.aggregate("v", F.lit(0).cast("double"), lambda m, x: F.greatest(m, F.abs(x.cast("double")))))
        ).first()
        self.dims = dims = int(dims or 0)
        # Products are whole numbers, and doubles hold them exactly up to 2^53; beyond, Python's integers do.
        self.kind = kind = np.float64 if dims * (most or 0.0) ** 2 < 2**53 else object
        depth = max(0, min(CELLS, -(-total // shard_rows)) - 1).bit_length()
        chosen = rows.orderBy(F.xxhash64("id"), "id", "v").limit(sample).select("v").toArrow().column("v").combine_chunks() if depth else None
        splits = _splits(_matrix(chosen, dims, kind), depth) if depth else None

        def placed(batches):
            import pyarrow as pa

            for batch in batches:
                cell = _cells(_matrix(batch.column("v"), dims, kind), splits, 0, 1 << depth)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], ["id", "v", "cell"])

        celled = staged(rows.mapInArrow(placed, "id long, v array<long>, cell long"), "kd-cells")
        sizes = {r["cell"]: r["count"] for r in celled.groupBy("cell").count().collect()}
        self.shards = {cell: max(1, -(-n // shard_rows)) for cell, n in sizes.items()}
        counts = F.array(*(F.lit(self.shards.get(c, 1)) for c in range(1 << depth)))
        # Equal keys would meet in one shard; the vector is part of the hash, and so is the row's place for equal vectors.
        part = F.pmod(F.xxhash64("id", "v", F.monotonically_increasing_id()), F.get(counts, F.col("cell").cast("int")))
        shard = F.col("cell") * (1 << 32) + part
        self.vectors = staged(celled.withColumn("shard", shard), "kd-shards")

        def build(table):
            import pyarrow as pa

            tree = Tree(table.column("id").to_numpy(), _matrix(table.column("v").combine_chunks(), dims, kind), leaf_rows)
            columns = [table.column("shard")[:1], table.column("cell")[:1], pa.array([pickle.dumps(tree)], pa.binary())]
            columns += [pa.array([[int(x) for x in side]], pa.list_(pa.int64())) for side in (tree.low[0], tree.high[0])]
            return pa.table([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns], ["shard", "cell", "tree", "low", "high"])

        grown = self.vectors.groupBy("shard").applyInArrow(build, "shard long, cell long, tree binary, low array<long>, high array<long>")
        self.trees = staged(grown, "kd-trees")
        self.boxes = self._boxes()

    def _boxes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(cells, low, high): the driver gets a row per cell and dimension."""
        sides = self.trees.select("cell", F.posexplode(F.arrays_zip("low", "high")).alias("at", "side"))
        found = sides.groupBy("cell", "at").agg(F.min("side.low").alias("low"), F.max("side.high").alias("high")).toArrow().to_pydict()
        cells = np.array(sorted(self.shards), np.int64)
        low, high = np.zeros((len(cells), self.dims), self.kind), np.zeros((len(cells), self.dims), self.kind)
        row = np.searchsorted(cells, np.array(found["cell"], np.int64))
        low[row, found["at"]], high[row, found["at"]] = found["low"], found["high"]
        return cells, low, high

    def _asked(self, queries: DataFrame, first: int, last: int | None) -> DataFrame:
        """(query_id, v, kth, shard) of the shards of the cells that stand in places first to last of the query's
        order, its own cell before all others, and may hold a score of kth or more."""
        (cells, low, high), dims, kind = self.boxes, self.dims, self.kind
        shards = np.array([self.shards[c] for c in cells.tolist()], np.int64)

        def run(batches):
            import pyarrow as pa

            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    few = batch.slice(at, 256)
                    bounds = box_bounds(_matrix(few.column("v"), dims, kind), low, high)
                    own = np.searchsorted(cells, np.asarray(few.column("cell")))
                    rows, to = [], []
                    for i, (row, home, kth) in enumerate(zip(bounds, own.tolist(), few.column("kth").to_pylist())):
                        order = [home, *(c for c in np.argsort(-row, kind="stable").tolist() if c != home)]
                        for c in order[first:last]:
                            if kth is None or row[c] >= kth:
                                rows += [i] * int(shards[c])
                                to += [int(cells[c] << 32) + s for s in range(shards[c])]
                    taken = few.select(["query_id", "v", "kth"]).take(pa.array(rows, pa.int64()))
                    yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(to, pa.int64())], ["query_id", "v", "kth", "shard"])

        return queries.select("query_id", "v", "kth", "cell").mapInArrow(run, "query_id long, v array<long>, kth long, shard long")

    def _hits(self, asked: DataFrame, k: int, salts: int) -> DataFrame:
        """(query_id, id, score): each asked shard's k highest scores of at least kth."""
        dims, kind = self.dims, self.kind
        asked = staged(asked.withColumn("salt", F.pmod(F.xxhash64("query_id"), F.lit(salts))), "kd-asked")
        wanted = asked.select(F.col("shard").alias("of"), F.col("salt").alias("part")).distinct()
        trees = wanted.join(self.trees.select("shard", "tree"), F.col("shard") == F.col("of")).select("of", "part", "tree")

        def search(queries, held):
            import pyarrow as pa

            names = ["query_id", "id", "score"]
            out = [[], [], []]
            if held.num_rows and queries.num_rows:
                tree = pickle.loads(held.column("tree")[0].as_py())
                vectors = _matrix(queries.column("v").combine_chunks(), dims, kind)
                bounds = tree.bounds(vectors)
                for vector, row, own, kth in zip(vectors, bounds, queries.column("query_id").to_pylist(), queries.column("kth").to_pylist()):
                    scores, ids = tree.best(vector, own, row, k, kth)
                    out[0] += [own] * len(ids)
                    out[1] += ids.tolist()
                    out[2] += [min(max(int(s), LONG.min), LONG.max) for s in scores]
            return pa.table([pa.array(c, pa.int64()) for c in out], names)

        cogrouped = asked.groupBy("shard", "salt").cogroup(trees.groupBy("of", "part"))
        return cogrouped.applyInArrow(search, "query_id long, id long, score long")

    def search(self, queries: DataFrame, k: int) -> DataFrame:
        """(query_id, rank, id, score) of the k highest products of each (query_id, v) row of `queries` that stands in
        the index too."""
        own = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
        # A key of several rows asks once, with its first vector; it finds no row of its own.
        home = queries.groupBy("query_id").agg(F.min(F.struct("v", "cell")).alias("first"))
        waiting = staged(home.select("query_id", "first.v", "first.cell", F.lit(None).cast("long").alias("kth")), "kd-queries")
        salts = max(1, -(-waiting.count() // QUERY_ROWS))
        best = None
        for first, last in ((0, 1), (1, 1 + NEXT_CELLS), (1 + NEXT_CELLS, None)):
            if first >= max(1, len(self.shards)):
                break
            hits = self._hits(self._asked(waiting, first, last), k, salts)
            if best is not None:
                hits = hits.unionByName(best.select("query_id", "id", "score"))
            best = staged(hits.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k), "kd-hits")
            # A score cut to the range of long from below is no bound.
            kth = best.where((F.col("rank") == k) & (F.col("score") > int(LONG.min))).select("query_id", F.col("score").alias("kth"))
            waiting = waiting.drop("kth").join(kth, "query_id", "left")
        return best.select("query_id", "rank", "id", "score")


def top_products(vectors: DataFrame, is_query: Column, k: int, key: str = "vec_id", vector: str = "embedding", **options) -> DataFrame:
    """(query_id, rank, key, score) of the k highest whole inner products of every row that `is_query` holds for with all
    other rows; all of them if there are fewer. Ties go to smaller keys.

    Rows without a key or a vector, or with a NULL or non-finite component, take no part; of vectors of several lengths
    the missing components count as zero. Repeated rows are candidates each; no row of a query's own key is one, and
    a repeated query asks once, with its smallest vector. Scores beyond the range of long are the nearest long. An empty
    table, or one without queries, gives no rows. Other columns are read only for `is_query`.
    """
    rows = vectors.select(F.col(key).cast("long").alias("id"), whole_components(F.col(vector)).alias("v"), is_query.alias("asks"))
    rows = rows.where("id IS NOT NULL AND v IS NOT NULL")
    index = Index(rows.select("id", "v"), **options)
    asking = vectors.where(is_query).select(F.col(key).cast("long").alias("query_id")).distinct()
    queries = index.vectors.join(asking, F.col("id") == F.col("query_id"), "left_semi")
    found = index.search(queries.select(F.col("id").alias("query_id"), "v", "cell"), k)
    return found.select("query_id", "rank", F.col("id").alias(key), "score")
