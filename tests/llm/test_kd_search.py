"""KD-tree search against all products."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapeglass.llm import kd_search, queries
from tests.compare import connect

SF_DIR = "/root/testdata/sf0.01"


def plain_search(rows, asks, k):
    """{query: [(score, id)]} of (id, vector) rows."""

    def whole(vector):
        if vector is None or any(x is None or not math.isfinite(x) for x in vector):
            return None
        return [math.floor(64 * float(x)) for x in vector]

    known = [(i, whole(v)) for i, v in rows if i is not None]
    known = [(i, v) for i, v in known if v is not None]
    found = {}
    for i, v in known:
        if asks(i):
            first = min(w for j, w in known if j == i)
            scored = sorted((-sum(a * b for a, b in zip(first, w)), j) for j, w in known if j != i)
            found[i] = [(-s, j) for s, j in scored[:k]]
    return {i: hits for i, hits in found.items() if hits}


def hits(df, key="vec_id"):
    made = {}
    for r in df.collect():
        made.setdefault(r["query_id"], []).append((r["rank"], r["score"], r[key]))
    for own in made.values():
        own.sort()
        assert [rank for rank, *_ in own] == list(range(1, len(own) + 1))
    return {i: [(s, j) for _, s, j in own] for i, own in made.items()}


def test_query(spark):
    rows = connect(SF_DIR).execute("SELECT vec_id, embedding FROM embeddings").fetchall()
    assert hits(queries.queries()["op13_nearest"](spark, SF_DIR)) == plain_search(rows, lambda i: i % 20 == 0, 20)


SCHEMA = "vec_id long, embedding array<float>"


def clashing(df):
    return df.withColumns({name: F.lit("x") for name in ("id", "v", "cell", "shard", "query_id", "kth", "salt", "tree", "score")})


@pytest.mark.parametrize(("shard_rows", "leaf_rows"), [(4096, 128), (40, 5), (7, 1)])
def test_shards_cells_and_rounds(spark, shard_rows, leaf_rows):
    """Many cells, a vector that a third of all rows hold, and ties."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 8))
    vectors = [(centres[i % 6] + 0.2 * rng.normal(size=8)) if i % 3 else np.full(8, 0.5) for i in range(420)]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    made = kd_search.top_products(df, F.col("vec_id") % 10 == 0, 9, shard_rows=shard_rows, leaf_rows=leaf_rows, sample=100)
    assert hits(made) == plain_search(rows, lambda i: i % 10 == 0, 9)


def test_edges(spark):
    big = 1e30
    rows = [
        (0, [1.0, -0.5]), (20, [0.25, 0.25]), (20, [0.25, 0.25]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 0.0]),
        (None, [1.0, 1.0]), (5, []), (6, [2.0]), (7, [-0.001, 3.0]), (40, None), (60, [1.0, 2.0, 3.0]),
    ]
    df = clashing(spark.createDataFrame(rows, SCHEMA))
    asks = F.col("vec_id") % 20 == 0
    assert hits(kd_search.top_products(df, asks, 4)) == plain_search(rows, lambda i: i % 20 == 0, 4)
    assert kd_search.top_products(df.where("1 = 0"), asks, 4).collect() == []
    assert kd_search.top_products(df, F.lit(False), 4).collect() == []
    assert kd_search.top_products(df.where("vec_id = 0"), asks, 4).collect() == []
    huge = clashing(spark.createDataFrame([(0, [big, 1.0]), (1, [big, 0.0]), (2, [-big, 0.0]), (3, [0.5, 0.0])], SCHEMA))
    found = hits(kd_search.top_products(huge, F.col("vec_id") == 0, 3))
    assert [j for _, j in found[0]] == [1, 3, 2]
    assert (found[0][0][0], found[0][2][0]) == (2**63 - 1, -(2**63))


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(0)
    vectors = np.floor(64 * np.concatenate([rng.normal(c, 0.05, (300, 6)) for c in (-1, 0, 1)]))
    ids = np.arange(len(vectors))
    tree = kd_search.Tree(ids, vectors, 10)
    query = vectors[5:6]
    bounds = tree.bounds(query)[0]
    for node, (start, end) in enumerate(tree.span):
        assert (tree.vectors[start:end] @ query[0]).max() <= bounds[node]
    scores, found = tree.best(query[0], 5, bounds, 3, None)
    least = scores.min()
    assert sum(b >= least for b, child in zip(bounds, tree.child) if not child) < 0.5 * sum(not c for c in tree.child)
    again, same = tree.best(query[0], 5, bounds, 3, least)
    assert sorted(again) == sorted(scores) and set(same) == set(found)
