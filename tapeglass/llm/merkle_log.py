"""Merkle manifest of a dataset, kept as a postorder append log.

Leaves are numbered along the order of their tree and dealt to aligned builders: a builder takes `ARITY ** BLOCK_LEVELS`
consecutive leaves from a multiple of that number on, so the nodes above them belong to it alone. It appends every node
to the log when its last child is there, which is postorder. The tops of a level of blocks are the leaves of the next
level of builders, until one node remains. A node's place in the log has a closed form in its level, its index and the
number of leaves, so siblings are found without links between nodes.

Proofs go down the same blocks: a block gets the path above its top in one row, and the paths of its own nodes follow
from the part of the log it wrote. No task holds more than one block, no tree passes through one task, and the work of
a tree of any height is one pass over its blocks and one over the far fewer tops of each level of blocks.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tapeglass.llm.common import ranges, staged

ARITY = 8
BLOCK_LEVELS = 3
RANGE_ROWS = 50_000
#: The one tree over the tops of all other trees.
ALL = ""


def digest_of(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_digest(*values: Column) -> Column:
    """SHA-256 of the values, each with its length in bytes before it, so that no two rows give the same input."""
    texts = [v.cast("string") for v in values]
    framed = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*framed).cast("binary"), 256)


def height(leaves: int) -> int:
    """Levels above the leaves; a lone leaf is the top itself."""
    levels = 0
    while leaves > 1:
        leaves, levels = -(-leaves // ARITY), levels + 1
    return levels


def width(level: int, leaves: int) -> int:
    """Nodes of a level."""
    return -(-leaves // ARITY**level)


def position(level: int, index: int, leaves: int) -> int:
    """Place in the log, from 0, of a node of a tree over so many leaves.

    Before a node stand all nodes of its own level and below that cover leaves up to its last one, and the nodes of higher
    levels that cover leaves before its first one only.
    """
    first, end = index * ARITY**level, min((index + 1) * ARITY**level, leaves)
    within = sum(-(-end // ARITY**below) for below in range(level + 1))
    return within - 1 + sum(first // ARITY**above for above in range(level + 1, height(leaves) + 1))


def siblings(index: int, leaves: int) -> list[tuple[int, list[int], list[int]]]:
    """(level, places in the log of the siblings before, of those after) for every level from a leaf to the top."""
    found = []
    for level in range(height(leaves)):
        own = index // ARITY**level
        run = range(own - own % ARITY, min(own - own % ARITY + ARITY, width(level, leaves)))
        places = [[position(level, i, leaves) for i in run if (i < own) == before and i != own] for before in (True, False)]
        found.append((level, *places))
    return found


def _completed(base: int, first: int, digests: Iterator[str], leaves: int) -> Iterator[tuple[int, int, str]]:
    """(level, index, digest) of a block's nodes in the order in which they complete; the block starts at node `first`
    of level `base`."""
    top = min(base + BLOCK_LEVELS, height(leaves))
    runs: list[list[str]] = [[] for _ in range(top - base + 1)]
    for index, digest in enumerate(digests, first):
        level = base
        yield level, index, digest
        runs[0].append(digest)
        while level < top and (index % ARITY == ARITY - 1 or index == width(level, leaves) - 1):
            digest = digest_of("".join(runs[level - base]))
            runs[level - base].clear()
            level, index = level + 1, index // ARITY
            yield level, index, digest
            runs[level - base].append(digest)


def _grouped(batches, width_of_key: int):
    """(key, rows) of consecutive rows with the same leading columns; a block's rows are held at a time."""
    rows = (row for batch in batches for row in zip(*(column.to_pylist() for column in batch.columns)))
    return itertools.groupby(rows, key=lambda row: row[:width_of_key])


def _arrow(schema: str):
    return to_arrow_schema(StructType.fromDDL(schema))


def _batches(rows: Iterator[tuple], schema, at_once: int = 4096):
    import pyarrow as pa

    while few := list(itertools.islice(rows, at_once)):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*few), schema)], schema=schema)


def numbered(leaves: DataFrame, order: list[str]) -> DataFrame:
    """`leaves` with `index`, the place of a row in its `tree` along `order`, and `leaves`, the rows of the tree.

    Rows are dealt in ranges of (tree, order), so a tree of nearly all rows is no task of its own. Columns of `order` must
    tell all rows apart but those that may change places.
    """
    rows = staged(leaves, "merkle-leaves")
    dealt = rows.repartitionByRange(ranges(rows.count(), RANGE_ROWS), "tree", *order).sortWithinPartitions("tree", *order)
    placed = staged(dealt.withColumn("_at", F.monotonically_increasing_id()), "merkle-ranges")
    placed = placed.withColumn("_range", F.shiftright("_at", 33))
    runs = placed.groupBy("tree", "_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    tree = Window.partitionBy("tree")
    before = F.sum("_rows").over(tree.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select("tree", "_range", "_first", F.coalesce(before, F.lit(0)).alias("_before"), F.sum("_rows").over(tree).alias("leaves"))
    index = F.col("_at") - F.col("_first") + F.col("_before")
    return placed.join(runs, ["tree", "_range"]).withColumn("index", index).drop("_at", "_range", "_first", "_before")


@dataclass(frozen=True)
class Log:
    """`nodes`: (tree, position, level, index, digest, leaves, block, carried columns of leaves) by level of builders."""

    nodes: list[DataFrame]
    carried: list[str]

    def all_nodes(self) -> DataFrame:
        whole = self.nodes[0]
        for more in self.nodes[1:]:
            whole = whole.unionByName(more)
        return whole

    def tops(self) -> DataFrame:
        """(tree, digest, leaves) of every tree's top."""
        return self.all_nodes().where("is_top").select("tree", "digest", "leaves")


def append_log(leaves: DataFrame, order: list[str], carried: list[str] = ()) -> Log:
    """The log of every tree of (tree string, digest string, order and carried columns) leaves.

    NULL trees are not allowed; equal rows of `order` take any order. `carried` columns stay with the leaves' nodes.
    An empty table gives an empty log.
    """
    carried = list(carried)
    kinds = dict(leaves.dtypes)
    schema = "tree string, block long, position long, level int, index long, digest string, leaves long, is_top boolean"
    schema += "".join(f", `{c}` {kinds[c]}" for c in carried)
    arrow = _arrow(schema)
    rows = staged(numbered(leaves, order).select("tree", "index", "digest", "leaves", *carried), "merkle-numbered")
    largest = rows.agg(F.max("leaves")).first()[0] or 0
    nothing = (None,) * len(carried)
    base, made = 0, []

    while True:
        def run(batches, base=base):
            def nodes():
                for (tree, block), group in _grouped(batches, 2):
                    held = list(group)
                    total = held[0][4]
                    top = height(total)
                    extra = {row[2]: row[5:] for row in held}
                    for level, index, digest in _completed(base, held[0][2], (row[3] for row in held), total):
                        if base and level == base:
                            continue  # written by the builders below
                        own = extra[index] if level == 0 else nothing
                        yield (tree, block, position(level, index, total), level, index, digest, total, level == top, *own)

            yield from _batches(nodes(), arrow)

        per_block = ARITY**BLOCK_LEVELS
        cut = rows.select("tree", F.floor(F.col("index") / per_block).cast("long").alias("block"), "index", "digest", "leaves", *carried)
        dealt = cut.repartition("tree", "block").sortWithinPartitions("tree", "block", "index")
        written = staged(dealt.mapInArrow(run, schema), "merkle-log")
        made.append(written)
        base += BLOCK_LEVELS
        if ARITY**base >= largest:
            return Log(made, carried)
        none = [F.lit(None).cast(kinds[c]).alias(c) for c in carried]
        tops = written.where((F.col("level") == base) & ~F.col("is_top"))
        rows = tops.select("tree", "index", "digest", "leaves", *none)


def _paths(log: Log, base: int, above: DataFrame) -> DataFrame:
    """(tree, index, left, right, top, leaves, carried columns) of the nodes of level `base`, from (tree, block, left,
    right, top) rows: the paths above the tops of their blocks. left and right hold what stands before and after the
    node in its run, level by level."""
    carried = log.carried
    below = log.nodes[base // BLOCK_LEVELS].where(F.col("level") < base + BLOCK_LEVELS)
    if base:
        # The builders' leaves were written by the builders below them.
        leaf = log.nodes[base // BLOCK_LEVELS - 1].where((F.col("level") == base) & ~F.col("is_top"))
        below = below.unionByName(leaf.withColumn("block", F.floor(F.col("index") / ARITY**BLOCK_LEVELS).cast("long")))
    kinds = dict(below.dtypes)
    columns = ["tree", "block", "position", "level", "index", "digest", "leaves", *carried]
    stream = below.select(*columns).unionByName(above.withColumn("position", F.lit(-1).cast("long")), allowMissingColumns=True)
    schema = "tree string, index long, left array<string>, right array<string>, top string, leaves long, digest string"
    schema += "".join(f", `{c}` {kinds[c]}" for c in carried)
    held_columns, arrow = [*columns, "left", "right", "top"], _arrow(schema)

    def run(batches):
        def leaves_of_block(tree, group):
            first = next(group)
            lefts, rights, top = first[-3:]
            at, own = {}, []
            for row in group:
                at[row[2]] = row[5]
                if row[3] == base:
                    own.append(row)
            total = own[0][6]
            # What stands beside a node is put together once for every level of the block.
            beside: dict[tuple[int, int], tuple[str, str]] = {}
            levels = range(base, min(base + BLOCK_LEVELS, height(total)))
            low, high = own[0][4], own[-1][4]
            for level in levels:
                scale = ARITY ** (level - base)
                for start in range(low // scale - low // scale % ARITY, high // scale + 1, ARITY):
                    run_of = range(start, min(start + ARITY, width(level, total)))
                    digests = [at[position(level, i, total)] for i in run_of]
                    for k, i in enumerate(run_of):
                        beside[level, i] = "".join(digests[:k]), "".join(digests[k + 1 :])
            for row in own:
                parts = [beside[level, row[4] // ARITY ** (level - base)] for level in levels]
                left, right = ([*(p[k] for p in parts), *more] for k, more in ((0, lefts), (1, rights)))
                yield (tree, row[4], left, right, top, total, row[5], *row[7 : 7 + len(carried)])

        rows = (row for (tree, _), group in _grouped(batches, 2) for row in leaves_of_block(tree, group))
        yield from _batches(rows, arrow, 512)

    dealt = stream.select(*held_columns).repartition("tree", "block").sortWithinPartitions("tree", "block", "position")
    return dealt.mapInArrow(run, schema)


def proofs(log: Log, above: DataFrame | None = None) -> DataFrame:
    """(tree, index, left, right, top, leaves, digest, carried columns) of every leaf: its proof up to its tree's top.

    With (tree, left, right, top) rows in `above`, proofs go on from there, to a top that several trees share.
    """
    tops = log.tops()
    none = F.array().cast("array<string>")
    if above is None:
        above = tops.select("tree", none.alias("left"), none.alias("right"), F.col("digest").alias("top"))
    # The level of builders that made a tree's top; a tree of few leaves has one.
    starts = above.join(tops.select("tree", "leaves"), "tree")
    made = None
    for step in range(len(log.nodes) - 1, -1, -1):
        here = F.col("leaves") > ARITY ** (BLOCK_LEVELS * step) if step else F.lit(True)
        beyond = F.col("leaves") > ARITY ** (BLOCK_LEVELS * (step + 1))
        paths = starts.where(here & ~beyond).select("tree", F.lit(0).cast("long").alias("block"), "left", "right", "top")
        if made is not None:
            paths = paths.unionByName(made.select("tree", F.col("index").alias("block"), "left", "right", "top"))
        made = _paths(log, step * BLOCK_LEVELS, paths)
        if step:
            made = staged(made, "merkle-paths")
    return made


def extracted(log: Log, wanted: DataFrame) -> DataFrame:
    """(tree, index, level, sibling, digest) of the siblings of a few (tree, index) leaves, read from the log by place.

    Only the wanted places are joined with the log, whose size does not matter. Leaves that no tree has give no rows;
    repeated ones count once.
    """
    asked = wanted.select("tree", "index").distinct().join(log.tops().select("tree", "leaves"), "tree")
    schema = "tree string, index long, level int, position long"
    arrow = _arrow(schema)

    def run(batches):
        def places():
            for batch in batches:
                for tree, index, leaves in zip(*(c.to_pylist() for c in batch.columns)):
                    if not 0 <= index < leaves:
                        continue
                    for level, before, after in siblings(index, leaves):
                        for place in (*before, *after):
                            yield tree, index, level, place

        yield from _batches(places(), arrow)

    places = asked.mapInArrow(run, schema)
    nodes = log.all_nodes().select("tree", "position", F.col("index").alias("sibling"), "digest")
    return places.join(nodes, ["tree", "position"]).select("tree", "index", "level", "sibling", "digest")


def folded(digest: Column, left: Column, right: Column) -> Column:
    """The top that a leaf's digest and its proof give."""
    runs = F.arrays_zip(left.alias("left"), right.alias("right"))
    return F.aggregate(runs, digest, lambda own, run: F.sha2(F.concat(run["left"], own, run["right"]).cast("binary"), 256))


def proof_digest(left: Column, right: Column) -> Column:
    """SHA-256 of all siblings, level by level from the leaf to the top, left to right."""
    return F.sha2(F.array_join(F.zip_with(left, right, lambda a, b: F.concat(a, b)), "").cast("binary"), 256)


def manifest(docs: DataFrame, columns: list[str], tree: str = "lang", key: str = "doc_id", carried: dict[str, Column] | None = None) -> DataFrame:
    """(key, leaf, subroot, root, left, right, carried columns) of every row of `docs`: its leaf and its proof up to the
    root over all trees, one for each value of the column `tree`.

    A leaf is the digest of `columns` in that order. NULL trees come first, NULL keys first in their tree; rows with the
    same key are ordered by their leaf, so repeated rows are leaves each. A lone row is its tree's top, a lone tree's top
    the root. An empty table gives no rows. Other columns are not read but those in `carried`.
    """
    more = carried or {}
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("+"), F.col(tree).cast("string")), F.lit("")).alias("tree"), F.col(key).alias("key"),
        leaf_digest(*(F.col(c) for c in columns)).alias("digest"),
        # Equal leaves of equal keys may change places, but must not all land in one range.
        F.monotonically_increasing_id().alias("tie"), *(c.alias(f"carried_{name}") for name, c in more.items()),
    )
    names = [f"carried_{name}" for name in more]
    log = append_log(leaves, ["key", "digest", "tie"], ["key", *names])
    tops = log.tops().select(F.lit(ALL).alias("tree"), F.col("tree").alias("name"), "digest")
    over = proofs(append_log(tops, ["name"], ["name"]))
    above = over.select(F.col("name").alias("tree"), "left", "right", F.struct(F.col("digest").alias("subroot"), F.col("top").alias("root")).alias("tops"))
    # A path's last column is one string: both digests, of 64 characters each.
    above = staged(above.select("tree", "left", "right", F.concat("tops.subroot", "tops.root").alias("top")), "merkle-tops")
    return proofs(log, above).select(
        F.col("key").alias(key), F.col("digest").alias("leaf"), F.substring("top", 1, 64).alias("subroot"),
        F.substring("top", 65, 64).alias("root"), "left", "right", *(F.col(n).alias(n.removeprefix("carried_")) for n in names),
    )
