"""Placing documents in shards with a hierarchical weighted hash tree.

A document descends from the root to a region, a rack and a shard. At each node every child draws an exponential
value from the hash of (document key, child path), divided by the child's weight, and the smallest draw wins. A draw
depends on nothing but its own child, so a changed weight moves documents only into or out of the subtrees on the
path of that weight; a shard added as a region of its own takes documents and no other shard receives any.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

BLOCKS = 4096
LEVELS = ("region", "rack", "shard")


@dataclass(frozen=True)
class Shard:
    region: str
    rack: str
    number: int
    weight: float = 1.0

    @property
    def path(self) -> tuple[str, str, str]:
        return (self.region, f"{self.region}/{self.rack}", f"{self.region}/{self.rack}/{self.number}")


def uniform_tree(shards: int, per_rack: int = 2, racks_per_region: int = 2) -> list[Shard]:
    """`shards` equal shards, numbered from 0 and laid out rack after rack."""
    racks = [n // per_rack for n in range(shards)]
    return [Shard(f"region{r // racks_per_region}", f"rack{r}", n) for n, r in enumerate(racks)]


def grown(tree: list[Shard], weight: float = 1.0) -> list[Shard]:
    """The tree with one more shard, in a region of its own, so that only that shard receives documents."""
    number = max((s.number for s in tree), default=-1) + 1
    return [*tree, Shard(f"region-of-{number}", "rack0", number, weight)]


def _children(tree: list[Shard]) -> dict[str, dict[str, float]]:
    """Child paths and their summed weights by parent path; the root is the empty path."""
    found: dict[str, dict[str, float]] = defaultdict(lambda: defaultdict(float))
    for shard in tree:
        for parent, child in zip(("", *shard.path), shard.path):
            found[parent][child] += shard.weight
    return found


def place(key: Column, tree: list[Shard]) -> Column:
    """The path of the shard that takes a key, like `region0/rack1/3`. Equal keys share a shard; NULL counts as ''."""
    if not tree or any(s.weight <= 0 for s in tree):
        raise ValueError("a tree needs shards, all of positive weight")
    nodes = F.create_map(*[
        x
        for parent, children in _children(tree).items()
        for x in (
            F.lit(parent),
            F.array(*[F.struct(F.lit(c).alias("path"), F.lit(w).alias("weight")) for c, w in children.items()]),
        )
    ])
    text = F.coalesce(key.cast("string"), F.lit(""))

    def draw(child: Column) -> Column:
        bits = F.conv(F.substring(F.md5(F.concat_ws("|", text, child["path"])), 1, 13), 16, 10).cast("double")
        return F.struct((-F.log((bits + 0.5) / 2.0**52) / child["weight"]).alias("draw"), child["path"].alias("path"))

    node = F.lit("")
    for _ in LEVELS:
        node = F.array_min(F.transform(nodes[node], draw))["path"]
    return node


def shard_number(path: Column) -> Column:
    return F.substring_index(path, "/", -1).cast("int")


def with_slots(placed: DataFrame, shard: str, key: str, ties: list[str]) -> DataFrame:
    """Number the rows of every shard without gaps from 0, in the column `slot`.

    Keys are dealt to BLOCKS hash blocks; rows are numbered inside (shard, block) and shifted by the rows of the
    shard's earlier blocks. Their counts, at most shards x BLOCKS rows, are broadcast.
    """
    block = F.conv(F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))), 1, 3), 16, 10).cast("int")
    rows = placed.withColumn("_block", block)
    earlier = Window.partitionBy(shard).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(shard, "_block").agg(F.count(F.lit(1)).alias("_rows"))
    shifts = counts.select(shard, "_block", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_shift"))
    inside = F.row_number().over(Window.partitionBy(shard, "_block").orderBy(key, *ties))
    return (
        rows.withColumn("_row", inside)
        .join(F.broadcast(shifts), [shard, "_block"])
        .withColumn("slot", F.col("_shift") + F.col("_row") - 1)
        .drop("_block", "_row", "_shift")
    )


def shard_documents(docs: DataFrame, tree: list[Shard], key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, size, text_crc32, law, region, rack, shard, grown_shard and slot.

    size is the UTF-8 bytes of the text plus 1 (NULL: 1) and text_crc32 the CRC-32 of those bytes (NULL: of none).
    grown_shard is the place after `grown(tree)`. Only the key and the tree decide: equal keys share a shard,
    a NULL key counts as '', repeated rows are all kept and numbered, an empty table gives an empty result, and
    other columns of `docs` are not read.
    """
    bytes_ = F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")
    placed = docs.select(
        F.col(key),
        (F.octet_length(bytes_) + 1).cast("long").alias("size"),
        F.crc32(bytes_).alias("text_crc32"),
        F.lit("key").alias("law"),
        place(F.col(key), tree).alias("_path"),
        shard_number(place(F.col(key), grown(tree))).alias("grown_shard"),
    )
    located = placed.select(
        key, "size", "text_crc32", "law",
        shard_number(F.col("_path")).alias("shard"),
        "grown_shard",
        F.substring_index("_path", "/", 1).alias("region"),
        F.substring_index("_path", "/", 2).alias("rack"),
    )
    return with_slots(located, "shard", key, ["size", "text_crc32"])


def write_shards(docs: DataFrame, tree: list[Shard], path: str, key: str = "doc_id") -> None:
    """Write whole documents into one folder per region, rack and shard."""
    route = F.split(place(F.col(key), tree), "/")
    levels = {f"shard_{name}": route[i] for i, name in enumerate(LEVELS)}
    docs.withColumns(levels).write.partitionBy(*levels).parquet(path)
