"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items are compared as lower-case words. Items that share a seed, a run of `tile` words, with
a document are tiled against it: the longest common run of unmarked words is found with Karp-Rabin hashes of running
length and marked on both sides, again and again, until no run of `tile` words is left. The share of the item's words
under tiles is its coverage; because tiles may lie in any order, reordered passages are found as well.

The benchmark is taken in blocks of at most `block_words` words. Each block is small enough to be sent to every task
whatever the size of the benchmark; the documents are read once a block and never shuffled.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from tapeglass.llm.common import staged

TILE = 5
COVERAGE = 0.5
BLOCK_WORDS = 2_000_000
WORDS = re.compile(r"\w+").findall
BASE = 0x9E3779B97F4A7C15


def words_of(text: str | None) -> list[str]:
    return WORDS((text or "").lower())


class RunHashes:
    """Karp-Rabin hashes, modulo 2**64, of all runs of any length of a sequence of word numbers.

    A run's hash is the sum of its mixed numbers times the powers of BASE, counted from the run's first word: the
    difference of two prefix sums, moved to the front by a power of the inverse.
    """

    def __init__(self, numbers: np.ndarray):
        mixed = (numbers.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(29)
        size = len(numbers)
        powers = np.full(size, BASE, np.uint64)
        powers[:1] = 1
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed * np.cumprod(powers, dtype=np.uint64), dtype=np.uint64)])
        back = np.full(size + 1, pow(BASE, -1, 1 << 64), np.uint64)
        back[0] = 1
        self.back = np.cumprod(back, dtype=np.uint64)

    def runs(self, length: int) -> np.ndarray:
        starts = max(0, len(self.sums) - length)
        return (self.sums[length:] - self.sums[:starts]) * self.back[:starts]


def _free(marked: np.ndarray, length: int) -> np.ndarray:
    """Where runs of `length` unmarked words begin."""
    before = np.concatenate([[0], np.cumsum(marked)])
    return np.flatnonzero(before[length:] == before[: max(0, len(before) - length)])


def tiles(item: np.ndarray, doc: np.ndarray, tile: int) -> list[tuple[int, int, int]]:
    """(item position, document position, length) of the greedy tiling, longest tiles first.

    Of equally long runs the first in the item goes to the first free place in the document.
    """
    shortest = max(1, min(tile, len(item)))
    item_runs, doc_runs = RunHashes(item), RunHashes(doc)
    item_marked, doc_marked = np.zeros(len(item), bool), np.zeros(len(doc), bool)
    found: list[tuple[int, int, int]] = []
    longest = min(len(item), len(doc))

    def common(length: int):
        """Starts of free runs of this length on both sides whose hashes meet."""
        a, b = _free(item_marked, length), _free(doc_marked, length)
        x, y = item_runs.runs(length)[a], doc_runs.runs(length)[b]
        return a[np.isin(x, y)], b[np.isin(y, x)]

    while longest >= shortest:
        low, high, starts = shortest - 1, longest, None
        while low < high:  # the greatest length at which a common run is left
            middle = (low + high + 1) // 2
            tried = common(middle)
            if len(tried[0]):
                low, starts = middle, tried
            else:
                high = middle - 1
        if low < shortest or starts is None:
            break
        places = defaultdict(list)
        doc_hashes = doc_runs.runs(low)
        for b in starts[1].tolist()[::-1]:
            places[int(doc_hashes[b])].append(b)
        item_hashes, marked = item_runs.runs(low), False
        for a in starts[0].tolist():
            if item_marked[a : a + low].any():
                continue
            at = places[int(item_hashes[a])]
            while at:
                b = at[-1]
                if doc_marked[b : b + low].any() or not np.array_equal(item[a : a + low], doc[b : b + low]):
                    at.pop()
                    continue
                item_marked[a : a + low] = doc_marked[b : b + low] = True
                found.append((a, b, low))
                marked = True
                break
        longest = low if marked else low - 1
    return found


class Block:
    """Items of one block and the hashes of their seeds."""

    def __init__(self, items: list[tuple[int, str]], tile: int):
        self.tile = tile
        self.number: dict[str, int] = {}
        self.items: dict[int, np.ndarray] = {}
        seeds = defaultdict(lambda: defaultdict(set))  # by length: hash -> items
        for at, (_, text) in enumerate(items):
            own = np.array([self.number.setdefault(w, len(self.number)) for w in words_of(text)], np.int64)
            self.items[at] = own
            length = min(tile, len(own))
            if length:
                for h in RunHashes(own).runs(length).tolist():
                    seeds[length][h].add(at)
        self.ids = [i for i, _ in items]
        self.seeds = {length: (np.array(sorted(own), np.uint64), dict(own)) for length, own in seeds.items()}

    def matches(self, text: str | None, coverage: float) -> list[tuple[int | None, int, int, float, list]]:
        """(item, words under tiles, words of the item, coverage, tiles) of all items covered that far."""
        get = self.number.get
        numbers = np.array([get(w, -1) for w in words_of(text)], np.int64)
        unknown, candidates = numbers < 0, set()
        if not self.seeds or not len(_free(unknown, min(self.seeds))):
            return []
        hashes = RunHashes(numbers)
        for length, (known, items) in self.seeds.items():
            starts = _free(unknown, length)
            if len(starts):
                runs = hashes.runs(length)[starts]
                places = np.minimum(np.searchsorted(known, runs), len(known) - 1)
                for h in np.unique(runs[known[places] == runs]).tolist():
                    candidates |= items[h]
        if not candidates:
            return []
        found = []
        for at in sorted(candidates):
            item = self.items[at]
            own = tiles(item, numbers, self.tile)
            under = sum(length for _, _, length in own)
            if under >= coverage * len(item):
                found.append((self.ids[at], under, len(item), under / len(item), own))
        return found


def _blocks(benchmark: DataFrame, key: str, text: str, block_words: int):
    """(items, whether it is the last) of the benchmark in blocks, one at a time on the driver."""
    size = F.size(F.split(F.coalesce(F.col(text), F.lit("")), r"\W+"))
    numbered = benchmark.select(F.col(key).cast("long").alias("item_id"), F.col(text).alias("text"), size.alias("words"))
    total = numbered.agg(F.sum("words")).first()[0] or 0
    group = F.pmod(F.xxhash64("item_id", "text"), F.lit(16 * (1 + total // block_words)))
    sizes = numbered.groupBy(group.alias("g")).agg(F.sum("words").alias("words"))
    running = F.sum("words").over(Window.orderBy("g").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    blocks: dict[int, list[int]] = defaultdict(list)
    for row in sizes.select("g", F.floor((running - 1) / block_words).alias("block")).collect():
        blocks[row["block"]].append(row["g"])
    for number, groups in enumerate(blocks.values(), 1):
        rows = numbered.where(group.isin(groups)).select("item_id", "text").distinct().collect()
        yield sorted(((r["item_id"], r["text"]) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")), number == len(blocks)


def contaminated(
    docs: DataFrame, benchmark: DataFrame, tile: int = TILE, coverage: float = COVERAGE,
    block_words: int = BLOCK_WORDS, doc_key: str = "doc_id", item_key: str = "item_id", text: str = "text",
) -> DataFrame:
    """Pairs of a document and a benchmark item that it covers at least to `coverage`.

    Columns: doc_id, item_id, tiled_words, item_words, coverage, tiles (item position, document position, length).
    Items shorter than `tile` words must occur whole; items and documents without words match nothing. NULL texts
    count as empty, NULL ids are reported as NULL, repeated documents each give their rows, repeated items one.
    An empty documents or benchmark table gives no rows. No column but key and text is read.
    """
    import pyarrow as pa

    place = pa.struct([("item_at", pa.int32()), ("doc_at", pa.int32()), ("length", pa.int32())])
    arrow = pa.schema([
        ("doc_id", pa.int64()), ("item_id", pa.int64()), ("tiled_words", pa.int32()), ("item_words", pa.int32()),
        ("coverage", pa.float64()), ("tiles", pa.list_(place)),
    ])
    schema = (
        "doc_id long, item_id long, tiled_words int, item_words int, coverage double, "
        "tiles array<struct<item_at:int,doc_at:int,length:int>>"
    )

    def matcher(items: list[tuple[int, str]]):
        def run(batches):
            block = Block(items, tile)
            for batch in batches:
                found = []
                for key, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                    for item, under, size, share, own in block.matches(body.as_py(), coverage):
                        at = [{"item_at": a, "doc_at": b, "length": n} for a, b, n in own]
                        found.append(dict(zip(arrow.names, (key, item, under, size, share, at))))
                yield pa.RecordBatch.from_pylist(found, schema=arrow)

        return run

    rows = docs.select(F.col(doc_key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = docs.sparkSession.createDataFrame([], schema)
    blocks = _blocks(benchmark, item_key, text, block_words)
    for number, (items, last) in enumerate(blocks):
        pairs = rows.mapInArrow(matcher(items), schema)
        # The driver holds one block at a time: what earlier blocks found is written before the next one is read.
        found = found.union(pairs if last and not number else staged(pairs, "tiles"))
    return found


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, tile: int = TILE, coverage: float = COVERAGE,
    block_words: int = BLOCK_WORDS, item_key: str = "item_id", text: str = "text",
) -> DataFrame:
    """The rows of `docs` that cover no benchmark item to `coverage`, with all their columns as they are.

    NULL and empty texts cover nothing and stay; repeated documents are judged alike, texts whole however long. An empty
    benchmark keeps all rows, an empty table has none.
    """

    def keeper(items: list[tuple[int, str]]):
        def run(batches):
            import pyarrow as pa

            block = Block(items, tile)
            for batch in batches:
                clean = [not block.matches(body.as_py(), coverage) for body in batch.column(text)]
                yield batch.filter(pa.array(clean, pa.bool_()))

        return run

    for items, last in _blocks(benchmark, item_key, text, block_words):
        kept = docs.mapInArrow(keeper(items), docs.schema)
        docs = kept if last else staged(kept, "decontaminated")
    return docs
