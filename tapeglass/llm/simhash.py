"""Near-duplicate documents by SimHash and the generalised pigeonhole principle.

Distinct fingerprints are cut into PARTS groups of correlated bits. If two of them differ in at most `distance` bits
and the thresholds of the groups add up to distance - PARTS + 1, then in some group they differ by no more than its
threshold. Each fingerprint gets its own thresholds: dynamic programming takes those with the fewest expected
candidates, from the number of fingerprints by value of each group. It then probes the values within each threshold,
and candidates are verified with the whole distance.

Values that more than `bucket` fingerprints share are not probed. The fingerprints that have or would probe such a
value are linked through midpoints instead: two of them differ in at most `distance` bits exactly if they share a
fingerprint within half the distance of both, and those are linear in number.
"""

from __future__ import annotations

import itertools
import math
from functools import cached_property

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tapeglass.llm.common import staged, unused
from tapeglass.llm.components import components

BITS = 64
BUCKET = 2048
SEED = 42
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Values of a group are counted exactly up to this many bits and by independent halves above.
COUNTED_BITS = 16
#: Rows that a task makes of fingerprints at a time.
CHUNK_ROWS = 1 << 16


def simhash(text: str | None, shingle: int) -> int:
    """The fingerprint of a text: A-Z lower-cased, ASCII white space separates words, shingles keep repeats."""
    import xxhash

    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        ends = np.cumsum(sizes)
        starts = (ends - sizes)[: len(words) - shingle + 1].tolist()
        stops = (ends - 1)[shingle - 1 :].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, stops)]
    raw = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    ones = sum(np.unpackbits(raw[i : i + 4096], axis=1, bitorder="little").sum(axis=0, dtype=np.int64) for i in range(0, len(raw), 4096))
    return int(np.packbits(2 * ones > len(raw), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp long) of every row."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            found = np.array([simhash(t.as_py(), shingle) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], ["doc_id", "fp"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def bit_groups(together: np.ndarray, ones: np.ndarray, count: int, parts: int) -> list[list[int]]:
    """Equal groups of bits, each grown from the bit that correlates most with the bits it holds.

    together: how many fingerprints have both bits set, ones: how many have the bit set, count: how many there are.
    """
    share = ones / max(1, count)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    linked = np.abs((together / max(1, count) - np.outer(share, share)) / np.outer(spread, spread))
    np.fill_diagonal(linked, 0)
    free, groups = set(range(BITS)), []
    for part in range(parts):
        size = len(free) // (parts - part)
        own = [min(free, key=lambda b: (-linked[b, sorted(free)].sum(), b))]
        free.discard(own[0])
        while len(own) < size:
            own.append(min(free, key=lambda b: (-linked[b, own].sum(), b)))
            free.discard(own[-1])
        groups.append(sorted(own))
    return groups


def _pick(fp: Column, bits: list[int]) -> Column:
    """The given bits of a fingerprint, the first one lowest."""
    taken = [F.shiftleft(F.shiftrightunsigned(fp, b).bitwiseAND(F.lit(1).cast("long")), i) for i, b in enumerate(bits)]
    return sum(taken[1:], taken[0])


def _pick_array(fps: np.ndarray, bits: list[int]) -> np.ndarray:
    own = fps.view(np.uint64)
    return sum(((own >> np.uint64(b)) & np.uint64(1)).astype(np.int64) << i for i, b in enumerate(bits))


def _within(counts: np.ndarray, most: int) -> np.ndarray:
    """For every value, how many fingerprints differ from it in exactly 0, 1 .. most bits of the group."""
    width = len(counts).bit_length() - 1
    rings = [counts] + [np.zeros_like(counts) for _ in range(most)]
    values = np.arange(len(counts))
    for bit in range(width):
        flipped = values ^ (1 << bit)
        rings = [rings[0]] + [rings[r] + rings[r - 1][flipped] for r in range(1, most + 1)]
    return np.stack(rings)


def _flips(width: int, most: int) -> list[np.ndarray]:
    """Masks of exactly 0, 1 .. most flipped bits."""
    return [
        np.array([sum(1 << b for b in own) for own in itertools.combinations(range(width), r)], np.uint64).view(np.int64)
        for r in range(most + 1)
    ]


class Plan:
    """Bit groups, candidate counts by value, and the thresholds that follow from them.

    Only the counts are held and sent to tasks; the counts by distance, several times as large, are made where they are used.
    """

    def __init__(self, groups: list[list[int]], counts: list[list[np.ndarray]], total: int, distance: int, bucket: int):
        self.groups, self.total, self.bucket = groups, total, bucket
        self.budget = distance - len(groups) + 1
        self.most = distance
        self.counts = counts

    @cached_property
    def rings(self) -> list[list[np.ndarray]]:
        return [[_within(c, self.most) for c in own] for own in self.counts]

    @staticmethod
    def halves(bits: list[int]) -> list[list[int]]:
        if len(bits) <= COUNTED_BITS:
            return [bits]
        return [bits[: len(bits) // 2], bits[len(bits) // 2 :]]

    def expected(self, fps: np.ndarray, part: int) -> np.ndarray:
        """Candidates of each fingerprint in a group by threshold 0 .. most, probes included in the cost."""
        halves = self.halves(self.groups[part])
        rings = [r[:, _pick_array(fps, bits)] for r, bits in zip(self.rings[part], halves)]
        if len(rings) == 1:
            exact = rings[0].astype(float)
        else:
            first, second = rings
            exact = np.stack([
                sum(first[i].astype(float) * second[r - i] for i in range(r + 1)) / max(1, self.total)
                for r in range(self.most + 1)
            ])
        probes = np.array([math.comb(len(self.groups[part]), r) for r in range(self.most + 1)], float)
        return np.cumsum(exact + probes[:, None], axis=0)

    def thresholds(self, fps: np.ndarray) -> np.ndarray:
        """Threshold of every group (-1: not probed) for each fingerprint; they add up to the budget."""
        parts, low = len(self.groups), -1
        high = max(0, self.budget + parts - 1)
        # best[s]: least cost of the groups so far when their thresholds add up to s - groups so far.
        best = np.full((1, len(fps)), 0.0)
        chosen = []
        for part in range(parts):
            cost = np.concatenate([np.zeros((1, len(fps))), self.expected(fps, part)])[: high + 2]
            sums = np.full((best.shape[0] + high + 1, len(fps)), np.inf)
            taken = np.zeros(sums.shape, np.int64)
            for s, t in itertools.product(range(best.shape[0]), range(len(cost))):
                value = best[s] + cost[t]
                better = value < sums[s + t]
                sums[s + t][better] = value[better]
                taken[s + t][better] = t
            best = sums
            chosen.append(taken)
        at = np.full(len(fps), self.budget + parts)
        out = np.zeros((parts, len(fps)), np.int64)
        for part in reversed(range(parts)):
            step = chosen[part][at, np.arange(len(fps))]
            out[part] = step + low
            at = at - step
        return out


def _parts(total: int) -> int:
    """Fewer and wider groups for more fingerprints, so that a value stays rare."""
    return 4 if total < 1 << 22 else 3 if total < 1 << 30 else 2


def _columns(df: DataFrame) -> list[np.ndarray]:
    """The columns of a bounded result without NULLs on the driver, never as Python objects."""
    return [column.to_numpy() for column in df.toArrow().columns]


def _plan(fps: DataFrame, distance: int, bucket: int) -> Plan:
    """The driver receives bit counts (64 x 64 a task, added up) and at most 2**16 counts a group or half group."""

    def bits(batches):
        import pyarrow as pa

        both, total = np.zeros((BITS, BITS), np.int64), 0
        for batch in batches:
            raw = batch.column(0).to_numpy(zero_copy_only=False).astype("<i8").view(np.uint8).reshape(-1, 8)
            own = np.unpackbits(raw, axis=1, bitorder="little").astype(np.float32)
            both += np.rint(own.T @ own).astype(np.int64)
            total += len(raw)
        cells = np.arange(BITS * BITS)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(both.ravel())], ["cell", "n"])

    total = fps.count()
    both = np.zeros(BITS * BITS, np.int64)
    cells, ns = _columns(fps.mapInArrow(bits, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")))
    both[cells] = ns
    both = both.reshape(BITS, BITS)
    groups = bit_groups(both, np.diag(both), total, _parts(total))
    halves = [Plan.halves(g) for g in groups]
    counts = [[np.zeros(1 << len(bits), np.int64) for bits in own] for own in halves]
    values = F.explode(F.array(*[
        F.struct(F.lit(p).alias("p"), F.lit(h).alias("h"), _pick(F.col("fp"), bits).alias("v"))
        for p, own in enumerate(halves) for h, bits in enumerate(own)
    ]))
    of_part, of_half, at, ns = _columns(fps.select(values.alias("x")).groupBy("x.p", "x.h", "x.v").count())
    for p, own in enumerate(counts):
        for h, count in enumerate(own):
            mine = (of_part == p) & (of_half == h)
            count[at[mine]] = ns[mine]
    return Plan(groups, counts, total, distance, bucket)


def _midpoint_links(fps: DataFrame, distance: int) -> DataFrame:
    """Links (a, b) that connect exactly the fingerprints within `distance`, through shared midpoints.

    Two fingerprints within the distance share one that is at most half of it, rounded down, from one of them and
    at most the rest from the other. Every fingerprint is linked to the smallest one in the inner radius of each of
    its midpoints; minima are combined before the shuffle.
    """
    inner = distance // 2

    def reach(batches):
        import pyarrow as pa

        flips = _flips(BITS, distance - inner)
        masks, near = np.concatenate(flips), np.repeat(np.arange(len(flips)) <= inner, [len(f) for f in flips])
        most = max(1, CHUNK_ROWS // len(masks))
        for batch in batches:
            for at in range(0, batch.num_rows, most):
                own = batch.column(0).slice(at, most).to_numpy(zero_copy_only=False).astype(np.int64)
                for first in range(0, len(masks), CHUNK_ROWS):
                    some = masks[first : first + CHUNK_ROWS]
                    mids = (own[:, None] ^ some[None, :]).ravel()
                    inside = np.tile(near[first : first + CHUNK_ROWS], len(own))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(own, len(some))), pa.array(mids), pa.array(inside)], ["fp", "mid", "inner"]
                    )

    # In Python: an array of thousands of masks in the plan would be copied and printed again and again on the driver.
    reached = fps.select("fp").mapInArrow(reach, "fp long, mid long, inner boolean")
    least = reached.where("inner").groupBy("mid").agg(F.min("fp").alias("b"))
    # Spark takes what a task makes of a fingerprint for as large as the fingerprint and would send all of it through the
    # driver in a broadcast.
    linked = reached.hint("merge").join(least.hint("merge"), "mid").where("fp != b")
    return linked.select(F.col("fp").alias("a"), "b").distinct()


def links(fps: DataFrame, distance: int, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) of distinct fingerprints that connect all that differ in at most `distance` bits."""
    plan = _plan(fps, distance, bucket)

    def probe(batches):
        import pyarrow as pa

        flips = [_flips(len(g), distance) for g in plan.groups]
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                fps_ = batch.column(0).slice(at, 4096).to_numpy(zero_copy_only=False).astype(np.int64)
                limits = plan.thresholds(fps_)
                for part, bits in enumerate(plan.groups):
                    own = _pick_array(fps_, bits)
                    for limit in range(distance + 1):
                        asked = limits[part] >= limit
                        if not asked.any():
                            continue
                        values = (own[asked][:, None] ^ flips[part][limit][None, :]).ravel()
                        whose = np.repeat(fps_[asked], len(flips[part][limit]))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(values), part, np.int32)), pa.array(values), pa.array(whose)],
                            ["p", "v", "fp"],
                        )

    held = F.explode(F.array(*[
        F.struct(F.lit(p).alias("p"), _pick(F.col("fp"), bits).alias("v")) for p, bits in enumerate(plan.groups)
    ]))
    index = fps.select("fp", held.alias("x")).select("x.p", "x.v", "fp")
    probes = fps.mapInArrow(probe, "p int, v long, fp long")
    crowded = index.groupBy("p", "v").count().where(F.col("count") > bucket).select("p", "v")
    crowded = staged(crowded, "crowded-values")
    if crowded.isEmpty():
        few_index, few_probes, through = index, probes, None
    else:
        few_index = index.join(crowded, ["p", "v"], "left_anti")
        few_probes = probes.join(crowded, ["p", "v"], "left_anti")
        dense = index.union(probes).join(crowded, ["p", "v"], "left_semi").select("fp").distinct()
        through = staged(_midpoint_links(staged(dense, "dense-fingerprints"), distance), "midpoint-links")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    # As in `_midpoint_links`: neither the probes nor the index may be broadcast for the size of their fingerprints.
    found = (
        few_probes.withColumnRenamed("fp", "a").hint("merge")
        .join(few_index.withColumnRenamed("fp", "b").hint("merge"), ["p", "v"])
        .where((F.col("a") < F.col("b")) & near)
        .select("a", "b")
        .distinct()
    )
    return found if through is None else found.union(through)


def near_duplicates(
    docs: DataFrame, shingle: int, distance: int, bucket: int = BUCKET, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, fingerprint, component_id) of every row of `docs`.

    fingerprint is 16 hex digits; component_id is the smallest key reachable over links of at most `distance`
    differing bits, the own key included. NULL and empty texts have fingerprint zero and link like any other. A row
    without a key takes part and gets the smallest key of its component, NULL if there is none. Repeated rows are
    all returned, an empty table gives no rows, other columns are not read.
    """
    prints = staged(fingerprints(docs, shingle, key, text), "fingerprints")
    distinct = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    member = components(links(distinct.select("fp"), distance, bucket))
    labels = distinct.join(member.withColumnRenamed("vertex", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp")
    )
    smallest = labels.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = staged(labels.join(smallest, "component").select("fp", "component_id"), "classes")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return prints.join(classes, "fp").select(F.col("doc_id").alias(key), digits, "component_id")


def without_near_duplicates(
    docs: DataFrame, shingle: int, distance: int, bucket: int = BUCKET, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The row of `docs` with the smallest key of each component, with its columns as they are.

    Rows that repeat that key are the same document and one of them stays. Rows without a key cannot be listed:
    one of each text stays.
    """
    found = near_duplicates(docs, shingle, distance, bucket, key, text)
    name = unused(docs, "kept")
    first = found.where(F.col(key) == F.col("component_id")).select(F.col(key).alias(name)).distinct()
    kept = docs.join(first, F.col(key) == F.col(name)).dropDuplicates([key]).drop(name)
    keyless = docs.where(F.col(key).isNull())
    return kept.union(keyless.dropDuplicates([text])) if not keyless.isEmpty() else kept
