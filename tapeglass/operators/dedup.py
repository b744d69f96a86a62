"""Keep-first deduplication and merging of new rows into an existing table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tapeglass.schema import KEY


def dedup_first(df: DataFrame, order: list[str], key: list[str] = KEY) -> DataFrame:
    """The first row per key in the order `order`; NULL keys are equal.

    An aggregation, not a window: copies of a key are folded before the shuffle, so a key with very many
    copies reaches its reducer as one row per input partition.
    """
    payload = [name for name in df.columns if name not in key]
    first = F.min_by(F.struct(*payload), F.struct(*order)).alias("first")
    return df.groupBy(*key).agg(first).select(*key, "first.*").select(df.columns)


#: Groups of keys that copies are counted in, and how far above the mean a group must be to be folded first.
KEY_GROUPS = 1 << 16
HOT_FACTOR, HOT_ROWS = 4, 10_000


def hot_groups(
    new: DataFrame, key: list[str] = KEY, hot_rows: int = HOT_ROWS, known_rows: int | None = None
) -> DataFrame | None:
    """(_group) of the groups of keys that hold far more rows than others, or None.

    A hash deals keys to a fixed number of groups; counts are folded before the shuffle, and at most KEY_GROUPS /
    HOT_FACTOR groups can lie that far above the mean, so the driver gets that many numbers at most. If all `known_rows`
    are too few for one such group, nothing is counted.
    """
    if known_rows is not None and known_rows <= hot_rows:
        return None
    counts = new.groupBy(_group(key).alias("_group")).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.groupBy().agg(F.sum("n").alias("total"), F.collect_list(F.when(F.col("n") > hot_rows, F.struct("_group", "n"))).alias("large"))
    total, large = counts.first()
    limit = hot_rows + HOT_FACTOR * (total or 0) / KEY_GROUPS
    hot = [(r["_group"],) for r in large if r["n"] > limit]
    return new.sparkSession.createDataFrame(hot, "_group long") if hot else None


def _group(key: list[str]):
    return F.pmod(F.xxhash64(*key), F.lit(KEY_GROUPS))


def merge_in_ranges(
    existing: DataFrame, new: DataFrame, order: list[str], layout: list[str], key: list[str] = KEY, hot_rows: int = HOT_ROWS,
    known_rows: int | None = None,
) -> DataFrame:
    """As `merge_new`, with the rows sorted by `layout` and the key inside ranges of `layout`: one shuffle in all.

    `layout` holds columns that depend on the key, and columns of it. Existing keys and new rows are dealt in ranges
    once, and the keep-first aggregation runs on top of that partitioning, whose sort is the order in which rows
    come out. Copies of a key are not folded before that shuffle, so groups of keys with far more rows than others are
    folded by an aggregation of their own first; other rows never take part in it. Few new rows (`known_rows` up to
    `hot_rows`) make few files anyway: the aggregation deals them by key, which needs no look at all rows for range limits.
    """
    if (hot := hot_groups(new, key, hot_rows, known_rows)) is not None:
        marked = new.withColumn("_group", _group(key))
        copies = marked.join(F.broadcast(hot), "_group", "left_semi").drop("_group")
        others = marked.join(F.broadcast(hot), "_group", "left_anti").drop("_group")
        new = others.unionByName(dedup_first(copies, order, key))
    columns = [*layout, *[name for name in key if name not in layout]]
    payload = [name for name in new.columns if name not in columns]
    ranked = F.struct(F.lit(1).alias("source"), *[F.col(name) for name in order])
    fresh = new.select(*columns, F.struct(*[F.col(f"`{name}`") for name in payload]).alias("payload"), ranked.alias("rank"))
    payload_type, rank_type = (fresh.schema[name].dataType for name in ("payload", "rank"))
    known_rank = F.struct(
        F.lit(0).alias("source"), *[F.lit(None).cast(field.dataType).alias(field.name) for field in rank_type[1:]]
    )
    known = existing.select(*columns, F.lit(None).cast(payload_type).alias("payload"), known_rank.alias("rank"))
    dealt = known.unionByName(fresh)
    if known_rows is None or known_rows > hot_rows:
        dealt = dealt.repartitionByRange(*layout)
    firsts = dealt.groupBy(*columns).agg(F.min("rank.source").alias("source"), F.min_by("payload", "rank").alias("payload"))
    merged = firsts.where(F.col("source") == 1).select(*columns, "payload.*").select(new.columns)
    return merged.sortWithinPartitions(*columns)


def merge_new(
    existing: DataFrame, new: DataFrame, order: list[str], key: list[str] = KEY
) -> DataFrame:
    """Rows of `new` whose key `existing` lacks, deduplicated keep-first.

    Existing keys and new rows go through one shuffle and one keep-first aggregation in which existing rows
    rank first. That gives the same rows as deduplicating and then anti-joining null-safe, without a second
    shuffle of the new rows. Existing rows carry no payload.
    """
    payload = [name for name in new.columns if name not in key]
    packed = F.struct(*[F.col(f"`{name}`") for name in payload])
    ranked = F.struct(F.lit(1).alias("source"), *[F.col(name) for name in order])
    fresh = new.select(*key, packed.alias("payload"), ranked.alias("rank"))
    payload_type, rank_type = (fresh.schema[name].dataType for name in ("payload", "rank"))
    known_rank = F.struct(
        F.lit(0).alias("source"), *[F.lit(None).cast(field.dataType).alias(field.name) for field in rank_type[1:]]
    )
    known = existing.select(
        *key, F.lit(None).cast(payload_type).alias("payload"), known_rank.alias("rank")
    )
    firsts = known.unionByName(fresh).groupBy(*key).agg(
        F.min("rank.source").alias("source"), F.min_by("payload", "rank").alias("payload")
    )
    return firsts.where(F.col("source") == 1).select(*key, "payload.*").select(new.columns)


def merged_table(
    existing: DataFrame, new: DataFrame, order: list[str], key: list[str] = KEY
) -> DataFrame:
    """The table after the merge: all existing rows and the new rows whose key they lack."""
    return existing.unionByName(merge_new(existing, new, order, key).select(existing.columns))
