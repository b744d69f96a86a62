"""Samples of an exact number of rows that do not depend on how the rows are dealt."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Bits of the hash, and of its front that rows are counted by.
HASH_BITS, GROUP_BITS = 60, 16


def key_hash(df: DataFrame, key: list[str], seed: int) -> Column:
    """The first 60 bits of the MD5 of the key as text; NULL is a value of its own."""

    def text(name: str) -> Column:
        timed = dict(df.dtypes)[name].startswith("timestamp")
        shown = F.date_format(name, "yyyyMMddHHmmssSSSSSS") if timed else F.col(name).cast("string")
        return F.coalesce(shown, F.lit("-"))

    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *map(text, key)).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def exact_sample(df: DataFrame, n: int, key: list[str], seed: int = 42) -> DataFrame:
    """The `n` rows of the smallest hashes of their key, all rows if there are no more; in no order.

    Rows with the same key stand together; the other columns decide which of them is taken where the sample ends. Rows
    are counted by the front of their hash first, which is folded before the shuffle, so only the rows up to the group
    that holds the n-th one are sorted, not `n` rows of every task.
    """
    if n < 1:
        raise ValueError("a sample has at least one row")
    hashed = df.withColumn("_hash", key_hash(df, key, seed))
    front = F.shiftright("_hash", HASH_BITS - GROUP_BITS)
    counts = hashed.groupBy(front.alias("front")).agg(F.count(F.lit(1)).alias("rows"))
    # At most 2^16 rows.
    before = F.coalesce(F.sum("rows").over(Window.orderBy("front").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cut = counts.withColumn("before", before).where(F.col("before") < n).agg(F.max("front").alias("cut")).scalar()
    rest = [name for name in df.columns if name not in key]
    return hashed.where(front <= cut).orderBy("_hash", *key, *rest).limit(n).drop("_hash")
