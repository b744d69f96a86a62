"""Helpers the operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tapeglass.session import scratch_folder

#: Ranges that rows are dealt in, at most: their limits stand in the plan. Beyond it the ranges grow.
MAX_RANGES = 20_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """`df` written once to the shared scratch folder and read back.

    What Python or a shuffle made is then read as often as needed, and a lost executor costs a reread.
    """
    path = scratch_folder(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ranges(total: int, per_range: int) -> int:
    return min(MAX_RANGES, max(1, -(-total // per_range)))


def unused(df: DataFrame, name: str) -> str:
    """A column name like `name` that `df` does not have."""
    while name in df.columns:
        name = f"_{name}"
    return name


def hash60(text: Column) -> Column:
    """The first 60 bits of the MD5 of a text as a non-negative long, which other SQL engines compute alike."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def range_limits(df: DataFrame, key: str, parts: int) -> list[int]:
    """The last keys of all but the last of about `parts` ranges of equal size, ascending.

    Keys alone are dealt in ranges, and the driver gets one row a range. Rows of one key are in one range.
    """
    if parts < 2:
        return []
    dealt = df.select(F.col(key).alias("key")).where("key IS NOT NULL").repartitionByRange(parts, "key")
    ends = dealt.groupBy(F.spark_partition_id().alias("range")).agg(F.max("key").alias("end")).collect()
    return sorted(row["end"] for row in ends)[:-1]


def range_of(key: Column, limits: list[int]) -> Column:
    """How many limits are smaller than the key, 0 for NULL: found in a coarse step and a fine one."""
    if not limits:
        return F.lit(0)
    step = max(1, int(len(limits) ** 0.5))

    def constant(values: list[int]) -> Column:
        return F.from_json(F.lit(str(values)), "array<bigint>")

    def below(values: Column) -> Column:
        return F.size(F.filter(values, lambda limit: limit < key))

    coarse = below(constant(limits[step - 1 :: step]))
    fine = below(F.slice(constant(limits), coarse * step + 1, F.lit(step)))
    return F.when(key.isNull(), 0).otherwise(coarse * step + fine)
