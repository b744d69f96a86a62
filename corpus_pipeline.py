"""A training corpus from raw documents: scored, cleaned of boilerplate, deduplicated, decontaminated and packed.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame. `run` writes each stage's rows to the shared scratch
folder and reads them again, so a lost executor never repeats more than one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tapeglass.llm import bm25_packing, line_templates, neighbour_quality, simhash, tiling
from tapeglass.llm.common import staged, table
from tapeglass.llm.queries import DISTANCE, SHINGLE, op8_tokenizer

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    voters = neighbour_quality.fit(docs, table(spark, sf_dir, "labels"))
    return neighbour_quality.accepted(docs.select(COLUMNS), voters)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without recurring lines; n_chars follows the text, and what was nothing else is dropped."""
    cleaned = line_templates.without_recurring_lines(docs.select(COLUMNS))
    left = cleaned.where((F.col("dropped_lines") == 0) | (F.trim("text") != ""))
    changed = F.when(F.col("dropped_lines") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", changed).select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.without_near_duplicates(docs.select(COLUMNS), SHINGLE, DISTANCE)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return tiling.decontaminated(docs.select(COLUMNS), table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of tokens."""
    return bm25_packing.pack(docs, *op8_tokenizer())


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("packing", packing),
]

#: Learned scores, fingerprints and token ids have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
