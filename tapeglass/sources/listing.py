"""Input files: pattern resolution, and the ledger of files already ingested."""

from __future__ import annotations

import logging
import re
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tapeglass.session import path_exists

log = logging.getLogger("tapeglass")

FILE_COLUMNS = "path string, length bigint, modificationTime timestamp"
LEDGER_COLUMNS = "path string, ingested_at timestamp"


def _path_pattern(glob: str) -> str:
    """The regular expression of a glob: ** and the slash after it span folders, * and ? do not."""
    parts = {"**/": "(?:.*/)?", "**": ".*", "*": "[^/]*", "?": "[^/]"}
    cut = re.split(r"(\*\*/|\*\*|\*|\?)", glob)
    return "".join(parts.get(part, re.escape(part)) for part in cut)


def list_files(
    spark: SparkSession, patterns: str | list[str], recursive: bool = False
) -> DataFrame:
    """The distinct files (path, length, modificationTime) that the paths and globs match.

    Only the listing is read, no content. `**` stands for any depth of folders and may be followed by folders and
    a file name pattern. A pattern without a match is logged and left out.
    """
    found = []
    for pattern in [patterns] if isinstance(patterns, str) else patterns:
        folder, deep, below = pattern.partition("**")
        below = below.strip("/")
        name = below.rpartition("/")[2].replace("**", "*")
        reader = spark.read.format("binaryFile")
        reader = reader.option("recursiveFileLookup", str(recursive or bool(deep)).lower())
        if name:
            reader = reader.option("pathGlobFilter", name)
        try:
            files = reader.load(folder or ".")
            if "/" in below:
                files = files.where(F.col("path").rlike(f"/{_path_pattern(below)}$"))
            found.append(files.select("path", "length", "modificationTime"))
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            log.warning("No files matched: %s", pattern)
    if not found:
        return spark.createDataFrame([], FILE_COLUMNS)
    # One listing holds a file once.
    return found[0] if len(found) == 1 else reduce(DataFrame.unionByName, found).dropDuplicates(["path"])


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    if not path_exists(spark, ledger):
        return spark.createDataFrame([], LEDGER_COLUMNS)
    return spark.read.schema(LEDGER_COLUMNS).parquet(ledger)


def new_files(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Listed files that the ledger does not hold."""
    return files.join(ledger.select("path"), "path", "left_anti")


def record_files(files: DataFrame, ledger: str) -> None:
    """Add files to the ledger; call it only after their rows are written."""
    files.select("path", F.current_timestamp().alias("ingested_at")).write.mode("append").parquet(ledger)
