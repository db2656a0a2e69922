"""File listings as DataFrames."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def literal(path: str) -> str:
    """A path in which no sign is a pattern."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def list_files(spark: SparkSession, root: str | Sequence[str]) -> DataFrame:
    """Paths of all files below ``root``, or below each of several places, which may be patterns.

    No file is opened: only the path is selected.
    """
    root = root if isinstance(root, str) else list(root)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.select("path")
