"""File and table listings."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cuota.specs import FileRules


def require_paths(spark: SparkSession, paths: Iterable[str]) -> None:
    """Raise FileNotFoundError naming every path (or glob) that matches nothing."""
    absent = []
    for path in paths:
        try:
            spark.read.format("text").load(path)
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            absent.append(path)
    if absent:
        raise FileNotFoundError(f"missing input: {', '.join(absent)}")


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """path, filename, size and modification time of the files in a folder, ordered by path.

    Only the listing is read; the content column is pruned away.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("filename"),
        F.col("length").alias("size"),
        F.date_format("modificationTime", "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("modified"),
    ).orderBy("path")


def is_valid_file(path: Column, size: Column, rules: FileRules = FileRules()) -> Column:
    """Size within bounds and an accepted extension, ignoring case."""
    extension = F.regexp_extract(F.lower(path), r"[^/.][^/]*(\.[^/.]*)$", 1)
    return size.between(rules.min_bytes, rules.max_bytes) & extension.isin(*rules.extensions)


def list_tables(spark: SparkSession, pattern: str) -> list[str]:
    """Names of catalog tables and views matching a pattern such as 'tmp_*', sorted."""
    return sorted(table.name for table in spark.catalog.listTables(pattern=pattern))
