"""Checks that stop a run early with a clear message."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class MissingInput(ValueError):
    """An input that a run needs is not there."""


def path_exists(spark: SparkSession, pattern: str) -> bool:
    """Whether any file or folder matches a path or glob pattern."""
    return bool(matching_paths(spark, pattern))


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching a glob pattern, sorted."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    found = fs.globStatus(hadoop_path) or []
    return sorted(s.getPath().toString() for s in found)


def require_path(spark: SparkSession, pattern: str) -> None:
    if not path_exists(spark, pattern):
        raise MissingInput(f"nothing found at {pattern}")


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Return ``df``, or raise if it has no row. Reads at most one row."""
    if df.isEmpty():
        raise MissingInput(f"{what} is empty")
    return df
