"""Derived inputs as written tables: each is computed by Spark once per session.

The queries then read day-partitioned Parquet, as a deployment would, and their plans
show pruning and pushdown instead of the derivation of the test data.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from checks.fixture import FLAT_COLUMNS, flat_events, nested_events
from eventloom.plans.marts import session_funnel
from eventloom.schemas import NESTED_EVENT, SESSION_FUNNEL
from eventloom.sources.guards import path_exists
from eventloom.sources.scratch import new_dir

_written: dict[tuple[str, str, str], tuple[str, DataFrame]] = {}


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _table(
    spark: SparkSession,
    sf_dir: str,
    name: str,
    schema: str | T.StructType,
    partition: str,
    build: Callable[[], DataFrame],
) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written or not path_exists(spark, f"{_written[key][0]}/_SUCCESS"):
        path = new_dir(spark, name)
        # The derivation stacks dozens of CASE columns; inferring constraints over them
        # costs far more than it can save. Switched off for this one write.
        with _setting(spark, "spark.sql.constraintPropagation.enabled", "false"):
            build().write.partitionBy(partition).parquet(path)
        # Keeping the DataFrame keeps its file listing, not its rows.
        _written[key] = (path, spark.read.schema(schema).parquet(path))
    return _written[key][1]


def flat_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat events, partitioned by day."""
    return _table(
        spark, sf_dir, "flat", FLAT_COLUMNS, "event_date",
        lambda: flat_events(spark, sf_dir),
    )


def nested_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested events, partitioned by day."""
    return _table(
        spark, sf_dir, "nested", NESTED_EVENT, "event_date",
        lambda: nested_events(spark, sf_dir),
    )


def nested_folder(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the nested events, partitioned by day. Nothing is to be written there."""
    nested_table(spark, sf_dir)
    return _written[(spark.sparkContext.applicationId, sf_dir, "nested")][0]


def session_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session mart with churn flags over the whole history, partitioned by day."""
    return _table(
        spark, sf_dir, "sessions", SESSION_FUNNEL, "session_date",
        lambda: session_funnel(flat_table(spark, sf_dir), churn="history").hint(
            "rebalance", "session_date"
        ),
    )
