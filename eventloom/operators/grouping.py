"""Grouping operators that reduce on the map side before anything is shuffled.

A key holding a large share of all rows costs no more than any other key here: every
operator aggregates partially in the scanning tasks and none gathers the rows of a group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def earliest(value: Column, seen_at: Column) -> Column:
    """Aggregate: the non-NULL ``value`` seen first, the smaller one on a tie.

    A repeatable stand-in for "any value of the group".
    """
    order = F.when(value.isNotNull(), F.struct(seen_at, value))
    return F.min_by(value, order)


def first_by(value: Column, *order: Column) -> Column:
    """Aggregate: ``value`` of the first row in ``order``, NULL values included."""
    return F.min_by(value, F.struct(*order))


def sum_of_distinct_facts(
    df: DataFrame,
    by: Sequence[str],
    fact: str,
    value: str,
    total: str,
    facts: str,
) -> DataFrame:
    """Per ``by``: sum of one ``value`` per distinct ``fact`` and the number of facts.

    Rows repeating a fact (a transaction spread over its items) are merged first, keeping
    the largest value, so each fact is counted once.
    """
    per_fact = df.groupBy(*by, fact).agg(F.max(value).alias(value))
    return per_fact.groupBy(*by).agg(
        F.sum(value).alias(total), F.count("*").alias(facts)
    )


def value_counts(df: DataFrame, by: str, columns: Sequence[str]) -> DataFrame:
    """(by, column, value, n): how often each column takes each value, in one scan."""
    pairs = F.explode(
        F.array(
            *[
                F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                for c in columns
            ]
        )
    )
    return (
        df.select(by, pairs.alias("pair"))
        .groupBy(by, F.col("pair.column").alias("column"), F.col("pair.value").alias("value"))
        .agg(F.count("*").alias("n"))
    )


def most_frequent(df: DataFrame, by: str, columns: Mapping[str, str]) -> DataFrame:
    """Most frequent value of several columns per ``by``, exact.

    ``columns`` maps output name to input column. NULL counts as a value; ties go to the
    smaller value and to NULL last.
    """
    counts = value_counts(df, by, list(columns.values()))
    rank = F.struct(-F.col("n"), F.col("value").isNull(), F.col("value"))
    return counts.groupBy(by).agg(
        *[
            F.min_by("value", F.when(F.col("column") == source, rank)).alias(name)
            for name, source in columns.items()
        ]
    )


def most_frequent_approx(
    df: DataFrame, by: str, column: str, name: str, tracked: int = 1000
) -> DataFrame:
    """Most frequent value per ``by`` from a frequent-items sketch of fixed size."""
    top = F.expr(f"approx_top_k(`{column}`, 1, {int(tracked)})")
    return df.groupBy(by).agg(F.get(top, F.lit(0))["item"].alias(name))
