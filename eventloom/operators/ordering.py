"""Operators over the order of sessions within a user or of steps within a day."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_group(
    df: DataFrame, by: str, order: Sequence[str], n: int, rank: str = "rn"
) -> DataFrame:
    """The ``n`` last rows of each group in ``order``, numbered from the latest.

    The filter on the row number sits directly on the window, so Spark cuts every group
    to ``n`` rows in each scanning task before the shuffle. A group of any size arrives
    as at most ``n`` rows per task.
    """
    window = Window.partitionBy(by).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)


def pivot_by_rank(
    ranked: DataFrame, by: str, columns: Mapping[str, tuple[str, int]], rank: str = "rn"
) -> DataFrame:
    """One row per group; ``columns`` maps output name to (input column, rank)."""
    return ranked.groupBy(by).agg(
        *[
            F.max(F.when(F.col(rank) == at, F.col(source))).alias(name)
            for name, (source, at) in columns.items()
        ]
    )


def sessions_before_gap(
    sessions: DataFrame,
    gap_days: int,
    user: str = "user_pseudo_id",
    day: str = "session_date",
    session: str = "ga_session_id",
) -> DataFrame:
    """Keys of the sessions whose user comes back more than ``gap_days`` days later.

    Sessions are ordered by (day, session id), so only a user's last session of a day can
    precede a gap. Sessions are first reduced to that one per user and day, which bounds a
    user's window by the number of calendar days however many sessions the user has.
    """
    last_of_day = sessions.groupBy(user, day).agg(F.max(session).alias(session))
    following = F.lead(day).over(Window.partitionBy(user).orderBy(day))
    return (
        last_of_day.withColumn("next_day", following)
        .where(F.date_diff("next_day", day) > gap_days)
        .select(user, day, session)
    )


def with_gap_flag(
    sessions: DataFrame,
    gap_days: int,
    name: str,
    user: str = "user_pseudo_id",
    day: str = "session_date",
    session: str = "ga_session_id",
) -> DataFrame:
    """Add a 0/1 column marking the sessions of :func:`sessions_before_gap`."""
    keys = sessions_before_gap(sessions, gap_days, user, day, session).select(
        F.col(user).alias("gap_user"),
        F.col(day).alias("gap_day"),
        F.col(session).alias("gap_session"),
        F.lit(1).alias(name),
    )
    same = (
        F.col(user).eqNullSafe(F.col("gap_user"))
        & (F.col(day) == F.col("gap_day"))
        & (F.col(session) == F.col("gap_session"))
    )
    return (
        sessions.join(keys, same, "left")
        .withColumn(name, F.coalesce(name, F.lit(0)))
        .drop("gap_user", "gap_day", "gap_session")
    )


def expand_reached_steps(
    counts: DataFrame, step: str, count: str, by: Sequence[str]
) -> DataFrame:
    """Cumulative funnel: how many reached each step, from counts by deepest step.

    The input is already one row per group and step, so expanding a row to all steps up
    to its own touches a handful of rows and not the sessions.
    """
    return (
        counts.withColumn(step, F.explode(F.sequence(F.lit(1), F.col(step))))
        .groupBy(*by, step)
        .agg(F.sum(count).alias(count))
    )


def with_next_count(df: DataFrame, by: str, step: str, count: str) -> DataFrame:
    """Add ``next_count`` (0 after the last step) and ``first_count`` (that of step 1)."""
    group = Window.partitionBy(by)
    return df.withColumns(
        {
            "next_count": F.coalesce(
                F.lead(count).over(group.orderBy(step)), F.lit(0)
            ),
            "first_count": F.max(F.when(F.col(step) == 1, F.col(count))).over(group),
        }
    )


def descending(df: DataFrame, column: str, *ties: str) -> DataFrame:
    """Sort by ``column`` from high to low, for display."""
    order: list[Column] = [F.col(column).desc()] + [F.col(c).asc_nulls_last() for c in ties]
    return df.orderBy(*order)
