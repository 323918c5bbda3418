"""Mergeable states per day: distinct counts and frequent values without keeping the rows.

A state of fixed size stands for any number of rows, and the states of days merge into that
of a period. A refresh over a long history then reads a state per day (and user) and shuffles
no fact of old days. Counts are estimates; ``close_enough`` is the bound they are held to.
The exact ways stay the default.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.plans import marts
from eventloom.schemas import DAY_SKETCHES, USER_DAY_SKETCHES, as_schema

USER = marts.USER
LG_K = 12  # 4096 registers: a standard error of 1.6 %; counts of some dozens are exact
ERROR = 1.04 / 2 ** (LG_K / 2)


def close_enough(estimate: Column, exact: Column) -> Column:
    """Within three standard errors of the sketch, or one of a small count."""
    return F.abs(estimate - exact) <= F.greatest(F.lit(1.0), exact * 3 * ERROR)


# -- distinct counts per user ----------------------------------------------------------


def user_day_sketches(facts: DataFrame) -> DataFrame:
    """A sketch per day, user and kind of fact, from :func:`marts.user_day_facts`."""
    sketch = {
        kind: F.hll_sketch_agg(F.when(F.col("kind") == kind, F.col("fact")), LG_K)
        for kind in marts.FACT_COUNTS.values()
    }
    return as_schema(
        facts.groupBy("event_date", USER).agg(*[s.alias(k) for k, s in sketch.items()]),
        USER_DAY_SKETCHES,
    )


def user_event_totals_from_sketches(totals: DataFrame, sketches: DataFrame) -> DataFrame:
    """As :func:`marts.user_event_totals_from_days` with estimated distinct counts.

    One state per day and user is read and none of the facts.
    """
    merged = sketches.groupBy(USER).agg(
        *[
            F.hll_sketch_estimate(F.hll_union_agg(kind)).alias(kind)
            for kind in marts.FACT_COUNTS.values()
        ]
    )
    return marts.added_up(
        totals.drop("event_date").unionByName(merged, allowMissingColumns=True)
    )


# -- distinct counts per day and period ------------------------------------------------


def day_sketches(flat: DataFrame) -> DataFrame:
    """Per day: users, buyers and sessions.

    Users and buyers are theta sketches, which can be intersected as well.
    """
    user = F.col(USER)
    session = F.col("param_ga_session_id").cast("string")
    glued = F.concat(F.coalesce(F.length(user).cast("string"), F.lit("-")), F.lit(":"),
                     F.coalesce(user, F.lit("")), session)
    buyer = F.when(F.col("event_name") == "purchase", user)
    return as_schema(
        flat.groupBy("event_date").agg(
            F.theta_sketch_agg(user, LG_K).alias("users"),
            F.theta_sketch_agg(buyer, LG_K).alias("buyers"),
            F.hll_sketch_agg(glued, LG_K).alias("sessions"),
        ),
        DAY_SKETCHES,
    )


def trailing_counts(sketches: DataFrame, days: int) -> DataFrame:
    """Users and sessions of the ``days`` days up to each day, each counted once.

    A distinct count over a moving period cannot be added up from counts per day; states
    can. A row per day is repeated for the days it counts towards, nothing else is.
    """
    day = marts.parse_day(F.col("event_date"))
    towards = F.explode(F.sequence(F.lit(0), F.lit(days - 1))).alias("ahead")
    spread = sketches.select(day.alias("day"), "users", "sessions", towards)
    spread = spread.withColumn("until", F.date_add("day", F.col("ahead")))
    active = sketches.select(day.alias("until"), "event_date")
    return (
        spread.join(active, "until")
        .groupBy("event_date")
        .agg(
            F.theta_sketch_estimate(F.theta_union_agg("users", LG_K)).alias("users"),
            F.hll_sketch_estimate(F.hll_union_agg("sessions")).alias("sessions"),
        )
    )


def returning_users(sketches: DataFrame, split: str) -> DataFrame:
    """Users seen before day ``split``, from it on, and in both periods."""
    late = F.col("event_date") >= split

    def period(chosen: Column) -> Column:
        return F.theta_union_agg(F.when(chosen, F.col("users")), LG_K)

    both = sketches.agg(period(~late).alias("early"), period(late).alias("late"))
    return both.select(
        F.theta_sketch_estimate("early").alias("before"),
        F.theta_sketch_estimate("late").alias("since"),
        F.theta_sketch_estimate(F.theta_intersection("early", "late")).alias("returned"),
    )


# -- frequent values -------------------------------------------------------------------


def frequent_day_states(sessions: DataFrame, column: str, tracked: int = 1000) -> DataFrame:
    """(session_date, user, state): which values of ``column`` a user's sessions have."""
    state = F.expr(f"approx_top_k_accumulate(`{column}`, {int(tracked)})")
    return sessions.groupBy("session_date", USER).agg(state.alias("state"))


def most_frequent_from_days(states: DataFrame, name: str, tracked: int = 1000) -> DataFrame:
    """The most frequent value per user over all days given; NULL is a value.

    Exact as long as a user has no more than about ``tracked`` values; beyond that values
    of small share may be missed.
    """
    merged = states.groupBy(USER).agg(
        F.expr(f"approx_top_k_combine(state, {int(tracked)})").alias("state")
    )
    first = F.get(F.expr("approx_top_k_estimate(state, 1)"), F.lit(0))
    return merged.select(USER, first["item"].alias(name))
