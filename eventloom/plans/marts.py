"""Marts over the flat event table and over the session mart.

Every function is a lazy DataFrame expression. It works on one day or on the whole
history; a day is chosen by filtering the input on its partition column.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.geo_time import local_hour
from eventloom.functions.labels import (
    FUNNEL_STAGES,
    PROMO_CALENDAR,
    Period,
    flag,
    funnel_stage,
    funnel_step,
    period_label,
)
from eventloom.functions.scalars import (
    count_event,
    month_of_day,
    parse_day,
    safe_ratio,
    weekday_of_day,
)
from eventloom.operators.grouping import (
    earliest,
    first_by,
    most_frequent,
    sum_of_distinct_facts,
)
from eventloom.operators.ordering import (
    expand_reached_steps,
    latest_per_group,
    pivot_by_rank,
    with_gap_flag,
    with_next_count,
)
from eventloom.plans.flatten import one_row_per_event
from eventloom.schemas import (
    DAILY_SUMMARY,
    DEVICE_CHANNEL,
    DEVICE_CHANNEL_DAILY,
    FUNNEL_DAILY,
    ORDER_ITEMS,
    ORDERS,
    SESSION_FUNNEL,
    USER_DAY_FACTS,
    USER_DAY_TOTALS,
    USER_FEATURES,
    as_schema,
)

USER = "user_pseudo_id"
DEFAULT_GAP_DAYS = 15
# Fixed value: end of the observation period user features refer to by default.
DEFAULT_REFERENCE_DATE = date(2021, 1, 16)


# -- daily summary ---------------------------------------------------------------------


def distinct_sessions(flat: DataFrame) -> DataFrame:
    """(event_date, user, session), each once; rows without a session are left out."""
    keys = ["event_date", USER, "param_ga_session_id"]
    return flat.where(F.col("param_ga_session_id").isNotNull()).select(*keys).distinct()


def sessions_per_day(flat: DataFrame, exact_session_pairs: bool = False) -> DataFrame:
    """Sessions and users per day, each counted as a group.

    Events are reduced to one row per user and session first. Only those rows are listed
    once as a session and once as a user, so no event row is multiplied.
    """
    user, session = F.col(USER), F.col("param_ga_session_id").cast("string")
    glued = F.concat(user, session)
    if exact_session_pairs:
        # The length in front keeps apart what would read the same glued together.
        size = F.coalesce(F.length(user).cast("string"), F.lit("-"))
        glued = F.concat(size, F.lit(":"), F.coalesce(user, F.lit("")), session)
    facts = F.array(
        F.struct(F.lit("session").alias("kind"), glued.alias("value")),
        F.struct(F.lit("user").alias("kind"), user.alias("value")),
    )
    return (
        distinct_sessions(flat)
        .select("event_date", F.explode(facts).alias("fact"))
        .select("event_date", "fact.kind", "fact.value")
        .distinct()
        .groupBy("event_date")
        .agg(
            F.count_if((F.col("kind") == "session") & F.col("value").isNotNull()).alias(
                "daily_sessions"
            ),
            F.count_if((F.col("kind") == "user") & F.col("value").isNotNull()).alias(
                "daily_users"
            ),
        )
    )


def purchases(flat: DataFrame) -> DataFrame:
    """Purchase rows that carry a transaction id."""
    return flat.where(
        (F.col("event_name") == "purchase") & F.col("transaction_id").isNotNull()
    )


def revenue_per_day(flat: DataFrame) -> DataFrame:
    return sum_of_distinct_facts(
        purchases(flat),
        by=["event_date"],
        fact="transaction_id",
        value="purchase_revenue",
        total="daily_revenue",
        facts="daily_transactions",
    )


def shipping_per_day(flat: DataFrame) -> DataFrame:
    tier = F.col("param_shipping_tier")
    return (
        flat.where(F.col("event_name") == "add_shipping_info")
        .groupBy("event_date")
        .agg(
            F.count_if(tier == "Ground").alias("ground_shipping_cnt"),
            F.count_if(tier.isin("Next Day Air", "2 Day Air")).alias("air_shipping_cnt"),
        )
    )


def revenue_and_shipping_per_day(flat: DataFrame) -> DataFrame:
    """Both of the above from one scan of the two kinds of events they look at."""
    bought = (F.col("event_name") == "purchase") & F.col("transaction_id").isNotNull()
    shipped = F.col("event_name") == "add_shipping_info"
    tier = F.when(shipped, F.col("param_shipping_tier"))
    per_fact = (
        flat.where(F.col("event_name").isin("purchase", "add_shipping_info"))
        .groupBy("event_date", F.when(bought, F.col("transaction_id")).alias("fact"))
        .agg(
            F.max(F.when(bought, F.col("purchase_revenue"))).alias("revenue"),
            F.count_if(tier == "Ground").alias("ground"),
            F.count_if(tier.isin("Next Day Air", "2 Day Air")).alias("air"),
        )
    )
    return per_fact.groupBy("event_date").agg(
        F.sum("revenue").alias("daily_revenue"),
        F.count("fact").alias("daily_transactions"),
        F.sum("ground").alias("ground_shipping_cnt"),
        F.sum("air").alias("air_shipping_cnt"),
    )


def daily_summary(
    flat: DataFrame,
    calendar: Sequence[Period] = PROMO_CALENDAR,
    exact_session_pairs: bool = False,
) -> DataFrame:
    """Sessions, users, revenue and shipping choices per day.

    Sessions are counted on user and session text glued together; with
    ``exact_session_pairs`` on the pair itself, which cannot collide.
    """
    zero = F.lit(0)
    revenue = F.coalesce("daily_revenue", zero.cast("double"))
    transactions = F.coalesce("daily_transactions", zero)
    joined = sessions_per_day(flat, exact_session_pairs).join(
        revenue_and_shipping_per_day(flat), "event_date", "left"
    )
    summary = joined.select(
        "event_date",
        "daily_sessions",
        "daily_users",
        revenue.alias("daily_revenue"),
        transactions.alias("daily_transactions"),
        safe_ratio(revenue, transactions).alias("daily_avg_order_value"),
        safe_ratio(transactions, F.col("daily_sessions")).alias("daily_conversion_rate"),
        F.coalesce("ground_shipping_cnt", zero).alias("ground_shipping_cnt"),
        F.coalesce("air_shipping_cnt", zero).alias("air_shipping_cnt"),
        period_label(F.col("event_date"), calendar).alias("period_label"),
    )
    return as_schema(summary, DAILY_SUMMARY)


# -- orders ----------------------------------------------------------------------------


def orders(flat: DataFrame, calendar: Sequence[Period] = PROMO_CALENDAR) -> DataFrame:
    """One row per transaction, user and day."""
    day = F.col("event_date")
    grouped = (
        purchases(flat)
        .groupBy("transaction_id", USER, "event_date")
        .agg(
            F.sum(F.col("price") * F.col("quantity")).alias("order_revenue"),
            F.count_distinct("item_name").alias("item_count"),
        )
    )
    return as_schema(
        grouped.withColumns(
            {
                "order_date": parse_day(day),
                "order_month": month_of_day(day),
                "is_bundle_order": flag(F.col("item_count") >= 2),
                "period_label": period_label(day, calendar),
            }
        ),
        ORDERS,
    )


def order_items(flat: DataFrame, calendar: Sequence[Period] = PROMO_CALENDAR) -> DataFrame:
    """One row per purchased item row; no grouping, no shuffle."""
    day = F.col("event_date")
    named = purchases(flat).where(F.col("item_name").isNotNull())
    return as_schema(
        named.withColumns(
            {
                "item_revenue": F.col("price") * F.col("quantity"),
                "item_quantity": F.col("quantity"),
                "event_month": month_of_day(day),
                "period_label": period_label(day, calendar),
            }
        ),
        ORDER_ITEMS,
    )


# -- session funnel --------------------------------------------------------------------

# Output column -> event name it counts.
SESSION_COUNTS = {
    "session_page_views": "page_view",
    "session_view_item_count": "view_item",
    "session_add_to_cart_count": "add_to_cart",
    "session_checkout_count": "begin_checkout",
    "session_add_shipping_info_count": "add_shipping_info",
    "session_add_payment_info_count": "add_payment_info",
    "session_purchase_count": "purchase",
    "session_scroll_count": "scroll",
}

_SESSION_KEYS = (USER, "param_ga_session_id", "event_date")
# Output column -> input column of which one value stands for the whole session.
_SESSION_ATTRIBUTES = {
    "session_device": "category",
    "session_traffic_source": "source",
    "session_traffic_medium": "medium",
    "session_number": "param_ga_session_number",
    "session_offset": "offset_minutes",
}


def session_totals(flat: DataFrame) -> DataFrame:
    """Counts, engagement, first timestamp and one value per attribute of each session.

    Events are summed per session and combination of attribute values first, which is a
    hash aggregation, partial in the scanning tasks. The values seen first are then picked
    among those few rows per session.
    """
    counts = {name: count_event(event) for name, event in SESSION_COUNTS.items()}
    counts["session_event_count"] = F.count("*")
    counts["session_engagement_time"] = F.sum("param_engagement_time_msec")
    seen = F.col("session_start")
    combined = (
        flat.where(F.col("param_ga_session_id").isNotNull())
        .groupBy(*_SESSION_KEYS, *_SESSION_ATTRIBUTES.values())
        .agg(
            F.min("event_timestamp").alias("session_start"),
            *[c.alias(name) for name, c in counts.items()],
        )
    )
    return combined.groupBy(*_SESSION_KEYS).agg(
        F.min(seen).alias("session_start"),
        *[F.sum(name).alias(name) for name in counts],
        *[
            earliest(F.col(column), seen).alias(name)
            for name, column in _SESSION_ATTRIBUTES.items()
        ],
    )


def with_funnel(totals: DataFrame) -> DataFrame:
    """Add funnel step, stage and the purchase and bounce flags."""
    return totals.withColumns(
        {
            "session_funnel_step": funnel_step(),
            "purchase_flag": flag(F.col("session_purchase_count") > 0),
            "bounce_flag": flag(
                (F.col("session_page_views") <= 1)
                & (F.col("session_purchase_count") == 0)
            ),
        }
    ).withColumn("session_funnel_stage", funnel_stage(F.col("session_funnel_step")))


def with_history_churn(sessions: DataFrame, gap_days: int = DEFAULT_GAP_DAYS) -> DataFrame:
    """Recompute ``churn_session_flag`` over all the sessions given."""
    flagged = with_gap_flag(
        sessions.drop("churn_session_flag"), gap_days, "churn_session_flag"
    )
    return as_schema(flagged, SESSION_FUNNEL)


def session_funnel(
    flat: DataFrame,
    churn: Literal["daily", "history"] = "daily",
    gap_days: int = DEFAULT_GAP_DAYS,
    calendar: Sequence[Period] = PROMO_CALENDAR,
    dedupe_events: bool = False,
) -> DataFrame:
    """One row per user, session and day.

    ``churn="daily"`` sees each day alone, as a daily run does: the next session is never
    on another day, so the flag is 0. ``churn="history"`` compares with the user's next
    active day among all days of the input. Events count once per item row unless
    ``dedupe_events``.
    """
    if churn not in ("daily", "history"):
        raise ValueError(f"unknown churn mode {churn!r}")
    events = one_row_per_event(flat) if dedupe_events else flat
    day = F.col("event_date")
    sessions = with_funnel(session_totals(events)).withColumns(
        {
            "ga_session_id": F.col("param_ga_session_id"),
            "session_date": parse_day(day),
            "session_hour": local_hour(F.col("session_start"), F.col("session_offset")),
            "session_weekday": weekday_of_day(day),
            "period_label": period_label(day, calendar),
            "churn_session_flag": F.lit(0),
        }
    )
    sessions = as_schema(sessions, SESSION_FUNNEL)
    return with_history_churn(sessions, gap_days) if churn == "history" else sessions


# -- daily funnel ----------------------------------------------------------------------


def funnel_daily(sessions: DataFrame, dense: bool = False) -> DataFrame:
    """Sessions reaching each step per day, drop-off to the next and cumulative pass rate.

    Steps nobody reached produce no row, or with ``dense`` a row of zeros.
    """
    by_step = sessions.groupBy(
        F.col("session_date").alias("event_date"),
        "period_label",
        F.col("session_funnel_step").alias("funnel_step"),
    ).agg(F.count("*").alias("session_cnt"))
    if dense:
        by_step = by_step.unionByName(
            by_step.groupBy("event_date", "period_label").agg(
                F.lit(len(FUNNEL_STAGES)).alias("funnel_step"),
                F.lit(0).cast("long").alias("session_cnt"),
            )
        )
    reached = expand_reached_steps(
        by_step, "funnel_step", "session_cnt", ["event_date", "period_label"]
    )
    chained = with_next_count(reached, "event_date", "funnel_step", "session_cnt")
    count = F.col("session_cnt")
    lost = count - F.col("next_count")
    return as_schema(
        chained.withColumns(
            {
                "funnel_stage": funnel_stage(F.col("funnel_step")),
                "drop_off_cnt": lost,
                "drop_off_rate": safe_ratio(lost, count, 4),
                "cumulative_pass_rate": safe_ratio(count, F.col("first_count"), 4),
            }
        ),
        FUNNEL_DAILY,
    )


# -- device x channel ------------------------------------------------------------------

_CHANNEL_KEYS = ("session_device", "session_traffic_source", "session_traffic_medium")


def _channel_sums() -> dict[str, Column]:
    return {
        "total_sessions": F.count("*"),
        "purchase_sessions": F.sum("purchase_flag"),
        "bounce_sessions": F.sum("bounce_flag"),
        "churn_sessions": F.sum("churn_session_flag"),
        "depth_sum": F.sum("session_funnel_step"),
        "views_sum": F.sum("session_page_views"),
        "engagement_sum": F.sum("session_engagement_time"),
        "engagement_rows": F.count("session_engagement_time"),
    }


def device_channel_partials(sessions: DataFrame) -> DataFrame:
    """Additive sums per day, device and channel: append a day, never recompute one."""
    return as_schema(
        sessions.groupBy("session_date", *_CHANNEL_KEYS).agg(
            *[c.alias(name) for name, c in _channel_sums().items()]
        ),
        DEVICE_CHANNEL_DAILY,
    )


def _channel_report(sums: DataFrame) -> DataFrame:
    total = F.col("total_sessions")
    return as_schema(
        sums.withColumns(
            {
                "conversion_rate": safe_ratio(F.col("purchase_sessions"), total, 4),
                "bounce_rate": safe_ratio(F.col("bounce_sessions"), total, 4),
                "churn_session_rate": safe_ratio(F.col("churn_sessions"), total, 4),
                "avg_funnel_depth": safe_ratio(F.col("depth_sum"), total, 2),
                "avg_page_views": safe_ratio(F.col("views_sum"), total, 2),
                "avg_engagement_time": safe_ratio(
                    F.col("engagement_sum"), F.col("engagement_rows"), 2
                ),
            }
        ),
        DEVICE_CHANNEL,
    )


def device_channel_from_partials(partials: DataFrame) -> DataFrame:
    """Device x channel report from the daily sums."""
    return _channel_report(
        partials.groupBy(*_CHANNEL_KEYS).agg(
            *[F.sum(name).alias(name) for name in _channel_sums()]
        )
    )


def device_channel(sessions: DataFrame) -> DataFrame:
    """Sessions, conversion, bounce and churn per device, source and medium."""
    return _channel_report(
        sessions.groupBy(*_CHANNEL_KEYS).agg(
            *[c.alias(name) for name, c in _channel_sums().items()]
        )
    )


# -- user features ---------------------------------------------------------------------

# Output column -> event name it counts.
_USER_COUNTS = {
    "total_page_views": "page_view",
    "view_item_count": "view_item",
    "add_to_cart_count": "add_to_cart",
    "begin_checkout_count": "begin_checkout",
    "add_shipping_info_count": "add_shipping_info",
    "add_payment_info_count": "add_payment_info",
    "purchase_count": "purchase",
    "scroll_count": "scroll",
    "user_engagement_count": "user_engagement",
}


def _additive_user_measures() -> dict[str, Column]:
    measures = {name: count_event(event) for name, event in _USER_COUNTS.items()}
    measures["total_active_time"] = F.sum("param_engagement_time_msec")
    measures["total_events"] = F.count("*")
    return measures


def user_facts(stored: DataFrame) -> DataFrame:
    """(user, event_name, fact): each item a user viewed and each purchase, once."""
    name = F.col("event_name")
    fact = F.when(name == "view_item", F.col("item_name")).otherwise(F.col("transaction_id"))
    return (
        stored.where(name.isin("view_item", "purchase"))
        .select(USER, name, fact.alias("fact"))
        .where(F.col("fact").isNotNull())
        .distinct()
    )


def user_event_totals(stored: DataFrame, dedupe_events: bool = False) -> DataFrame:
    """Event counts, engagement and distinct sessions, items and purchases per user.

    Distinct values are counted as groups: events are first summed per user and session,
    and facts reduced to one row each, then both are added up per user. Several distinct
    counts in one aggregation would multiply every event row by their number.

    A row with no user id stands for no user: it keeps its place in the list but all its
    measures are NULL.
    """
    events = one_row_per_event(stored) if dedupe_events else stored
    additive = _additive_user_measures()
    one = F.lit(1).cast("long")
    session = F.col("param_ga_session_id")
    per_session = (
        events.groupBy(USER, session)
        .agg(*[c.alias(n) for n, c in additive.items()])
        .withColumn("session", F.when(session.isNotNull(), one))
        .drop("param_ga_session_id")
    )
    facts = user_facts(stored).select(
        USER, *[F.when(F.col("event_name") == e, one).alias(e) for e in ("view_item", "purchase")]
    )
    return added_up(per_session.unionByName(facts, allowMissingColumns=True))


# Output column -> kind of fact it counts.
FACT_COUNTS = {
    "total_sessions": "session",
    "unique_items_viewed": "view_item",
    "distinct_purchase_count": "purchase",
}


def added_up(parts: DataFrame) -> DataFrame:
    """Sums per user of the measures and of the ones that stand for facts."""
    totals = parts.groupBy(USER).agg(
        *[F.sum(n).alias(n) for n in _additive_user_measures()],
        *[
            F.coalesce(F.sum(kind), F.lit(0)).alias(name)
            for name, kind in FACT_COUNTS.items()
        ],
    )
    known = F.col(USER).isNotNull()
    return totals.withColumns(
        {n: F.when(known, F.col(n)) for n in totals.columns if n != USER}
    )


def user_day_totals(flat: DataFrame) -> DataFrame:
    """Additive measures per day and user: a new day adds rows and changes none."""
    measures = [c.alias(n) for n, c in _additive_user_measures().items()]
    return as_schema(flat.groupBy("event_date", USER).agg(*measures), USER_DAY_TOTALS)


def user_day_facts(flat: DataFrame) -> DataFrame:
    """Sessions, viewed items and purchases of a user on a day, each once.

    Facts that repeat are dropped in the scanning tasks, so one shuffle of facts is all; an
    event lists at most two.
    """
    name = F.col("event_name")
    facts = F.array(
        F.struct(F.lit("session").alias("kind"),
                 F.col("param_ga_session_id").cast("string").alias("fact")),
        F.struct(name.alias("kind"), F.when(name == "view_item", F.col("item_name"))
                 .when(name == "purchase", F.col("transaction_id")).alias("fact")),
    )
    rows = flat.select("event_date", USER, F.explode(facts).alias("f"))
    return as_schema(
        rows.select("event_date", USER, "f.kind", "f.fact").where("fact IS NOT NULL").distinct(),
        USER_DAY_FACTS,
    )


def user_event_totals_from_days(totals: DataFrame, facts: DataFrame) -> DataFrame:
    """As :func:`user_event_totals`, from the parts of all days.

    A session, item or purchase that several days know is one fact.
    """
    one = F.lit(1).cast("long")
    once = facts.select(USER, "kind", "fact").distinct()
    ones = once.select(
        USER, *[F.when(F.col("kind") == kind, one).alias(kind) for kind in FACT_COUNTS.values()]
    )
    return added_up(totals.drop("event_date").unionByName(ones, allowMissingColumns=True))


def user_event_totals_by_user(totals: DataFrame, facts: DataFrame) -> DataFrame:
    """As :func:`user_event_totals_from_days`, for parts that lie together by user.

    Both sides are added up where they lie and joined on the user, so tables bucketed by user
    are not shuffled. A user's facts come from the events that gave the user's totals.
    """
    once = facts.select(USER, "kind", "fact").distinct()
    counted = once.groupBy(USER).agg(
        *[F.count_if(F.col("kind") == kind).alias(kind) for kind in FACT_COUNTS.values()]
    )
    sums = totals.groupBy(USER).agg(*[F.sum(n).alias(n) for n in _additive_user_measures()])
    known = F.col(USER).isNotNull()
    joined = sums.join(counted, USER, "left").select(
        USER,
        *[F.when(known, F.col(n)).alias(n) for n in _additive_user_measures()],
        *[
            F.when(known, F.coalesce(kind, F.lit(0))).alias(name)
            for name, kind in FACT_COUNTS.items()
        ],
    )
    return joined


def user_session_totals(sessions: DataFrame) -> DataFrame:
    """First and last visit, active days and acquisition channel per user."""
    return sessions.groupBy(USER).agg(
        F.min("session_date").alias("first_visit_date"),
        F.max("session_date").alias("last_visit_date"),
        F.count_distinct("session_date").alias("days_active"),
        first_by(
            F.col("session_traffic_source"), F.col("session_date"), F.col("ga_session_id")
        ).alias("first_traffic_source"),
    )


def user_main_channel(sessions: DataFrame) -> DataFrame:
    """Most frequent device and traffic source per user."""
    return most_frequent(
        sessions,
        USER,
        {
            "main_device_category": "session_device",
            "main_traffic_source": "session_traffic_source",
        },
    )


def user_journey(sessions: DataFrame) -> DataFrame:
    """Funnel step and stage of the last and the previous session per user."""
    recent = latest_per_group(
        sessions.select(
            USER, "session_date", "ga_session_id", "session_funnel_step",
            "session_funnel_stage",
        ),
        USER,
        ["session_date", "ga_session_id"],
        2,
    )
    return pivot_by_rank(
        recent,
        USER,
        {
            "funnel_stage": ("session_funnel_stage", 1),
            "last_funnel_step": ("session_funnel_step", 1),
            "prev_funnel_stage": ("session_funnel_stage", 2),
            "prev_funnel_step": ("session_funnel_step", 2),
        },
    )


def user_features(
    stored: DataFrame,
    sessions: DataFrame,
    reference_date: date = DEFAULT_REFERENCE_DATE,
    churn_days: int = DEFAULT_GAP_DAYS,
    dedupe_events: bool = False,
) -> DataFrame:
    """One row per user of the accumulated events, with session features attached.

    The list of users is the set of groups of the event totals, so it needs no scan of
    its own. Every joined side has one row per user.
    """
    totals = user_event_totals(stored, dedupe_events)
    return user_features_of(totals, sessions, reference_date, churn_days)


def user_features_of(
    totals: DataFrame,
    sessions: DataFrame,
    reference_date: date = DEFAULT_REFERENCE_DATE,
    churn_days: int = DEFAULT_GAP_DAYS,
) -> DataFrame:
    """User features from event totals per user, however they were added up."""
    joined = (
        totals.join(user_session_totals(sessions), USER, "left")
        .join(user_main_channel(sessions), USER, "left")
        .join(user_journey(sessions), USER, "left")
    )
    reference = F.lit(reference_date)
    since_first = F.date_diff(reference, F.col("first_visit_date"))
    since_last = F.date_diff(reference, F.col("last_visit_date"))
    span = F.date_diff(F.col("last_visit_date"), F.col("first_visit_date"))
    bought = F.col("distinct_purchase_count")
    visits = F.col("total_sessions")
    zero = F.lit(0)
    features = joined.withColumns(
        {
            "is_purchaser": flag(bought > 0),
            "is_repeat_purchaser": flag(bought >= 2),
            "is_churned": flag(since_last > churn_days),
            # Step of the last session, whatever earlier sessions reached.
            "funnel_max_step": F.col("last_funnel_step"),
            "view_to_cart_rate": safe_ratio(
                F.col("add_to_cart_count"), F.col("view_item_count"), 4
            ),
            "cart_to_purchase_rate": safe_ratio(
                F.col("purchase_count"), F.col("add_to_cart_count"), 4
            ),
            "checkout_abandonment": F.col("begin_checkout_count") - F.col("purchase_count"),
            "avg_engagement_time_msec": safe_ratio(F.col("total_active_time"), visits, 2),
            "days_since_first_visit": since_first,
            "days_since_last_visit": since_last,
            "event_per_session": safe_ratio(F.col("total_events"), visits, 2),
            "visit_frequency": safe_ratio(F.col("days_active"), span, 4),
            "funnel_improvement": F.coalesce("last_funnel_step", zero)
            - F.coalesce("prev_funnel_step", zero),
        }
    )
    return as_schema(features, USER_FEATURES)
