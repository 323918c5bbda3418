"""One query per operator and per mart, over the derived input tables.

Dates are shown as text and fractions rounded, so that results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date
from functools import partial

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import StandardScalerModel, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.inputs import flat_table, nested_folder, nested_table, session_table
from eventloom.functions import geo_time, labels, scalars
from eventloom.functions.params import pivot_params
from eventloom.operators import grouping, ordering
from eventloom.plans import marts, scoring, sketches
from eventloom.plans.churn_state import revise_churn
from eventloom.plans.daily import (
    FEATURE_PARTS,
    as_date,
    ingest_days,
    refresh_marts,
    score_day,
    store_feature_parts,
)
from eventloom.plans.features import model_features, model_features_of
from eventloom.plans.flatten import flatten_events
from eventloom.schemas import DEVICE_CHANNEL, FUNNEL_DAILY, PREDICTIONS
from eventloom.sources.bucketed import UserTables
from eventloom.sources.csv_files import (
    load_csv,
    read_csv_shards,
    scan_csv,
    with_file_positions,
    write_csv,
    write_sorted_csv,
)
from eventloom.sources.guards import MissingInput, require_path, require_rows
from eventloom.sources.run_log import log_run, run_metrics
from eventloom.sources.scratch import new_dir
from eventloom.sources.warehouse import Warehouse, union_days
from eventloom.streaming.incremental import ingest_new_files

Query = Callable[[SparkSession, str], DataFrame]
USER = "user_pseudo_id"
SCORING_DAY = date(2020, 12, 19)
_registry: dict[str, Query] = {}


def _query(fn: Query) -> Query:
    _registry[fn.__name__] = fn
    return fn


def _named(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        _registry[name] = fn
        return fn

    return register


def queries() -> dict[str, Query]:
    return dict(_registry)


def _shown(df: DataFrame, **digits: int) -> DataFrame:
    """Dates as text; the named fractions rounded."""

    def shown(field: T.StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DateType):
            return column.cast("string").alias(field.name)
        if field.name in digits:
            return F.round(column, digits[field.name]).alias(field.name)
        return column

    return df.select(*[shown(f) for f in df.schema.fields])


# -- sources ---------------------------------------------------------------------------


@_query
def partition_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        flat_table(spark, sf_dir)
        .where(F.col("event_date") == "20201201")
        .select("event_date", USER, "event_name", "event_timestamp", "item_name")
    )


@_query
def parameterised_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = Warehouse(spark, new_dir(spark, "sql"))
    warehouse.append("orders", marts.orders(flat_table(spark, sf_dir)))
    return warehouse.sql(
        "SELECT event_date, count(*) AS n, count(DISTINCT user_pseudo_id) AS users "
        "FROM IDENTIFIER(:orders) WHERE event_date >= :since GROUP BY event_date",
        tables=["orders"],
        since="20201120",
    )


@_query
def parsed_date_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    sessions = session_table(spark, sf_dir)
    late = sessions.where(F.col("session_date") >= scalars.parse_day(F.lit("20201201")))
    return _shown(late.groupBy("session_date").agg(F.count("*").alias("n")))


@_query
def struct_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        nested_table(spark, sf_dir)
        .select(
            "event_bundle_sequence_id",
            "device.category",
            "device.web_info.browser",
            "geo.country",
            "traffic_source.source",
            "ecommerce.transaction_id",
        )
        .groupBy(
            "event_bundle_sequence_id", "category", "browser", "country", "source",
            "transaction_id",
        )
        .agg(F.count("*").alias("n"))
    )


# -- flattening ------------------------------------------------------------------------


@_query
def param_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parameters of every nested event; copies without a difference count as equal."""
    events = nested_table(spark, sf_dir).select("event_bundle_sequence_id", "event_params")
    rows = pivot_params(events)
    return rows.groupBy(*rows.columns).agg(F.count("*").alias("n"))


@_query
def explode_items_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = F.col("item")
    return (
        nested_table(spark, sf_dir)
        .select("event_bundle_sequence_id", "event_name", F.explode_outer("items").alias("item"))
        .groupBy(
            "event_bundle_sequence_id",
            "event_name",
            item["item_id"].alias("item_id"),
            item["price"].alias("price"),
            item["quantity"].alias("quantity"),
        )
        .agg(F.count("*").alias("n"))
    )


@_named("flatten_events")
def flatten_events_regroup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_events(nested_table(spark, sf_dir), merge="regroup")


@_query
def flatten_events_adaptive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_events(nested_table(spark, sf_dir), merge="adaptive")


@_query
def group_by_all_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        flatten_events(nested_table(spark, sf_dir))
        .groupBy("event_name")
        .agg(
            F.count("*").alias("n"),
            F.sum("param_engagement_time_msec").alias("engagement"),
            F.max("param_page_location").alias("last_page"),
        )
    )


# -- scalar functions ------------------------------------------------------------------


PLACES = (
    *((country, region) for country, region, _ in geo_time.REGION_OFFSETS),
    *((country, None) for country, _ in geo_time.COUNTRY_OFFSETS),
    *((country, "Elsewhere") for country, _ in geo_time.COUNTRY_OFFSETS),
    ("Atlantis", "California"), (None, "California"), (None, None),
)


@_query
def offset_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every listed place, and some that are not listed, dealt out over the events."""
    places = spark.createDataFrame(
        [(i, *place) for i, place in enumerate(PLACES)], "at int, country string, region string"
    )
    at = (F.col("event_id") % len(PLACES)).cast("int").alias("at")
    events = _source_events(spark, sf_dir).select(at).join(F.broadcast(places), "at")
    return (
        geo_time.with_offset_minutes(events)
        .groupBy("country", "region", "offset_minutes")
        .agg(F.count("*").alias("n"))
    )


@_query
def offset_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        flat_table(spark, sf_dir)
        .groupBy("offset_minutes", geo_time.offset_label(F.col("offset_minutes")).alias("gmt"))
        .agg(F.count("*").alias("n"))
    )


@_query
def local_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    micros, minutes = F.col("event_timestamp"), F.col("offset_minutes")
    wall = geo_time.local_timestamp(micros, minutes)
    return flat_table(spark, sf_dir).select(
        USER,
        "event_timestamp",
        geo_time.local_hour(micros, minutes).alias("hour_gmt"),
        F.date_format(wall, "yyyy-MM-dd HH:mm:ss").alias("local_time"),
    )


@_query
def month_and_weekday(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("event_date")
    return (
        flat_table(spark, sf_dir)
        .groupBy("event_date")
        .agg(F.count("*").alias("n"))
        .select(
            "event_date",
            scalars.month_of_day(day).alias("month"),
            scalars.weekday_of_day(day).alias("weekday"),
            scalars.dashed_day(day).alias("dashed"),
            "n",
        )
    )


def _source_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").withColumn(
        "k", F.get_json_object("props", "$.k").cast("long")
    )


@_query
def lenient_date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    days = (
        nested_table(spark, sf_dir)
        .select(F.col("event_bundle_sequence_id").alias("event_id"), "event_date")
        .distinct()
    )
    given = (
        F.when(k % 4 == 0, F.lit("not a day"))
        .when(k % 4 == 1, F.lit("20201399"))
        .otherwise(F.col("event_date"))
    )
    return (
        _source_events(spark, sf_dir)
        .join(days, "event_id")
        .groupBy(given.alias("given"))
        .agg(F.count("*").alias("n"))
        .select(
            "given",
            scalars.try_parse_day(F.col("given")).cast("string").alias("parsed"),
            "n",
        )
    )


@_query
def period_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        flat_table(spark, sf_dir)
        .groupBy(labels.period_label(F.col("event_date")).alias("period_label"))
        .agg(F.count("*").alias("n"), F.count_distinct("event_date").alias("days"))
    )


@_query
def text_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["event_bundle_sequence_id", "event_name", "event_params"]
    names = (
        pivot_params(nested_table(spark, sf_dir).select(*columns))
        .select(
            F.col("event_bundle_sequence_id").alias("event_id"),
            "event_name",
            F.lower("param_outbound").alias("outbound"),
        )
        .distinct()
    )
    k = F.col("k")
    return (
        _source_events(spark, sf_dir)
        .join(names, "event_id")
        .select(
            "event_name",
            F.concat("event_name", F.lit("-"), F.lpad(k.cast("string"), 4, "0")).alias("code"),
            "outbound",
            k.cast("double").alias("as_double"),
            k.cast("double").cast("string").alias("as_text"),
            (k % 2 == 0).cast("int").alias("is_even"),
        )
        .groupBy("event_name", "code", "outbound", "as_double", "as_text", "is_even")
        .agg(F.count("*").alias("n"))
    )


# -- aggregation -----------------------------------------------------------------------


@_query
def session_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.distinct_sessions(flat_table(spark, sf_dir))


@_query
def conditional_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.shipping_per_day(flat_table(spark, sf_dir))


@_query
def two_phase_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(marts.revenue_per_day(flat_table(spark, sf_dir)), daily_revenue=2)


@_query
def conditional_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.user_event_totals(flat_table(spark, sf_dir)).select(
        USER, "total_sessions", "unique_items_viewed", "distinct_purchase_count"
    )


@_query
def null_aware_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = scalars.count_distinct_with_null(F.col("param_page_location"))
    return flat_table(spark, sf_dir).groupBy(USER).agg(pages.alias("unique_pages"))


@_query
def representative_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = F.col("event_timestamp")
    return (
        flat_table(spark, sf_dir)
        .groupBy(USER)
        .agg(
            grouping.earliest(F.col("item_name"), seen).alias("first_item"),
            grouping.earliest(F.col("param_page_location"), seen).alias("first_page"),
        )
    )


@_query
def top_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.user_main_channel(session_table(spark, sf_dir))


@_query
def approx_top_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many sessions have the value the sketch names: the largest number, if it is right."""
    sessions = session_table(spark, sf_dir)
    top = grouping.most_frequent_approx(sessions, USER, "session_device", "top")
    counts = sessions.groupBy(USER, "session_device").agg(F.count("*").alias("sessions"))
    same = F.col("top").eqNullSafe(F.col("session_device"))
    return (
        top.withColumnRenamed(USER, "u")
        .join(counts, (F.col("u") == F.col(USER)) & same)
        .select(USER, "sessions")
    )


@_query
def frequent_values_from_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many sessions have the values that merged states of all days name."""
    sessions = session_table(spark, sf_dir)
    found = None
    for column in ("session_device", "session_traffic_source"):
        states = written_days(sketches.frequent_day_states(sessions, column), "session_date")
        top = sketches.most_frequent_from_days(states, "top").withColumnRenamed(USER, "u")
        counts = sessions.groupBy(USER, column).agg(F.count("*").alias(column + "_sessions"))
        same = (F.col("u") == F.col(USER)) & F.col("top").eqNullSafe(F.col(column))
        named = top.join(counts, same).select(USER, column + "_sessions")
        found = named if found is None else found.join(named, USER)
    return found


@_query
def first_value_by_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.user_session_totals(session_table(spark, sf_dir)).select(
        USER, "first_traffic_source"
    )


@_query
def safe_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = marts.user_event_totals(flat_table(spark, sf_dir))
    return totals.select(
        USER,
        scalars.safe_ratio(F.col("add_to_cart_count"), F.col("view_item_count"), 4).alias(
            "view_to_cart_rate"
        ),
        scalars.safe_ratio(F.col("purchase_count"), F.col("add_to_cart_count"), 4).alias(
            "cart_to_purchase_rate"
        ),
    )


# -- order, joins, unions --------------------------------------------------------------


@_query
def rank_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.user_journey(session_table(spark, sf_dir))


@_query
def top2_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    sessions = session_table(spark, sf_dir).select(
        USER, "session_date", "ga_session_id", "session_funnel_step"
    )
    return _shown(
        ordering.latest_per_group(sessions, USER, ["session_date", "ga_session_id"], 2)
    )


@_query
def lead_gap_churn(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = [USER, "session_date", "ga_session_id"]
    sessions = session_table(spark, sf_dir).select(*keys)
    return _shown(ordering.with_gap_flag(sessions, 15, "churn_session_flag"))


def _reached_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = (
        session_table(spark, sf_dir)
        .groupBy(
            F.col("session_date").alias("event_date"),
            F.col("session_funnel_step").alias("funnel_step"),
        )
        .agg(F.count("*").alias("session_cnt"))
    )
    return ordering.expand_reached_steps(
        counts, "funnel_step", "session_cnt", ["event_date"]
    )


@_query
def cumulative_funnel_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_reached_steps(spark, sf_dir))


@_query
def lead_drop_off(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(
        ordering.with_next_count(
            _reached_steps(spark, sf_dir), "event_date", "funnel_step", "session_cnt"
        )
    )


@_query
def left_join_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = flat_table(spark, sf_dir)
    users = flat.groupBy("event_date").agg(F.count_distinct(USER).alias("users"))
    bought = (
        flat.where(F.col("event_name") == "purchase")
        .groupBy("event_date")
        .agg(F.count("*").alias("purchases"))
    )
    return users.join(bought, "event_date", "left").withColumn(
        "purchases", F.coalesce("purchases", F.lit(0))
    )


@_query
def left_join_user_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    sessions = session_table(spark, sf_dir)
    return (
        marts.user_event_totals(flat_table(spark, sf_dir))
        .join(marts.user_session_totals(sessions), USER, "left")
        .join(marts.user_journey(sessions), USER, "left")
        .select(USER, "total_events", "days_active", "last_funnel_step")
    )


@_named("union_days")
def union_days_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two parts of the days with different columns, put together by name."""
    flat = flat_table(spark, sf_dir)
    day = F.col("event_date")
    with_tier = flat.where(day < "20201201").select(
        "param_shipping_tier", "event_date", "event_name"
    )
    later = flat.where(day >= "20201201").select(
        "event_name", "event_date", "param_shipping_tier", "source"
    )
    return (
        union_days(with_tier, later)
        .groupBy("event_date", "event_name")
        .agg(F.count("*").alias("n"), F.count("param_shipping_tier").alias("tiers"))
    )


@_query
def distinct_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_table(spark, sf_dir).select(USER).distinct()


# -- marts -----------------------------------------------------------------------------


@_query
def t1_daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(
        marts.daily_summary(flat_table(spark, sf_dir)),
        daily_revenue=2,
        daily_avg_order_value=4,
        daily_conversion_rate=4,
    )


@_query
def t1_daily_summary_exact_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(
        marts.daily_summary(flat_table(spark, sf_dir), exact_session_pairs=True),
        daily_revenue=2,
        daily_avg_order_value=4,
        daily_conversion_rate=4,
    )


@_query
def t2_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(marts.orders(flat_table(spark, sf_dir)), order_revenue=2)


@_query
def t2_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(marts.order_items(flat_table(spark, sf_dir)), item_revenue=2)


@_query
def t3_session_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(marts.session_funnel(flat_table(spark, sf_dir)))


@_query
def t3_session_funnel_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(marts.session_funnel(flat_table(spark, sf_dir), churn="history"))


@_query
def t3_session_funnel_deduped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(marts.session_funnel(flat_table(spark, sf_dir), dedupe_events=True))


@_query
def t4_funnel_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(marts.funnel_daily(session_table(spark, sf_dir)))


@_query
def t4_funnel_daily_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(marts.funnel_daily(session_table(spark, sf_dir), dense=True))


@_query
def t5_device_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = marts.device_channel(session_table(spark, sf_dir))
    return ordering.descending(
        report, "total_sessions", "session_device", "session_traffic_source"
    )


@_query
def t5_device_channel_from_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    partials = marts.device_channel_partials(session_table(spark, sf_dir))
    return marts.device_channel_from_partials(partials)


@_query
def t6_user_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.user_features(flat_table(spark, sf_dir), session_table(spark, sf_dir))


@_query
def t6_user_features_from_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = flat_table(spark, sf_dir)
    totals = marts.user_event_totals_from_days(
        marts.user_day_totals(flat), marts.user_day_facts(flat)
    )
    return marts.user_features_of(totals, session_table(spark, sf_dir))


# -- mergeable states ------------------------------------------------------------------


def written_days(rows: DataFrame, day: str) -> DataFrame:
    """Rows stored by day and read back, as a later run finds them."""
    path = new_dir(rows.sparkSession, "states")
    rows.write.partitionBy(day).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


@_query
def t6_distinct_from_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals per user from stored sketches; are the counts as close as they claim?"""
    flat = flat_table(spark, sf_dir)
    states = written_days(sketches.user_day_sketches(marts.user_day_facts(flat)), "event_date")
    about = sketches.user_event_totals_from_sketches(marts.user_day_totals(flat), states)
    counted = tuple(marts.FACT_COUNTS)
    exact = marts.user_event_totals(flat).select(
        F.col(USER).alias("u"), *[F.col(n).alias(f"exact_{n}") for n in counted]
    )
    rows = about.join(exact, F.col(USER).eqNullSafe(F.col("u")))
    close = [
        sketches.close_enough(F.col(n), F.col(f"exact_{n}")).alias(f"{n}_close") for n in counted
    ]
    return rows.select(USER, "total_events", "total_page_views", *close)


@_query
def trailing_distinct_from_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users and sessions of the seven days up to each day, from states, beside exact counts."""
    flat = flat_table(spark, sf_dir)
    states = written_days(sketches.day_sketches(flat), "event_date")
    about = sketches.trailing_counts(states, 7)
    day = scalars.parse_day(F.col("event_date"))
    seen = flat.select(
        day.alias("day"), USER, F.col("param_ga_session_id").alias("session")
    ).distinct()
    until = flat.select("event_date", day.alias("until")).distinct()
    exact = (
        seen.withColumn("until", F.explode(F.sequence("day", F.date_add("day", 6))))
        .join(until, "until")
        .groupBy("event_date")
        .agg(
            F.count_distinct(USER).alias("exact_users"),
            F.count_distinct(F.struct(USER, "session")).alias("pairs"),
            F.count_distinct(F.when(F.col("session").isNull(), F.struct(F.lit(1), USER))).alias("none"),
        )
    )
    exact_sessions = F.col("pairs") - F.col("none")
    return exact.join(about, "event_date").select(
        "event_date", "exact_users", exact_sessions.alias("exact_sessions"),
        sketches.close_enough(F.col("users"), F.col("exact_users")).alias("users_close"),
        sketches.close_enough(F.col("sessions"), exact_sessions).alias("sessions_close"),
    )


@_query
def returning_users_from_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users before December, since, and in both: intersected states beside exact counts."""
    flat = flat_table(spark, sf_dir)
    states = written_days(sketches.day_sketches(flat), "event_date")
    about = sketches.returning_users(states, "20201201")
    late = F.max((F.col("event_date") >= "20201201").cast("int")).alias("late")
    early = F.max((F.col("event_date") < "20201201").cast("int")).alias("early")
    exact = flat.groupBy(USER).agg(late, early).where(F.col(USER).isNotNull()).agg(
        F.sum("early").alias("before"), F.sum("late").alias("since"),
        F.count_if(F.col("early") + F.col("late") == 2).alias("returned"),
    )
    renamed = about.toDF(*[f"about_{c}" for c in about.columns])
    both = exact.join(F.broadcast(renamed))
    # The error of an intersection follows the larger of the two sets.
    bound = F.greatest(F.lit(1.0), 3 * sketches.ERROR * F.greatest("before", "since"))
    return both.select(
        *exact.columns,
        *[(F.abs(F.col(f"about_{c}") - F.col(c)) <= bound).alias(f"{c}_close") for c in exact.columns],
    )


# -- model features and scoring --------------------------------------------------------


@_query
def ml_user_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(
        model_features(flat_table(spark, sf_dir)),
        avg_engagement_time_msec=4,
        avg_session_number=4,
        view_to_cart_rate=4,
    )


def _feature_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Parts of the model features as stored day by day."""
    flat = flat_table(spark, sf_dir)
    days = _all_days(flat)
    warehouse = Warehouse(spark, new_dir(spark, "parts"))
    store_feature_parts(warehouse, flat, days)
    return tuple(warehouse.read(name) for name in FEATURE_PARTS)


@_query
def ml_user_features_from_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(
        model_features_of(*_feature_parts(spark, sf_dir)),
        avg_engagement_time_msec=4,
        avg_session_number=4,
        view_to_cart_rate=4,
    )


def _decided_by_formula(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probabilities from a fixed formula of the features, in place of a model."""
    c = F.col
    share = c("purchase_count") / c("total_events") * 6
    scored = model_features(flat_table(spark, sf_dir)).withColumns(
        {
            "purchase_probability": F.round(F.least(F.lit(1.0), share), 4),
            "churn_probability": F.round(
                1.0 / (1 + c("search_cnt") + c("outbound_cnt")), 4
            ),
        }
    )
    return scoring.with_decisions(scored)


@_query
def prediction_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(scoring.predictions(_decided_by_formula(spark, sf_dir), SCORING_DAY))


_FRACTIONS = {
    "predicted_purchase_rate": 4,
    "predicted_churn_rate": 4,
    "avg_purchase_probability": 4,
    "avg_churn_probability": 4,
    "trend_purchase_rate": 4,
    "trend_churn_rate": 4,
}


@_query
def prediction_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    trend = scoring.prediction_trend(_decided_by_formula(spark, sf_dir), SCORING_DAY)
    return _shown(trend, **_FRACTIONS)


@_query
def run_metrics_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    trend = scoring.prediction_trend(_decided_by_formula(spark, sf_dir), SCORING_DAY)
    return _shown(run_metrics(trend), value=4)


def _users_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model_features(flat_table(spark, sf_dir), by=(USER, "event_date"))


def _probabilities(scored: DataFrame, digits: int | None = None) -> DataFrame:
    p = F.get(scoring.vector_to_array("probability"), F.lit(1))
    return scored.select(USER, (p if digits is None else F.round(p, digits)).alias("probability"))


@_query
def score_purchase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A probability per user and day, from a model trained on them."""
    features = _users_by_day(spark, sf_dir)
    model = scoring.train_purchase(features)
    return _probabilities(model.transform(scoring.purchase_matrix(features)))


@_query
def score_churn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A probability per user, from a model of who came back after a cut-off."""
    flat = flat_table(spark, sf_dir)
    model = scoring.train_churn_on_history(flat, SCORING_DAY, 15)
    return _probabilities(model.transform(scoring.churn_matrix(model_features(flat))))


# Fixed values of models that are given, not trained: mean, deviation and weight of each
# feature, by its place in the list.
FIXED_INTERCEPT = -0.25


def fixed_values(n: int) -> list[tuple[float, float, float]]:
    return [(float(i + 1), 2.0 + i / 2, (0.3, -0.2, 0.1)[i % 3]) for i in range(n)]


def _fixed_model(spark: SparkSession, columns: Sequence[str]) -> PipelineModel:
    """The stages a trained model has, with the fixed values."""
    ml, values = spark._jvm.org.apache.spark.ml, fixed_values(len(columns))

    def vector(numbers: Sequence[float]):
        array = spark.sparkContext._gateway.new_array(spark._jvm.double, len(numbers))
        for i, number in enumerate(numbers):
            array[i] = number
        return ml.linalg.Vectors.dense(array)

    means, deviations, weights = (vector(v) for v in zip(*values, strict=True))
    scaler = StandardScalerModel(ml.feature.StandardScalerModel("fixed", deviations, means))
    scaler._set(inputCol="raw_vector", outputCol="vector", withMean=True, withStd=True)
    regression = LogisticRegressionModel(
        ml.classification.LogisticRegressionModel("fixed", weights, FIXED_INTERCEPT)
    )
    regression._set(featuresCol="vector")
    assembler = VectorAssembler(inputCols=list(columns), outputCol="raw_vector")
    return PipelineModel([assembler, scaler, regression])


@_query
def score_purchase_fixed_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = _fixed_model(spark, scoring.PURCHASE_FEATURES)
    matrix = scoring.purchase_matrix(model_features(flat_table(spark, sf_dir)))
    return _probabilities(model.transform(matrix), 4)


@_query
def score_churn_fixed_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = _fixed_model(spark, scoring.CHURN_FEATURES)
    matrix = scoring.churn_matrix(model_features(flat_table(spark, sf_dir)))
    return _probabilities(model.transform(matrix), 4)


@_query
def score_purchase_from_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model trained on users' days from parts: does it score as the direct one does?"""
    parts = _feature_parts(spark, sf_dir)
    features = model_features_of(*parts, by=(USER, "event_date"))
    model = scoring.train_purchase(features)
    direct = scoring.train_purchase(_users_by_day(spark, sf_dir))
    return _agreeing(model_features_of(*parts), model, direct, scoring.purchase_matrix)


@_query
def score_churn_from_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model of who came back, from parts: does it score as the direct one does?"""
    parts = _feature_parts(spark, sf_dir)
    model = scoring.train_churn_on_parts(*parts, SCORING_DAY, 15)
    direct = scoring.train_churn_on_history(flat_table(spark, sf_dir), SCORING_DAY, 15)
    return _agreeing(model_features_of(*parts), model, direct, scoring.churn_matrix)


def _agreeing(
    features: DataFrame,
    model: PipelineModel,
    direct: PipelineModel,
    matrix: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Users with their events, and whether two models give them one probability."""
    p = F.get(scoring.vector_to_array("probability"), F.lit(1))
    first = model.transform(matrix(features)).withColumn("first", p)
    used = ("raw_vector", "vector", "rawPrediction", "probability", "prediction")
    both = direct.transform(first.drop(*used)).withColumn("second", p)
    close = F.abs(F.col("first") - F.col("second")) < 1e-6
    return both.select(USER, "total_events", close.alias("same"), F.col("first").between(0, 1).alias("valid"))


@_query
def model_label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = scoring.purchase_matrix(_users_by_day(spark, sf_dir))
    return (
        features.withColumn("bought", scoring.purchase_label())
        .groupBy("bought")
        .agg(F.count("*").alias("n"), F.sum("total_events").alias("events"))
    )


def _ingested(spark: SparkSession, sf_dir: str, *parts: list[str], **options) -> Warehouse:
    """A warehouse after a daily run for each list of days."""
    nested = nested_table(spark, sf_dir)
    warehouse = Warehouse(spark, new_dir(spark, "daily"))
    for days in parts:
        ingest_days(warehouse, nested, days)
        refresh_marts(warehouse, days, **options)
    return warehouse


@_query
def daily_scoring_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingest, refresh, train and score the newest day; decisions as their probabilities say."""
    nested = nested_table(spark, sf_dir)
    days = _all_days(nested)
    newest = days[-1]
    warehouse = Warehouse(spark, new_dir(spark, "scoring"))
    ingest_days(warehouse, nested, days)
    refresh_marts(warehouse, [newest])
    score_day(warehouse, newest, new_dir(spark, "models"))
    c = F.col
    trend = warehouse.read("prediction_trend").select("prediction_date", "total_users")
    right = (
        c("purchase_probability").between(0, 1)
        & c("churn_probability").between(0, 1)
        & (c("predicted_purchase") == (c("purchase_probability") >= 0.825).cast("int"))
        & (c("predicted_churn") == (c("churn_probability") >= 0.65).cast("int"))
        & (c("value_segment") == labels.value_tier(c("purchase_probability")))
        & (c("risk_segment") == labels.risk_tier(c("churn_probability")))
    )
    rows = warehouse.read("predictions").join(F.broadcast(trend), "prediction_date")
    return _shown(rows.select(USER, "prediction_date", "total_users", right.alias("right")))


@_query
def empty_day_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day without users: no predictions, a trend row of zeros, no model needed."""
    days = [_all_days(flat_table(spark, sf_dir))[-1], "20210101"]
    warehouse = Warehouse(spark, new_dir(spark, "empty"))
    ingest_days(warehouse, nested_table(spark, sf_dir), days)
    score_day(warehouse, "20210101", new_dir(spark, "models"))
    none = warehouse.read("predictions").agg(F.count("*").alias("predicted"))
    return _shown(warehouse.read("prediction_trend").crossJoin(none))


@_query
def history_churn_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Churn flags as stored after two daily runs; the second changes flags of the first."""
    days = _all_days(nested_table(spark, sf_dir))
    early = [d for d in days if d <= "20201205"]
    warehouse = _ingested(spark, sf_dir, early, days[len(early) :], churn="history")
    stored = warehouse.read("session_funnel")
    return _shown(stored.drop("session_engagement_time"))


@_query
def history_churn_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags kept by the state per user: most days at once, then one by one, one again."""
    sessions = marts.session_funnel(flat_table(spark, sf_dir))
    warehouse = Warehouse(spark, new_dir(spark, "churn"))
    days = [as_date(d) for d in _all_days(flat_table(spark, sf_dir))]
    for part in (days[:-6], *[[d] for d in days[-6:]], [days[-2]]):
        rows = sessions.where(F.col("session_date").isin(*part))
        warehouse.replace_days("session_funnel", rows, part)
        revise_churn(warehouse, part, marts.DEFAULT_GAP_DAYS)
    return _shown(warehouse.read("session_funnel"))


# -- writing ---------------------------------------------------------------------------


@_query
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_dir(spark, "csv")
    write_csv(scoring.predictions(_decided_by_formula(spark, sf_dir), SCORING_DAY), path)
    return _shown(read_csv_shards(spark, f"{path}/*.csv", PREDICTIONS))


def _all_days(events: DataFrame) -> list[str]:
    return sorted(r[0] for r in events.select("event_date").distinct().collect())


@_query
def t4_sorted_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily funnel as files in the order of day and step; every row with its place."""
    path = new_dir(spark, "sorted")
    funnel = marts.funnel_daily(session_table(spark, sf_dir))
    write_sorted_csv(funnel.repartition(5), path, "event_date", "funnel_step")
    rows = spark.read.schema(FUNNEL_DAILY).option("header", True).csv(path)
    placed = with_file_positions(rows)
    return _shown(placed.select("position", "event_date", "funnel_step", "session_cnt"))


@_query
def t5_sorted_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Device x channel from most to fewest sessions, every row with its place."""
    path = new_dir(spark, "sorted")
    keys = ("session_device", "session_traffic_source", "session_traffic_medium")
    channels = marts.device_channel(session_table(spark, sf_dir))
    write_sorted_csv(channels, path, F.col("total_sessions").desc(), *keys)
    rows = spark.read.schema(DEVICE_CHANNEL).option("header", True).csv(path)
    return with_file_positions(rows).select("position", *keys, "total_sessions")


@_query
def key_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User keys read as whole numbers, fractions and decimals, as text again; NULL stays."""
    flat = flat_table(spark, sf_dir)
    user = F.when(F.col(USER).cast("long") % 7 != 0, F.col(USER).cast("long"))
    wide = user * 1_000_003 + 12_000_000_000
    keys = {
        "whole": (user, T.LongType()),
        "double": (wide.cast("double"), T.DoubleType()),
        "half": (user + F.lit(0.5), T.DoubleType()),
        "decimal": ((user / 4).cast("decimal(20,6)"), T.DecimalType(20, 6)),
    }
    texts = [scalars.key_text(key, kind).alias(name) for name, (key, kind) in keys.items()]
    return flat.groupBy(USER).agg(F.count("*").alias("n")).select(USER, "n", *texts)


@_query
def csv_scan_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions written with their columns in another order."""
    path = new_dir(spark, "csv")
    rows = scoring.predictions(_decided_by_formula(spark, sf_dir), SCORING_DAY)
    write_csv(rows.select(*sorted(rows.columns, reverse=True)), path)
    return _shown(scan_csv(spark, path, PREDICTIONS))


@_query
def csv_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with columns in two orders, one lacking a column and one with an unknown one."""
    root = new_dir(spark, "csv")
    rows = scoring.predictions(_decided_by_formula(spark, sf_dir), SCORING_DAY)
    even = F.col(USER).cast("long") % 2 == 0
    write_csv(rows.where(even).withColumn("note", F.lit("x, y")), f"{root}/a")
    rest = rows.where(~even).drop("risk_segment")
    write_csv(rest.select(*sorted(rest.columns)), f"{root}/b")
    return _shown(read_csv_shards(spark, f"{root}/*/*.csv", PREDICTIONS))


@_query
def csv_load_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files with two column orders loaded twice into a table."""
    path = new_dir(spark, "csv")
    warehouse = Warehouse(spark, new_dir(spark, "loaded"))
    rows = scoring.predictions(_decided_by_formula(spark, sf_dir), SCORING_DAY)
    part = F.pmod(F.xxhash64(USER), F.lit(2))
    for k, names in enumerate((sorted(rows.columns), sorted(rows.columns, reverse=True))):
        write_csv(rows.where(part == k).select(*names), f"{path}/{k}")
    for infer in (False, True):
        load_csv(warehouse, f"{path}/*", "predictions", infer=infer)
    stored = _shown(warehouse.read("predictions"))
    return stored.groupBy(*stored.columns).agg(F.count("*").alias("copies"))


@_query
def replace_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of all days, then one day with other rows and one day emptied; others stay."""
    orders = marts.orders(flat_table(spark, sf_dir))
    warehouse = Warehouse(spark, new_dir(spark, "replace"))
    for _ in range(2):
        warehouse.replace_days("orders", orders, _all_days(flat_table(spark, sf_dir)))
    day = F.col("event_date")
    changed = orders.where((day == "20201201") & (F.col("item_count") > 1))
    for _ in range(2):
        warehouse.replace_days("orders", changed, ["20201201", "20201202"])
    return _shown(warehouse.read("orders"), order_revenue=2)


@_query
def replace_whole_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written from some sessions, then replaced by that of all."""
    sessions = session_table(spark, sf_dir)
    warehouse = Warehouse(spark, new_dir(spark, "whole"))
    few = sessions.where(F.col("session_device") == "mobile")
    for rows in (few, sessions):
        warehouse.replace_all("device_channel", marts.device_channel(rows))
    return warehouse.read("device_channel")


@_query
def accumulate_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days accumulated twice, replacing: one copy of each."""
    days = ["20201201", "20201202"]
    warehouse = Warehouse(spark, new_dir(spark, "accumulate"))
    for _ in range(2):
        ingest_days(warehouse, nested_table(spark, sf_dir), days, accumulate="replace_days")
    return (
        warehouse.read("stored_events")
        .groupBy("event_date", "event_name")
        .agg(F.count("*").alias("n"))
    )


@_query
def results_per_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions of two dates in one table; one date is read, through its partition."""
    decided = _decided_by_formula(spark, sf_dir)
    warehouse = Warehouse(spark, new_dir(spark, "dates"))
    for when in (date(2020, 12, 18), SCORING_DAY):
        warehouse.replace_days("predictions", scoring.predictions(decided, when), [when])
    return _shown(warehouse.read("predictions", [SCORING_DAY]))


def _refused(check: Callable[[], object]) -> bool:
    try:
        check()
    except MissingInput:
        return True
    return False


@_query
def guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the guards say about an input that is there, one that is not and an empty one."""
    flat = flat_table(spark, sf_dir)
    nobody = flat.where(F.col(USER) == "nobody")
    found = {
        "path_refused": _refused(lambda: require_path(spark, f"{sf_dir}/no_such_table")),
        "empty_refused": _refused(lambda: require_rows(nobody, "events")),
        "rows_refused": _refused(lambda: require_rows(flat, "events")),
    }
    return flat.agg(F.count("*").alias("n")).withColumns(
        {name: F.lit(value) for name, value in found.items()}
    )


@_query
def run_params_and_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    trend = scoring.prediction_trend(_decided_by_formula(spark, sf_dir), SCORING_DAY)
    warehouse = Warehouse(spark, new_dir(spark, "runs"))
    log_run(warehouse, trend, {"t7_path": "predictions"}, source="checks")
    run = warehouse.read("runs")
    return _shown(
        run.select(
            "run_name", "prediction_date", F.col("params")["t7_path"].alias("t7_path"),
            *[F.col("tags")[t].alias(t) for t in ("run_type", "source")],
        )
    )


@_query
def append_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders appended twice: every row is there twice."""
    warehouse = Warehouse(spark, new_dir(spark, "append"))
    for _ in range(2):
        warehouse.append("orders", marts.orders(flat_table(spark, sf_dir)))
    stored = _shown(warehouse.read("orders"), order_revenue=2)
    return stored.groupBy(*stored.columns).agg(F.count("*").alias("copies"))


@_query
def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested events as a landing folder, picked up by the stream, to the stored funnel."""
    warehouse = Warehouse(spark, new_dir(spark, "warehouse"))
    # The table's folder is one of files by day, as they land; a copy of it adds nothing.
    landing = nested_folder(spark, sf_dir)
    ingest_new_files(
        warehouse, landing, new_dir(spark, "stream"),
        refresh=partial(refresh_marts, churn="history"),
    )
    funnel = warehouse.read("funnel_daily")
    return _shown(funnel.select("event_date", "funnel_step", "session_cnt", "drop_off_cnt"))


@_query
def incremental_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of files, the second with rows of the first again, merged by digests."""
    landing, checkpoint = new_dir(spark, "landing"), new_dir(spark, "stream")
    warehouse = Warehouse(spark, new_dir(spark, "warehouse"))
    nested = nested_table(spark, sf_dir)
    third = F.pmod(F.col("event_bundle_sequence_id"), F.lit(3))
    for chosen, refresh in ((third < 2, None), (third > 0, refresh_marts)):
        nested.where(chosen).write.mode("append").partitionBy("event_date").parquet(landing)
        ingest_new_files(warehouse, landing, checkpoint, refresh=refresh, late="merge")
    return _shown(warehouse.read("funnel_daily"))


@_query
def t6_user_features_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User features from parts and sessions that lie together by user."""
    flat = flat_table(spark, sf_dir)
    tables = UserTables(spark, new_dir(spark, "by-user"))
    tables.replace_days("user_day_totals", marts.user_day_totals(flat))
    tables.replace_days("user_day_facts", marts.user_day_facts(flat))
    tables.replace_days("session_funnel", marts.session_funnel(flat, churn="history"))
    totals = marts.user_event_totals_by_user(
        tables.read("user_day_totals"), tables.read("user_day_facts")
    )
    return marts.user_features_of(totals, tables.read("session_funnel"))
