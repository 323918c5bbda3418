"""The derived input against the summary values that were checked in two engines.

Those values leave out the rows whose day is moved to before 2020-11-20.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.fixture import flat_events, nested_events
from checks.inputs import flat_table, nested_table
from eventloom.functions.labels import period_label
from eventloom.plans.flatten import flatten_events


def test_known_summaries(spark, sf_dir):
    flat = flat_table(spark, sf_dir)
    kept = flat.where(F.col("event_date") >= "20201120")
    session = F.col("param_ga_session_id")
    row = kept.agg(
        F.count("*"),
        F.count_distinct("user_pseudo_id"),
        F.count_if(session.isNull()),
        F.count_if(F.col("item_name").isNull()),
        F.count_distinct("user_pseudo_id", session, "event_date"),
        F.count_if(F.col("event_name") == "purchase"),
        F.count_if(F.col("event_name") == "view_item"),
        F.count_distinct("transaction_id"),
        F.count_if(F.col("param_search_term").isNotNull()),
        F.round(F.sum(F.col("price") * F.col("quantity")), 2),
    ).first()
    assert tuple(row) == (1132, 15, 11, 576, 648, 101, 359, 37, 22, 1254380.10)
    periods = kept.groupBy(period_label(F.col("event_date")).alias("p")).count().collect()
    assert {r["p"]: r["count"] for r in periods} == {
        "black_friday": 334, "normal": 398, "christmas": 400,
    }


def test_flattening_the_nested_form_gives_the_flat_form(spark, sf_dir):
    flat = flat_table(spark, sf_dir)
    columns = [c for c in flat.columns if c != "param_engagement_time_msec"]
    flattened = flatten_events(nested_table(spark, sf_dir)).select(*columns)
    assert flattened.exceptAll(flat.select(*columns)).isEmpty()
    assert flat.select(*columns).exceptAll(flattened).isEmpty()


def test_session_zone_does_not_matter(spark, sf_dir):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    spark.conf.set("spark.sql.constraintPropagation.enabled", "false")
    try:
        columns = ["user_pseudo_id", "event_timestamp", "event_date", "param_ga_session_id"]
        elsewhere = flat_events(spark, sf_dir).select(*columns).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
        spark.conf.set("spark.sql.constraintPropagation.enabled", "true")
    assert sorted(elsewhere, key=str) == sorted(
        flat_table(spark, sf_dir).select(*columns).collect(), key=str
    )


def test_items_are_joined_to_short_rows(spark, tmp_path):
    """The joins shuffle the columns of the source, not all those that follow from them."""
    spark.sql(
        "SELECT 1L AS event_id, TIMESTAMP_NTZ '2024-01-01 00:00:11' AS ts, 1L AS user_id, "
        "'view' AS event_type, 1.5D AS value, '{\"k\": 1}' AS props"
    ).write.parquet(f"{tmp_path}/events.parquet")
    spark.sql(
        "SELECT 0L AS p_partkey, 'bolt' AS p_name, 'b' AS p_brand, 't' AS p_type, "
        "900.0D AS p_retailprice"
    ).write.parquet(f"{tmp_path}/part.parquet")
    for build in (flat_events, nested_events):
        rows = build(spark, str(tmp_path))
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert "param_page_location" not in plan[plan.index("Join LeftOuter") :]
        assert rows.count() == (2 if build is flat_events else 1)
