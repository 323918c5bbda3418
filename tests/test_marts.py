from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from checks.inputs import flat_table, session_table
from eventloom import schemas
from eventloom.operators import grouping, ordering
from eventloom.plans import marts
from eventloom.plans.features import model_features
from eventloom.schemas import SESSION_FUNNEL, conform

BUY = {"event_name": "purchase", "transaction_id": "t1", "purchase_revenue": 10.0}
US_PER_HOUR = 3_600_000_000


def sessions(spark, *rows):
    """Session rows from (user, session id, day, step, device, source)."""
    defaults = {
        f.name: {"string": "x", "bigint": 1, "int": 1}.get(f.dataType.simpleString())
        for f in SESSION_FUNNEL.fields
    }
    names = (
        "user_pseudo_id", "ga_session_id", "session_date", "session_funnel_step",
        "session_device", "session_traffic_source",
    )
    filled = [defaults | dict(zip(names, r, strict=False)) for r in rows]
    return spark.createDataFrame(filled, SESSION_FUNNEL)


def test_daily_summary_counts_a_transaction_once(flat):
    df = flat(
        BUY | {"item_name": "a"}, BUY | {"item_name": "b"},
        BUY | {"transaction_id": None, "purchase_revenue": 99.0},
        {"event_date": "20201202", "param_ga_session_id": 2},
        {"event_date": "20201203", "param_ga_session_id": None},
    )
    rows = {r.event_date: r for r in marts.daily_summary(df).collect()}
    assert set(rows) == {"20201201", "20201202"}
    first, second = rows["20201201"], rows["20201202"]
    assert (first.daily_revenue, first.daily_transactions) == (10.0, 1)
    assert (first.daily_avg_order_value, first.daily_conversion_rate) == (10.0, 1.0)
    assert (second.daily_revenue, second.daily_transactions) == (0.0, 0)
    assert second.daily_avg_order_value is None and second.daily_conversion_rate == 0.0


def test_glued_session_keys_can_collide(flat):
    df = flat(
        {"user_pseudo_id": "1", "param_ga_session_id": 23},
        {"user_pseudo_id": "12", "param_ga_session_id": 3},
    )
    assert marts.daily_summary(df).first().daily_sessions == 1
    assert marts.daily_summary(df, exact_session_pairs=True).first().daily_sessions == 2


def test_orders(flat):
    item = {"price": 2.0, "quantity": 3}
    df = flat(
        BUY | item | {"item_name": "a"}, BUY | item | {"item_name": "a"},
        BUY | item | {"item_name": "b", "transaction_id": "t2"},
        BUY | item | {"item_name": "c", "transaction_id": "t2"},
        BUY | {"transaction_id": "t3"},
    )
    rows = {r.transaction_id: r for r in marts.orders(df).collect()}
    got = {t: (r.order_revenue, r.item_count, r.is_bundle_order) for t, r in rows.items()}
    assert got == {"t1": (12.0, 1, 0), "t2": (12.0, 2, 1), "t3": (None, 0, 0)}
    assert rows["t1"].order_date == date(2020, 12, 1) and rows["t1"].order_month == "2020-12"
    assert marts.order_items(df).count() == 4


def test_session_values_come_from_the_earliest_row(flat):
    start = 1_606_780_800_000_000
    df = flat(
        {"event_timestamp": start, "category": None, "source": None, "medium": None},
        {"event_timestamp": start + 2, "category": "z", "offset_minutes": -210},
        {"event_timestamp": start + 2, "category": "a", "offset_minutes": -210},
        {"event_timestamp": start + 3, "source": "s", "param_engagement_time_msec": 5},
    )
    row = conform(marts.session_funnel(df), SESSION_FUNNEL).first()
    assert row.session_device == "a"
    assert row.session_traffic_source == "google"
    assert row.session_hour == 0
    assert (row.session_event_count, row.session_engagement_time) == (4, 5)
    assert row.session_weekday == "Tuesday"


@pytest.mark.parametrize(
    ("events", "step"),
    [
        (["scroll"], 1),
        (["page_view", "view_item"], 2),
        (["add_to_cart"], 3),
        (["begin_checkout", "add_to_cart"], 4),
        (["add_shipping_info"], 5),
        (["add_payment_info"], 5),
        (["purchase", "view_item"], 6),
    ],
)
def test_funnel_steps(flat, events, step):
    row = marts.session_funnel(flat(*[{"event_name": e} for e in events])).first()
    assert row.session_funnel_step == step
    assert row.bounce_flag == (0 if step == 6 else 1)
    assert row.purchase_flag == (1 if step == 6 else 0)


def test_churn_gap_of_fifteen_and_sixteen_days(spark):
    df = sessions(
        spark,
        ("a", 1, date(2020, 12, 1)), ("a", 2, date(2020, 12, 16)),
        ("b", 1, date(2020, 12, 1)), ("b", 3, date(2020, 12, 1)), ("b", 2, date(2020, 12, 17)),
        (None, 1, date(2020, 12, 1)), (None, 2, date(2020, 12, 31)),
        ("c", 1, date(2020, 12, 1)),
    )
    flagged = {
        (r.user_pseudo_id, r.ga_session_id)
        for r in marts.with_history_churn(df).where("churn_session_flag = 1").collect()
    }
    assert flagged == {("b", 3), (None, 1)}
    assert marts.with_history_churn(df).count() == 8


def test_unknown_churn_mode(flat):
    with pytest.raises(ValueError, match="unknown churn"):
        marts.session_funnel(flat({}), churn="weekly")


def test_funnel_without_the_last_steps(spark):
    df = sessions(
        spark, ("a", 1, date(2020, 12, 1), 1), ("a", 2, date(2020, 12, 1), 3),
        ("b", 1, date(2020, 12, 1), 3),
    )
    rows = marts.funnel_daily(df).orderBy("funnel_step").collect()
    assert [(r.session_cnt, r.drop_off_cnt) for r in rows] == [(3, 1), (2, 0), (2, 2)]
    assert [r.cumulative_pass_rate for r in rows] == [1.0, 0.6667, 0.6667]
    dense = marts.funnel_daily(df, dense=True).orderBy("funnel_step").collect()
    assert [r.session_cnt for r in dense] == [3, 2, 2, 0, 0, 0]
    assert dense[3].drop_off_rate is None and dense[3].drop_off_cnt == 0


def test_most_frequent_ties_and_nulls(spark):
    df = sessions(
        spark,
        ("a", 1, date(2020, 12, 1), 1, "mobile", None),
        ("a", 2, date(2020, 12, 1), 1, "desktop", None),
        ("a", 3, date(2020, 12, 2), 1, None, "s"),
        ("b", 1, date(2020, 12, 1), 1, None, "s"),
        ("b", 2, date(2020, 12, 1), 1, "tablet", None),
    )
    rows = {r.user_pseudo_id: r for r in marts.user_main_channel(df).collect()}
    assert rows["a"].main_device_category == "desktop"
    assert rows["a"].main_traffic_source is None
    assert rows["b"].main_device_category == "tablet"
    assert rows["b"].main_traffic_source == "s"


def test_approximate_top_value_agrees_when_clear(spark):
    rows = [("a", i, date(2020, 12, 1), 1, "m" if i % 3 else "d", "s") for i in range(9)]
    top = grouping.most_frequent_approx(
        sessions(spark, *rows), "user_pseudo_id", "session_device", "top"
    )
    assert top.first().top == "m"


def test_user_features_of_one_session_and_of_no_user(spark, flat):
    df = flat(
        {}, BUY | {"user_pseudo_id": "v"}, BUY | {"user_pseudo_id": "v", "transaction_id": "t9"},
        {"user_pseudo_id": None}, {"user_pseudo_id": "w", "param_ga_session_id": None},
    )
    features = conform(
        marts.user_features(df, marts.session_funnel(df)), schemas.USER_FEATURES
    )
    rows = {r.user_pseudo_id: r for r in features.collect()}
    assert set(rows) == {"u", "v", "w", None}
    assert rows["u"].visit_frequency is None and rows["u"].prev_funnel_stage is None
    assert rows["u"].funnel_improvement == rows["u"].funnel_max_step == 1
    assert (rows["v"].is_purchaser, rows["v"].is_repeat_purchaser) == (1, 1)
    assert rows["u"].days_since_last_visit == 46 and rows["u"].is_churned == 1
    assert rows[None].total_page_views is None and rows[None].is_purchaser == 0
    assert rows["w"].total_sessions == 0 and rows["w"].event_per_session is None
    assert rows["w"].is_churned == 0 and rows["w"].funnel_stage is None
    late = marts.user_features(
        df, marts.session_funnel(df), reference_date=date(2020, 12, 16)
    )
    assert {r.is_churned for r in late.collect()} == {0}


def test_dedupe_events_counts_an_event_once(flat):
    view = {"event_name": "view_item", "param_engagement_time_msec": 7}
    df = flat(view | {"item_name": "a"}, view | {"item_name": "b"})
    plain = marts.session_funnel(df).first()
    once = marts.session_funnel(df, dedupe_events=True).first()
    assert (plain.session_view_item_count, plain.session_engagement_time) == (2, 14)
    assert (once.session_view_item_count, once.session_engagement_time) == (1, 7)
    t3 = marts.session_funnel(df)
    user = marts.user_features(df, t3, dedupe_events=True).first()
    assert (user.view_item_count, user.unique_items_viewed) == (1, 2)


def test_model_features_count_null_as_a_value(flat):
    df = flat(
        {"param_ga_session_number": None, "param_outbound": "YES"},
        {"param_ga_session_id": None, "param_page_location": "/a", "param_outbound": "no"},
        {"event_timestamp": None, "param_percent_scrolled": 50, "param_search_term": ""},
    )
    row = conform(model_features(df), schemas.MODEL_FEATURES).first()
    assert (row.ga_session_id_count, row.unique_pages, row.total_events) == (2, 2, 2)
    assert row.avg_session_number == pytest.approx(2 / 3)
    assert row.avg_engagement_time_msec is None
    assert (row.outbound_cnt, row.scroll_count, row.search_cnt) == (1, 1, 1)
    assert row.view_to_cart_rate == 0.0


def test_latest_per_group_cuts_before_the_shuffle(spark, sf_dir):
    recent = marts.user_journey(session_table(spark, sf_dir))
    plan = recent._jdf.queryExecution().executedPlan().toString()
    partial = plan.index("row_number(), 2, Partial")
    assert plan.index("hashpartitioning(user_pseudo_id") < partial


def test_user_features_plan(spark, sf_dir):
    df = marts.user_features(flat_table(spark, sf_dir), session_table(spark, sf_dir))
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("Expand", "CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert bad not in plan


def test_relations_between_marts(spark, sf_dir):
    flat, t3 = flat_table(spark, sf_dir), session_table(spark, sf_dir)
    t4, t5 = marts.funnel_daily(t3).cache(), marts.device_channel(t3)
    per_day = {r[0]: r[1] for r in t3.groupBy("session_date").count().collect()}
    for row in t4.where("funnel_step = 1").collect():
        assert row.session_cnt == per_day[row.event_date]
    assert t4.where("drop_off_cnt < 0").isEmpty()
    assert t5.agg(F.sum("total_sessions")).first()[0] == t3.count()
    users = flat.select("user_pseudo_id").distinct().count()
    assert marts.user_features(flat, t3).count() == users
    assert model_features(flat).count() == users
    first = ordering.latest_per_group(t3, "user_pseudo_id", ["session_date"], 1)
    assert first.count() == users


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_of_sessions_and_days(spark, sf_dir):
    table = flat_table(spark, sf_dir)
    summary = plan_of(marts.daily_summary(table))
    assert "Expand" not in summary
    assert summary.count("FileScan") == 2
    sessions = plan_of(marts.session_funnel(table)).splitlines()
    scan = next(i for i, line in enumerate(sessions) if "FileScan" in line)
    nearest = next(line for line in reversed(sessions[:scan]) if "Aggregate" in line)
    assert "HashAggregate" in nearest
