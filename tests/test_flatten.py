from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from eventloom.functions.params import PARAM_SPECS, pivot_params
from eventloom.plans import flatten
from eventloom.plans.flatten import flatten_events, one_row_per_event
from eventloom.schemas import FLAT_EVENT, NESTED_EVENT, conform

ITEM_A = {"item_name": "a", "price": 2.0, "quantity": 3}
ITEM_B = {"item_name": "b", "price": 1.0, "quantity": 1}


def pivot(df):
    return pivot_params(df.select("event_params")).first().asDict()


def test_params_empty_and_null(nested):
    for params in ([], None):
        row = pivot(nested({"event_params": params}))
        assert set(row) == {s.column for s in PARAM_SPECS}
        assert set(row.values()) == {None}


def test_params_by_slot(nested):
    row = pivot(
        nested(
            {
                "event_params": [
                    ("campaign", "c"),
                    ("entrances", 4),
                    ("session_engaged", 1),
                    ("tax", 2),
                    ("value", 2.5),
                    ("transaction_id", "t"),
                    ("source", 7),
                    ("unknown", "x"),
                ]
            }
        )
    )
    assert row["param_campaign"] == "c"
    assert row["param_entrances"] == 4
    assert row["param_session_engaged"] == "1"
    assert row["param_tax"] == "2.0"
    assert row["param_value"] == "2.5"
    assert row["param_transaction_id"] == "t"
    assert row["param_source"] is None


def test_repeated_key_takes_the_maximum(nested):
    row = pivot(
        nested(
            {
                "event_params": [
                    ("page_location", "/a"), ("entrances", 9), ("page_location", "/b"),
                    ("entrances", 10), ("session_engaged", 1), ("session_engaged", "0"),
                    ("term", "only"),
                ]
            }
        )
    )
    assert row["param_page_location"] == "/b"
    assert row["param_entrances"] == 10
    assert row["param_session_engaged"] == "1"
    assert row["param_term"] == "only"


def test_items_null_empty_and_repeated(nested):
    df = nested(
        {"event_name": "none", "items": None},
        {"event_name": "empty", "items": []},
        {"event_name": "twice", "items": [ITEM_A, ITEM_A, ITEM_B]},
    )
    for merge in ("regroup", "adaptive", "assume_unique"):
        flat = conform(flatten_events(df, merge), FLAT_EVENT)
        got = sorted((r.event_name, r.item_name or "") for r in flat.collect())
        assert got == [("empty", ""), ("none", ""), ("twice", "a"), ("twice", "b")]


EQUAL_EVENTS = (
    {"items": [ITEM_A, ITEM_B], "event_params": [("page_location", "/a"), ("entrances", 2)]},
    {"items": [ITEM_B], "event_params": [("page_location", "/b"), ("term", "t")]},
    {"user_pseudo_id": "v", "items": [ITEM_A], "event_params": []},
    {"user_pseudo_id": None, "items": None, "event_params": None},
    {"user_pseudo_id": None, "items": None, "event_params": None},
)


@pytest.mark.parametrize("few", [0, 1, 10])
def test_crowded_events_merge_as_the_others_do(nested, few):
    df = nested(*EQUAL_EVENTS)
    whole = sorted(map(str, flatten._merged(flatten._with_digests(df)).collect()))
    assert sorted(map(str, flatten._regrouped(df, few).collect())) == whole


def test_rows_are_dealt_out_before_they_are_merged(nested):
    """The scanning tasks sort no wide rows: their share of the files grows with the table."""
    plan = flatten_events(nested(*EQUAL_EVENTS))._jdf.queryExecution().executedPlan().toString()
    dealt = plan[: plan.index("LeftAnti")]
    merges = [m.start() for m in re.finditer("SortAggregate", dealt)]
    assert len(merges) == 2 and "REPARTITION_BY_COL" in dealt[merges[-1] :]


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_adaptive_merge_equals_regroup(spark, nested, threshold):
    df = nested(*EQUAL_EVENTS)
    regrouped = flatten_events(df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        adaptive = flatten_events(df, "adaptive")
        got = sorted(map(str, adaptive.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == sorted(map(str, regrouped.collect()))
    rows = {
        (r.user_pseudo_id, r.item_name): (r.param_page_location, r.param_entrances, r.param_term)
        for r in regrouped.collect()
    }
    assert rows == {
        ("u", "a"): ("/a", 2, None),
        ("u", "b"): ("/b", 2, "t"),
        ("v", "a"): (None, None, None),
        (None, None): (None, None, None),
    }


def test_local_time_columns(nested):
    before_midnight = 1_606_780_799_999_999
    geo = {"country": "Nepal", "region": None}
    df = nested(
        {"event_timestamp": before_midnight, "geo": geo},
        {"event_timestamp": before_midnight + 1, "geo": geo},
        {"event_timestamp": before_midnight + 2, "geo": None},
    )
    rows = flatten_events(df).orderBy("event_timestamp").collect()
    assert [(r.offset_minutes, r.GMT, r.hour_gmt) for r in rows] == [
        (345, "UTC+05:45", 5), (345, "UTC+05:45", 5), (0, "UTC+00:00", 0),
    ]


def test_one_row_per_event(nested):
    flat = flatten_events(nested({"items": [ITEM_A, ITEM_B]}, {"user_pseudo_id": "v"}))
    assert flat.count() == 3
    assert one_row_per_event(flat).count() == 2


def test_unknown_merge(nested):
    with pytest.raises(ValueError, match="unknown merge"):
        flatten_events(nested({}), "guess")


def test_only_needed_columns_are_read(spark, nested, tmp_path):
    path = str(tmp_path / "nested")
    nested({"items": [ITEM_A]}).write.partitionBy("event_date").parquet(path)
    source = spark.read.schema(nested({}).schema).parquet(path)
    narrow = flatten_events(
        source.where(F.col("event_date") == "20201201"), "assume_unique"
    ).select("event_name", "item_name", "browser")
    plan = narrow._jdf.queryExecution().executedPlan().toString()
    read = plan[plan.index("ReadSchema") :].splitlines()[0]
    assert "event_params" not in read
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert "hashpartitioning" not in plan


@pytest.mark.parametrize("percent", [0, 0.1, 10, 50])
def test_merging_by_digest_equals_grouping_by_all_columns(spark, sf_dir, percent):
    """Repeats of whole events, some with other parameters."""
    from checks.inputs import nested_table
    from eventloom.plans import flatten
    from eventloom.schemas import EVENT_FIELDS, ITEM_FIELDS, PARAM_COLUMNS

    nested = nested_table(spark, sf_dir)
    chosen = F.pmod(F.xxhash64("event_bundle_sequence_id"), F.lit(1000)) < percent * 10
    again = nested.where(chosen).withColumn("event_params", F.slice("event_params", 1, 3))
    nested = nested.union(nested.where(chosen)).union(again.select(*nested.columns))
    rows = flatten._expand_items(flatten._pivoted(nested), "items")
    whole = rows.groupBy(*EVENT_FIELDS, *ITEM_FIELDS).agg(
        *[F.expr(f"max({p}) AS {p}") for p in PARAM_COLUMNS]
    )
    merged = flatten._regrouped(nested)
    assert merged.columns == whole.columns and merged.count() == whole.count()
    assert merged.exceptAll(whole).isEmpty()


def test_digests_see_which_columns_are_null(nested):
    """The same text in one column or in its neighbour is not the same event."""
    empty = dict.fromkeys(NESTED_EVENT["geo"].dataType.fieldNames())
    places = [empty | {"country": "x"}, empty | {"region": "x"}, empty | {"region": "x"}]
    assert flatten_events(nested(*[{"geo": place} for place in places])).count() == 2
