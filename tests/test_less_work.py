"""Work that must not come back: copies, shuffles and columns that nothing needs."""

from __future__ import annotations

import re

import pytest

from checks import queries as checks_queries
from checks.fixture import flat_events, nested_events
from checks.inputs import nested_table
from eventloom.plans.features import feature_day_facts
from eventloom.plans.marts import user_day_facts
from eventloom.sources.bucketed import UserTables
from eventloom.sources.warehouse import Warehouse
from eventloom.streaming import incremental


class Enough(Exception):
    pass


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("late, width", [("reread", 1), ("merge", None)])
def test_stream_that_only_names_days_reads_no_column(
    spark, nested, tmp_path, monkeypatch, late, width
):
    events = nested({"event_date": "20201201"}, {"event_date": "20201202"})
    events.write.partitionBy("event_date").parquet(str(tmp_path / "landing"))
    seen = []

    def spy(batch, days=incremental.touched_days):
        seen.append((batch.columns, days(batch)))
        return seen[-1][1]

    monkeypatch.setattr(incremental, "touched_days", spy)
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    incremental.ingest_new_files(
        warehouse, str(tmp_path / "landing"), str(tmp_path / "stream"), refresh=None, late=late
    )
    [(columns, days)] = seen
    assert len(columns) == (width or len(events.columns))
    assert days == ["20201201", "20201202"]
    assert warehouse.read("raw_events").count() == 2


def test_ingested_folder_is_the_nested_table_itself(spark, sf_dir, monkeypatch):
    landed = []

    def note(warehouse, landing, *args, **options):
        landed.append(landing)
        raise Enough

    monkeypatch.setattr(checks_queries, "ingest_new_files", note)
    with pytest.raises(Enough):
        checks_queries.queries()["incremental_ingest"](spark, sf_dir)
    files = nested_table(spark, sf_dir).inputFiles()
    assert files and all(landed[0] in file for file in files)


@pytest.mark.parametrize("build, derived", [(flat_events, "param_outbound"), (nested_events, "event_params")])
def test_derived_rows_move_to_their_day_before_they_are_wide(spark, sf_dir, build, derived):
    above, below = re.split(r"RebalancePartitions", _plan(build(spark, sf_dir)), maxsplit=1)
    assert derived in above and derived not in below


def test_facts_of_a_day_are_shuffled_once(spark, flat):
    events = flat(
        {"event_name": "view_item", "item_name": "a"},
        {"event_name": "view_item", "item_name": "a"},
        {"event_name": "purchase", "transaction_id": "t", "user_pseudo_id": None},
        {"event_name": "purchase", "transaction_id": None, "param_ga_session_id": None},
        {"event_name": "page_view", "param_page_location": "/p", "param_ga_session_id": None},
    )
    shown = user_day_facts(events)
    assert sorted(map(str, ((r.user_pseudo_id, r.kind, r.fact) for r in shown.collect()))) == sorted(
        map(str, [("u", "session", "1"), ("u", "view_item", "a"), (None, "session", "1"), (None, "purchase", "t")])
    )
    features = feature_day_facts(events)
    assert sorted(map(str, ((r.user_pseudo_id, r.kind, r.fact) for r in features.collect()))) == sorted(
        map(str, [
            ("u", "session", "1"), ("u", "session", None), ("u", "page", None), ("u", "page", "/p"),
            (None, "session", "1"), (None, "page", None),
        ])
    )
    for facts in (shown, features):
        assert _plan(facts).count("Aggregate") == 1


def test_sessions_by_user_are_not_written_by_day_first(spark, sf_dir, monkeypatch):
    def refuse(*_):
        raise AssertionError("the session mart is written twice")

    stored = []

    def note(self, name, df):
        stored.append(name)
        if len(stored) == 3:
            raise Enough

    monkeypatch.setattr(checks_queries, "session_table", refuse)
    monkeypatch.setattr(UserTables, "replace_days", note)
    with pytest.raises(Enough):
        checks_queries.queries()["t6_user_features_bucketed"](spark, sf_dir)
    assert stored == ["user_day_totals", "user_day_facts", "session_funnel"]
