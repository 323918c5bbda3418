"""The daily run and the stream, end to end on nested events."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from checks import queries
from checks.inputs import nested_table
from eventloom.plans import marts
from eventloom.plans.churn_state import revise_churn
from eventloom.plans.daily import ingest_days, refresh_marts, score_day
from eventloom.plans.flatten import flatten_events
from eventloom.sources.warehouse import Warehouse
from eventloom.streaming import merging
from eventloom.streaming.incremental import ingest_new_files

DAYS = ["20201208", "20201209"]


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse"))


def snapshot(warehouse, *names):
    return {n: sorted(map(str, warehouse.read(n).collect())) for n in names}


MARTS = (
    "daily_summary", "orders", "order_items", "session_funnel", "funnel_daily",
    "device_channel", "user_features",
)


def test_daily_run_twice_is_the_same(spark, sf_dir, warehouse, tmp_path):
    nested = nested_table(spark, sf_dir)
    for _ in range(2):
        ingest_days(warehouse, nested, DAYS)
        refresh_marts(warehouse, DAYS, reference_date=date(2020, 12, 31))
        seen = snapshot(warehouse, *MARTS)
        if _ == 0:
            first = seen
    assert seen == first
    assert warehouse.read("daily_summary").count() == len(DAYS)


def test_newest_day_is_scored(spark, sf_dir, warehouse, tmp_path):
    """The normal run: models are trained on the stored history, the last day is scored."""
    nested = nested_table(spark, sf_dir)
    days = sorted(r[0] for r in nested.select("event_date").distinct().collect())
    ingest_days(warehouse, nested, days)
    refresh_marts(warehouse, days[-1:])
    users = nested.where(F.col("event_date") == days[-1]).select("user_pseudo_id").distinct()
    for _ in range(2):
        score_day(warehouse, days[-1], str(tmp_path / "models"))
        assert warehouse.read("predictions").count() == users.count() > 0
        trend = warehouse.read("prediction_trend").collect()
        assert [t.total_users for t in trend] == [users.count()]
    assert warehouse.read("predictions").where("churn_probability NOT BETWEEN 0 AND 1").isEmpty()


def test_refresh_reads_only_the_new_days_of_events(spark, sf_dir, warehouse, monkeypatch):
    nested = nested_table(spark, sf_dir)
    ingest_days(warehouse, nested, DAYS)
    read = Warehouse.read
    asked = []

    def noted(self, name, days=None):
        asked.append((name, days))
        return read(self, name, days)

    monkeypatch.setattr(Warehouse, "read", noted)
    refresh_marts(warehouse, DAYS[1:])
    assert [days for name, days in asked if name == "raw_events"] == [DAYS[1:]]


def test_history_churn_is_stored(spark, sf_dir, warehouse):
    nested = nested_table(spark, sf_dir)
    days = sorted(r[0] for r in nested.select("event_date").distinct().collect())
    early = [d for d in days if d <= "20201205"]
    late = days[len(early) :]
    # The later days first: then the earlier ones fall into gaps that are already flagged.
    for part in (late, early):
        ingest_days(warehouse, nested, part)
        refresh_marts(warehouse, part, churn="history")
    keys = ["user_pseudo_id", "session_date", "ga_session_id", "churn_session_flag"]
    stored = warehouse.read("session_funnel").select(*keys)
    whole = marts.session_funnel(warehouse.read("raw_events"), churn="history").select(*keys)
    assert stored.exceptAll(whole).isEmpty() and stored.count() == whole.count()
    assert stored.agg(F.sum("churn_session_flag")).first()[0] > 0
    channels = marts.device_channel(warehouse.read("session_funnel"))
    assert channels.exceptAll(warehouse.read("device_channel")).isEmpty()


def _sessions(spark, rows):
    """Session mart rows of (user, day of December or January, session id)."""
    from datetime import timedelta

    from eventloom.schemas import SESSION_FUNNEL

    empty = {f.name: None for f in SESSION_FUNNEL.fields}
    made = [
        empty | {
            "user_pseudo_id": user, "session_date": date(2020, 12, 1) + timedelta(days=day),
            "ga_session_id": session, "churn_session_flag": 0,
        }
        for user, day, session in rows
    ]
    return spark.createDataFrame(made, SESSION_FUNNEL)


def test_churn_state_follows_every_order_of_runs(spark, warehouse):
    """Days in order, a day again, a day emptied, a late day: flags as over all sessions."""
    rows = [
        ("a", 0, 1), ("a", 0, 2), ("a", 20, 3), ("a", 21, 4), ("b", 0, 5), ("b", 10, 6),
        ("b", 40, 7), ("c", 20, 8), ("c", 40, 9), (None, 0, 10), (None, 20, 11),
    ]
    runs = [
        (0, rows), (10, rows), (20, rows), (21, rows), (40, rows), (40, rows),
        (20, [r for r in rows if r[1] != 20]), (20, rows), (30, [*rows, ("b", 30, 12)]), (0, rows[4:]),
    ]
    stored = {}
    for day, now in runs:
        stored[day] = [r for r in now if r[1] == day]
        when = date.fromordinal(date(2020, 12, 1).toordinal() + day)
        warehouse.replace_days("session_funnel", _sessions(spark, stored[day]), [when])
        revise_churn(warehouse, [when], 15)
        every = _sessions(spark, [r for part in stored.values() for r in part])
        whole = marts.with_history_churn(every, 15)
        keys = ["user_pseudo_id", "session_date", "ga_session_id", "churn_session_flag"]
        want = sorted((tuple(r) for r in whole.select(*keys).collect()), key=str)
        assert sorted(_flags_raw(warehouse), key=str) == want, f"after day {day}"
    assert any(r[3] for r in _flags_raw(warehouse))
    assert len(warehouse.days("user_last_session")) <= 3


def _flags_raw(warehouse):
    keys = ["user_pseudo_id", "session_date", "ga_session_id", "churn_session_flag"]
    return [tuple(r) for r in warehouse.read("session_funnel").select(*keys).collect()]


def test_churn_state_reads_new_and_touched_days_only(spark, warehouse, monkeypatch):
    rows = [("a", day, day) for day in (0, 1, 2, 3)] + [("b", 2, 9), ("b", 30, 10)]
    days = {d: date.fromordinal(date(2020, 12, 1).toordinal() + d) for d in (0, 1, 2, 3, 30)}
    asked = []
    read = Warehouse.read

    def noted(self, name, days=None):
        asked.append((name, days))
        return read(self, name, days)

    monkeypatch.setattr(Warehouse, "read", noted)
    for day, when in days.items():
        asked.clear()
        warehouse.replace_days(
            "session_funnel", _sessions(spark, [r for r in rows if r[1] == day]), [when]
        )
        touched = revise_churn(warehouse, [when], 15)
    assert touched == [days[2]]
    assert [d for name, d in asked if name == "session_funnel"] == [[days[30]], [days[2]]]
    assert [d for name, d in asked if name == "user_last_session"] == [[days[3]]]
    plan = read(warehouse, "session_funnel", [days[30]])._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [" in plan.toString() and "2020-12-31" in plan.toString()


def test_training_reads_no_events_of_other_days(spark, sf_dir, warehouse, tmp_path, monkeypatch):
    nested = nested_table(spark, sf_dir)
    days = sorted(r[0] for r in nested.select("event_date").distinct().collect())
    ingest_days(warehouse, nested, days)
    refresh_marts(warehouse, days)
    asked = []
    read = Warehouse.read

    def noted(self, name, days=None):
        asked.append((name, days))
        return read(self, name, days)

    monkeypatch.setattr(Warehouse, "read", noted)
    score_day(warehouse, days[-1], str(tmp_path / "models"))
    assert [d for name, d in asked if name == "raw_events"] == [days[-1:]]
    assert read(warehouse, "predictions").count() > 0


def test_scoring_a_day_without_users(spark, sf_dir, warehouse, tmp_path):
    nested = nested_table(spark, sf_dir)
    ingest_days(warehouse, nested, [DAYS[0], "20210101"])
    score_day(warehouse, "20210101", str(tmp_path / "models"))
    assert warehouse.read("prediction_trend").first().total_users == 0
    assert warehouse.read("run_metrics").count() == 13


def test_append_mode_duplicates_and_accumulates(spark, sf_dir, warehouse):
    nested = nested_table(spark, sf_dir)
    for _ in range(2):
        ingest_days(warehouse, nested, DAYS[:1], accumulate="append")
        refresh_marts(warehouse, DAYS[:1], mode="append", stored="stored_events")
    assert warehouse.read("stored_events").count() == 2 * warehouse.read("raw_events").count()
    assert warehouse.read("daily_summary").count() == 2
    ingest_days(warehouse, nested, DAYS[:1], accumulate="replace_days")
    assert warehouse.read("stored_events").count() == warehouse.read("raw_events").count()


def test_late_file_gives_the_result_of_one_run(spark, sf_dir, tmp_path):
    nested = nested_table(spark, sf_dir).where(F.col("event_date").isin(*DAYS))
    early = F.col("event_bundle_sequence_id") % 2 == 0
    landing = str(tmp_path / "landing")
    checkpoint = str(tmp_path / "checkpoint")
    stream = Warehouse(spark, str(tmp_path / "stream"))
    for part in (early, ~early):
        nested.where(part).write.mode("append").partitionBy("event_date").parquet(landing)
        ingest_new_files(
            stream, landing, checkpoint, refresh=None if part is early else refresh_marts
        )
    ingest_new_files(stream, landing, checkpoint)
    once = Warehouse(spark, str(tmp_path / "once"))
    ingest_days(once, nested, DAYS)
    refresh_marts(once, DAYS)
    assert snapshot(stream, "raw_events", *MARTS) == snapshot(once, "raw_events", *MARTS)


def test_late_files_are_merged_by_digest(spark, sf_dir, tmp_path, monkeypatch):
    """A late file with new rows, rows that are there, and rows with other parameters."""
    from eventloom.streaming import merging

    nested = nested_table(spark, sf_dir).where(F.col("event_date").isin(*DAYS))
    early = F.col("event_bundle_sequence_id") % 2 == 0
    other = nested.where(early & (F.col("event_date") == DAYS[1])).withColumn(
        "event_params", F.slice("event_params", 1, 2)
    )
    parts = [
        nested.where(early),
        nested.where(~early & (F.col("event_date") == DAYS[0])).union(
            nested.where(early & (F.col("event_date") == DAYS[0]))
        ),
        nested.where(~early).union(other.select(*nested.columns)),
    ]
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    stream = Warehouse(spark, str(tmp_path / "stream"))
    rewritten = []
    merge_events = merging.merge_events

    def noted(*args):
        rewritten.append(merge_events(*args))

    monkeypatch.setattr("eventloom.streaming.incremental.merge_events", noted)
    asked = []
    read = Warehouse.read

    def reading(self, name, days=None):
        asked.append((name, days))
        return read(self, name, days)

    for part in parts:
        part.write.mode("append").partitionBy("event_date").parquet(landing)
        monkeypatch.setattr(Warehouse, "read", reading if part is parts[1] else read)
        ingest_new_files(stream, landing, checkpoint, refresh=None, late="merge")
    assert rewritten == [[], [], [DAYS[1]]] or rewritten[-2:] == [[], [DAYS[1]]]
    # The second file brought rows of one day: its digests were read, none of its events.
    assert ("event_digests", [DAYS[0]]) in asked and "raw_events" not in {n for n, _ in asked}
    once = Warehouse(spark, str(tmp_path / "once"))
    ingest_days(once, spark.read.schema(nested.schema).parquet(landing), DAYS)
    assert snapshot(stream, "raw_events") == snapshot(once, "raw_events")


def test_a_batch_that_broke_off_reads_its_days_whole(spark, sf_dir, tmp_path, monkeypatch):
    """The merge stops after half of its writes; the same batch runs again."""
    nested = nested_table(spark, sf_dir).where(F.col("event_date").isin(*DAYS))
    early = F.col("event_bundle_sequence_id") % 2 == 0
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    stream = Warehouse(spark, str(tmp_path / "stream"))
    nested.where(early).write.partitionBy("event_date").parquet(landing)
    ingest_new_files(stream, landing, checkpoint, refresh=None, late="merge")
    nested.where(~early).write.mode("append").partitionBy("event_date").parquet(landing)
    append = Warehouse.append

    def broken(self, name, df):
        append(self, name, df)
        if name == "raw_events":
            raise RuntimeError("lost")

    monkeypatch.setattr(Warehouse, "append", broken)
    with pytest.raises(Exception, match="lost"):
        ingest_new_files(stream, landing, checkpoint, refresh=None, late="merge")
    monkeypatch.setattr(Warehouse, "append", append)
    ingest_new_files(stream, landing, checkpoint, refresh=None, late="merge")
    once = Warehouse(spark, str(tmp_path / "once"))
    ingest_days(once, nested, DAYS)
    assert snapshot(stream, "raw_events") == snapshot(once, "raw_events")


def test_marts_are_refreshed_once_for_all_batches(spark, sf_dir, tmp_path):
    nested = nested_table(spark, sf_dir).where(F.col("event_date").isin(*DAYS))
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    nested.repartition(3).write.partitionBy("event_date").parquet(landing)
    stream = Warehouse(spark, str(tmp_path / "stream"))
    calls = []
    note = lambda warehouse, days: calls.append(days)
    ingest_new_files(stream, landing, checkpoint, refresh=note, max_files_per_batch=1)
    assert calls == [DAYS]
    ingest_new_files(stream, landing, checkpoint, refresh=note)
    assert calls == [DAYS]


def test_landing_folder_must_be_partitioned(spark, sf_dir, tmp_path):
    landing = str(tmp_path / "landing")
    nested_table(spark, sf_dir).limit(5).write.parquet(landing)
    with pytest.raises(ValueError, match="not partitioned"):
        ingest_new_files(Warehouse(spark, str(tmp_path / "w")), landing, str(tmp_path / "c"))


@pytest.mark.parametrize("name", ["history_churn_stored", "daily_scoring_run"])
def test_days_are_read_from_the_events_that_are_ingested(spark, monkeypatch, name):
    """No second table of the events is built to learn which days there are."""

    class Ingested(Exception):
        pass

    def unused(*_):
        raise AssertionError("the flat table was built")

    def ingested(_, __, *parts, **___):
        raise Ingested([d for part in parts for d in ([part] if isinstance(part, str) else part)])

    nested = spark.createDataFrame([("20201219",), ("20201201",)], "event_date string")
    monkeypatch.setattr(queries, "nested_table", lambda *_: nested)
    monkeypatch.setattr(queries, "flat_table", unused)
    monkeypatch.setattr(queries, "_ingested", ingested)
    monkeypatch.setattr(queries, "ingest_days", lambda w, n, days: ingested(w, n, days))
    with pytest.raises(Ingested) as days:
        queries.queries()[name](spark, "none")
    assert days.value.args[0] == ["20201201", "20201219"]


def test_new_rows_are_written_once_before_they_are_merged(spark, sf_dir, tmp_path, monkeypatch):
    made = []

    def noted(spark, purpose):
        made.append(purpose)
        return f"{tmp_path}/scratch-{len(made)}"

    monkeypatch.setattr(merging, "new_dir", noted)
    warehouse = Warehouse(spark, f"{tmp_path}/w")
    day = nested_table(spark, sf_dir).where(F.col("event_date") == "20201201")
    early = day.where("event_bundle_sequence_id % 3 < 2")
    ingest_days(warehouse, early, ["20201201"])
    merging.index_days(warehouse, ["20201201"])
    assert merging.merge_events(warehouse, day, ["20201201"]) == []
    assert made == ["new-events"]
    whole = flatten_events(day)
    stored = warehouse.read("raw_events")
    assert stored.exceptAll(whole).isEmpty() and whole.exceptAll(stored).isEmpty()
    assert warehouse.read("event_digests").count() == whole.count()
