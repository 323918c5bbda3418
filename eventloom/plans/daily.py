"""The daily run: flatten new days, refresh the marts, score the users."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from typing import Literal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.plans import marts
from eventloom.plans.churn_state import revise_churn
from eventloom.plans.features import feature_day_facts, feature_day_totals, model_features_of
from eventloom.plans.flatten import Merge, flatten_events
from eventloom.plans.scoring import (
    load_or_train,
    prediction_trend,
    predictions,
    score,
    train_churn_on_parts,
    train_purchase,
    with_decisions,
)
from eventloom.plans.sketches import user_day_sketches, user_event_totals_from_sketches
from eventloom.sources.run_log import log_run
from eventloom.sources.warehouse import Warehouse

WriteMode = Literal["replace_days", "append"]
FEATURE_PARTS = ("feature_day_totals", "feature_day_facts")


def as_date(day: str) -> date:
    return datetime.strptime(day, "%Y%m%d").date()


def _store(
    warehouse: Warehouse, name: str, df: DataFrame, days: Sequence[str | date], mode: WriteMode
) -> None:
    if mode == "append":
        warehouse.append(name, df)
    elif mode == "replace_days":
        warehouse.replace_days(name, df, days)
    else:
        raise ValueError(f"unknown write mode {mode!r}")


def ingest_days(
    warehouse: Warehouse,
    nested: DataFrame,
    days: Sequence[str],
    merge: Merge = "regroup",
    accumulate: WriteMode | None = None,
) -> None:
    """Flatten ``days`` of the nested events into ``raw_events``, replacing those days.

    ``raw_events`` keeps every day, so it already is the accumulated table.
    ``accumulate`` also adds the days to a separate ``stored_events``: appended, where a
    second run stores a day twice, or replaced.
    """
    chosen = nested.where(F.col("event_date").isin(*days))
    warehouse.replace_days("raw_events", flatten_events(chosen, merge), days)
    if accumulate is not None:
        warehouse.accumulate(
            "raw_events", "stored_events", days, replace=accumulate == "replace_days"
        )


def refresh_marts(
    warehouse: Warehouse,
    days: Sequence[str],
    mode: WriteMode = "replace_days",
    stored: str | None = None,
    churn: Literal["daily", "history"] = "daily",
    reference_date: date = marts.DEFAULT_REFERENCE_DATE,
    gap_days: int = marts.DEFAULT_GAP_DAYS,
    distinct: Literal["exact", "sketch"] = "exact",
) -> None:
    """Per-day marts for ``days``, then the marts over the whole history.

    Each mart reads only its own columns of the day's partitions, which costs less than
    caching the wide rows for all of them. The session mart is written before the marts
    that read it. In ``history`` mode the stored churn flags of users seen on ``days`` are
    brought up to date as well.

    The marts over the history are added up from parts per day, so that of the events only
    ``days`` are read. With ``stored`` the user features are computed from that table of
    accumulated events instead, all of it.

    With ``distinct="sketch"`` a state per user and day stands for the sessions, items and
    purchases seen, and the user features count them approximately; no fact of older days
    is read or shuffled.
    """
    if distinct not in ("exact", "sketch"):
        raise ValueError(f"unknown way to count distinct values {distinct!r}")
    flat = warehouse.read("raw_events", days)
    dates = [as_date(d) for d in days]
    _store(warehouse, "daily_summary", marts.daily_summary(flat), days, mode)
    _store(warehouse, "orders", marts.orders(flat), days, mode)
    _store(warehouse, "order_items", marts.order_items(flat), days, mode)
    _store(warehouse, "session_funnel", marts.session_funnel(flat), dates, mode)
    revised = revise_churn(warehouse, dates, gap_days) if churn == "history" else []
    day_sessions = warehouse.read("session_funnel", dates)
    _store(warehouse, "funnel_daily", marts.funnel_daily(day_sessions), dates, mode)
    # The parts per day are derived from what is stored, so they replace their days.
    changed = sorted({*dates, *revised})
    parts = marts.device_channel_partials(warehouse.read("session_funnel", changed))
    warehouse.replace_days("device_channel_daily", parts, changed)
    warehouse.replace_all(
        "device_channel",
        marts.device_channel_from_partials(warehouse.read("device_channel_daily")),
    )
    if stored is None:
        _store(warehouse, "user_day_totals", marts.user_day_totals(flat), days, mode)
        store_feature_parts(warehouse, flat, days, mode)
        if distinct == "sketch":
            sketches = user_day_sketches(marts.user_day_facts(flat))
            _store(warehouse, "user_day_sketches", sketches, days, mode)
            totals = user_event_totals_from_sketches(
                warehouse.read("user_day_totals"), warehouse.read("user_day_sketches")
            )
        else:
            _store(warehouse, "user_day_facts", marts.user_day_facts(flat), days, mode)
            totals = marts.user_event_totals_from_days(
                warehouse.read("user_day_totals"), warehouse.read("user_day_facts")
            )
    else:
        totals = marts.user_event_totals(warehouse.read(stored))
    sessions = warehouse.read("session_funnel")
    warehouse.replace_all(
        "user_features", marts.user_features_of(totals, sessions, reference_date, gap_days)
    )


def store_feature_parts(
    warehouse: Warehouse,
    flat: DataFrame,
    days: Sequence[str],
    mode: WriteMode = "replace_days",
) -> None:
    """Parts of the model features for ``days``, from those days' events."""
    _store(warehouse, "feature_day_totals", feature_day_totals(flat), days, mode)
    _store(warehouse, "feature_day_facts", feature_day_facts(flat), days, mode)


def score_day(
    warehouse: Warehouse,
    day: str,
    model_root: str,
    mode: WriteMode = "replace_days",
    churn_days: int = marts.DEFAULT_GAP_DAYS,
    source: str = "eventloom",
) -> None:
    """Score the users of one day and store predictions, trend and run log.

    Models are loaded from ``model_root``, or trained on the stored history up to ``day``
    and saved there: the purchase model on users' days, the churn model on who came back
    within ``churn_days`` after a cut-off so long before. A day without users stores no
    predictions and a trend row of zeros, and needs no model.

    Features are added up from parts per day. Of the events, ``day`` is read to make its
    parts, and days that have none yet; a trained model needs no event of any other day.
    """
    when = as_date(day)
    known = set(warehouse.days("feature_day_totals")) - {day}
    missing = [d for d in warehouse.days("raw_events") if d not in known]
    store_feature_parts(warehouse, warehouse.read("raw_events", missing), missing)
    day_parts = [warehouse.read(name, [day]) for name in FEATURE_PARTS]
    features = model_features_of(*day_parts).cache()
    try:
        if features.isEmpty():
            scored = features.withColumns(
                {"purchase_probability": F.lit(0.0), "churn_probability": F.lit(0.0)}
            )
        else:
            history = [
                warehouse.read(name).where(F.col("event_date") <= day) for name in FEATURE_PARTS
            ]
            purchase = load_or_train(
                warehouse.spark,
                f"{model_root}/purchase",
                lambda: train_purchase(
                    model_features_of(*history, by=("user_pseudo_id", "event_date"))
                ),
            )
            churn = load_or_train(
                warehouse.spark,
                f"{model_root}/churn",
                lambda: train_churn_on_parts(*history, when, churn_days),
            )
            scored = score(features, purchase, churn)
        decided = with_decisions(scored)
        _store(warehouse, "predictions", predictions(decided, when), [when], mode)
        _store(warehouse, "prediction_trend", prediction_trend(decided, when), [when], mode)
        log_run(
            warehouse,
            warehouse.read("prediction_trend", [when]),
            {
                "t7_path": warehouse.path("predictions"),
                "t8_path": warehouse.path("prediction_trend"),
                "purchase_model_path": f"{model_root}/purchase",
                "churn_model_path": f"{model_root}/churn",
            },
            source,
        )
    finally:
        features.unpersist()
