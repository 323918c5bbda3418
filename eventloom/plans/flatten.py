"""Flatten nested events: one row per event and distinct item, parameters as columns.

The contract is that of grouping by everything: rows equal in all event and item columns
merge, and each parameter column keeps its largest value over the merged rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.geo_time import local_hour, offset_label, with_offset_minutes
from eventloom.functions.params import pivot_params
from eventloom.schemas import (
    EVENT_FIELDS,
    FLAT_EVENT,
    ITEM_FIELDS,
    PARAM_COLUMNS,
    as_schema,
)

Merge = Literal["regroup", "adaptive", "assume_unique"]

_EVENT_COLUMNS = [f"{path} AS {name}" for name, path in EVENT_FIELDS.items()]


def _pivoted(nested: DataFrame) -> DataFrame:
    return pivot_params(nested.selectExpr(*_EVENT_COLUMNS, "event_params", "items"))


def _expand_items(events: DataFrame, items: str) -> DataFrame:
    """One row per item; an event without items keeps one row with NULL item columns."""
    rest = [c for c in events.columns if c != "items"]
    expanded = events.selectExpr(*rest, f"explode_outer({items}) AS item")
    return expanded.selectExpr(*rest, *[f"item.{f}" for f in ITEM_FIELDS])


def with_row_digests(flat: DataFrame) -> DataFrame:
    """Flat events with ``digest_1`` and ``digest_2`` of the event and item columns, which
    rows that merge share, and ``params``, a hash of the parameter columns."""
    params = _digest(PARAM_COLUMNS)[0].alias("params")
    return flat.select("*", *_digest([*EVENT_FIELDS, *ITEM_FIELDS]), params)


def merge_flat(flat: DataFrame) -> DataFrame:
    """Flat events with equal rows merged, as :func:`flatten_events` would have done.

    What follows from the event columns is the same in rows that merge.
    """
    rest = [c for c in flat.columns if c not in PARAM_COLUMNS]
    merged = flat.groupBy(*_digest([*EVENT_FIELDS, *ITEM_FIELDS])).agg(
        F.first(F.struct(*rest)).alias("row"),
        *[F.expr(f"max({p}) AS {p}") for p in PARAM_COLUMNS],
    )
    return merged.select("row.*", *PARAM_COLUMNS).select(*flat.columns)


def _digest(columns: Sequence[str]) -> list[Column]:
    """128 bits that tell rows apart by the values of ``columns``.

    Hashing passes over NULLs, so which columns are NULL is hashed as well, as a number of
    one bit per column.
    """
    absent = " + ".join(f"if({c} IS NULL, {1 << i}L, 0L)" for i, c in enumerate(columns))
    forth, back = ", ".join(columns), ", ".join(reversed(columns))
    return [
        F.expr(f"xxhash64({forth}, {absent})").alias("digest_1"),
        F.expr(f"xxhash64({absent}, {back})").alias("digest_2"),
    ]


def _merged(rows: DataFrame) -> DataFrame:
    """Rows with one digest are merged; event and item columns are those of any of them.

    The digest is the only key. Text columns cannot be updated in place, so Spark sorts
    before it merges, and sorts 16 bytes a row instead of all event and item columns.
    """
    keys = [*EVENT_FIELDS, *ITEM_FIELDS]
    merged = rows.groupBy("digest_1", "digest_2").agg(
        F.first(F.struct(*keys)).alias("row"),
        *[F.expr(f"max({p}) AS {p}") for p in PARAM_COLUMNS],
    )
    return merged.select("row.*", *PARAM_COLUMNS)


def _with_digests(nested: DataFrame) -> DataFrame:
    rows = _expand_items(_pivoted(nested), "items")
    return rows.select("*", *_digest([*EVENT_FIELDS, *ITEM_FIELDS]))


# Equal events up to this number may meet in one task as they are.
FEW = 10_000


def _origin() -> Column:
    """64-bit hash of what equal events share and few others do; needs four columns only."""
    return F.expr(
        "xxhash64(event_timestamp, user_pseudo_id, event_bundle_sequence_id, event_name)"
    )


def crowded_origins(nested: DataFrame, few: int = FEW) -> DataFrame:
    """Hashes that more than ``few`` events share: at most one row for so many events."""
    return (
        nested.select(_origin().alias("origin"))
        .groupBy("origin")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > few)
        .select("origin")
    )


def _regrouped(nested: DataFrame, few: int = FEW) -> DataFrame:
    """Rows are dealt out by digest and merged where they arrive.

    Merging in the scanning tasks first would sort all rows of a task's share of the files,
    which grows with the table, and mostly finds nothing to merge. Only copies of an event
    that is there very often are merged there as well; without any, Spark leaves that part
    of the plan out once it knows.
    """
    crowded = F.broadcast(crowded_origins(nested, few))
    same = _origin() == F.col("origin")
    dealt = _with_digests(nested.join(crowded, same, "left_anti")).repartition(
        "digest_1", "digest_2"
    )
    copied = _with_digests(nested.join(crowded, same, "left_semi"))
    return _merged(dealt).unionByName(_merged(copied))


def _unique(nested: DataFrame) -> DataFrame:
    return _expand_items(_pivoted(nested), "array_distinct(items)")


def event_fingerprint() -> Column:
    """64-bit hash of all event columns; equal events have equal fingerprints."""
    return F.expr(f"xxhash64({', '.join(EVENT_FIELDS.values())})")


def repeated_fingerprints(nested: DataFrame) -> DataFrame:
    """Fingerprints carried by more than one event. Shuffles 8 bytes per event."""
    return (
        nested.select(event_fingerprint().alias("fingerprint"))
        .groupBy("fingerprint")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > 1)
        .select("fingerprint")
    )


def _adaptive(nested: DataFrame) -> DataFrame:
    repeated = repeated_fingerprints(nested)
    # The hash stays inside the join condition. As a column it would sit next to the
    # columns it is made of, and the optimizer would derive a constraint for every
    # combination of them.
    same = event_fingerprint() == F.col("fingerprint")
    once = nested.join(repeated, same, "left_anti")
    again = nested.join(repeated, same, "left_semi")
    return _unique(once).unionByName(_regrouped(again))


def flatten_events(nested: DataFrame, merge: Merge = "regroup") -> DataFrame:
    """Flat event table of nested events.

    ``merge`` picks how repeated rows are merged; the result is the same whenever its
    condition holds.

    * ``regroup``: group by a digest of 128 bits of all event and item columns. Rows that
      differ are merged only if their digests collide, which no table is large enough for.
      Shuffles the wide rows once.
    * ``adaptive``: always exact. Counts event fingerprints (8 bytes per event shuffled, one
      more read of the source); only events whose fingerprint repeats are regrouped. How
      the two groups of events are told apart, by a broadcast or a shuffled join, is left
      to Spark, which knows the measured size of the repeated fingerprints.
    * ``assume_unique``: no shuffle at all. For sources that never repeat an event;
      repeated items within one event still merge.
    """
    if merge == "regroup":
        rows = _regrouped(nested)
    elif merge == "adaptive":
        rows = _adaptive(nested)
    elif merge == "assume_unique":
        rows = _unique(nested)
    else:
        raise ValueError(f"unknown merge {merge!r}")
    rows = with_offset_minutes(rows).withColumns(
        {
            "GMT": offset_label(F.col("offset_minutes")),
            "hour_gmt": local_hour(F.col("event_timestamp"), F.col("offset_minutes")),
        }
    )
    return as_schema(rows, FLAT_EVENT)


def one_row_per_event(flat: DataFrame) -> DataFrame:
    """Undo the item expansion: drop the item columns and the rows they multiplied."""
    return flat.drop(*ITEM_FIELDS).dropDuplicates()
