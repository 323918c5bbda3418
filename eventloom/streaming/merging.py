"""Merge new event rows into stored days without reading the days again.

``event_digests`` says which rows a stored day holds: 24 bytes for each. New rows are set
against the digests of their days. Rows that are not there yet are appended, rows that are
there with the same parameters are left out, and only days where a row comes with other
parameters are read and written anew.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.plans.flatten import Merge, flatten_events, merge_flat, with_row_digests
from eventloom.schemas import EVENT_DIGESTS, FLAT_EVENT, as_schema
from eventloom.sources.scratch import delete_dir, new_dir
from eventloom.sources.warehouse import Warehouse

KEYS = ["event_date", "digest_1", "digest_2"]


def index_days(warehouse: Warehouse, days: Sequence[str]) -> None:
    """Make the digests of ``days`` those of the stored rows."""
    rows = with_row_digests(warehouse.read("raw_events", days))
    warehouse.replace_days("event_digests", as_schema(rows, EVENT_DIGESTS), days)


def is_indexed(warehouse: Warehouse, days: Sequence[str]) -> bool:
    """Whether all stored ones of ``days`` have digests. Folder names alone tell."""
    stored = set(warehouse.days("raw_events")) & set(days)
    return stored <= set(warehouse.days("event_digests"))


def merge_events(
    warehouse: Warehouse, nested: DataFrame, days: Sequence[str], merge: Merge = "regroup"
) -> list[str]:
    """Add ``nested`` events of ``days`` to ``raw_events``; returns the days written anew.

    The result is that of flattening the days whole. Rows go in first and digests after
    them, so a run that broke off must not be repeated with this but from the sources.
    """
    spark = warehouse.spark
    path = new_dir(spark, "new-events")
    new = with_row_digests(flatten_events(nested, merge))
    new.write.parquet(path)
    new = spark.read.schema(new.schema).parquet(path)
    indexed = sorted(set(days) & set(warehouse.days("event_digests")))
    known = warehouse.read("event_digests", indexed)

    fresh = new.join(known, KEYS, "left_anti")
    others = known.withColumnRenamed("params", "stored_params")
    differing = new.join(others, KEYS).where("params <> stored_params")
    rewritten = sorted(r[0] for r in differing.select("event_date").distinct().collect())

    # ``known`` lists the digests stored so far, so what is added here does not change it.
    append = fresh.where(~F.col("event_date").isin(*rewritten)) if rewritten else fresh
    warehouse.append("raw_events", as_schema(append, FLAT_EVENT))
    warehouse.append("event_digests", as_schema(append, EVENT_DIGESTS))
    if rewritten:
        rows = as_schema(new.where(F.col("event_date").isin(*rewritten)), FLAT_EVENT)
        both = merge_flat(warehouse.read("raw_events", rewritten).unionByName(rows))
        copy = new_dir(spark, "merged-days")
        both.write.parquet(copy)
        merged = spark.read.schema(FLAT_EVENT).parquet(copy)
        warehouse.replace_days("raw_events", merged, rewritten)
        index_days(warehouse, rewritten)
        delete_dir(spark, copy)
    delete_dir(spark, path)
    return rewritten
