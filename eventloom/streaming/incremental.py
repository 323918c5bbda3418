"""Pick up new files of nested events, re-flatten the days they touch, refresh the marts."""

from __future__ import annotations

from collections.abc import Callable
from typing import Literal

from pyspark.sql import DataFrame

from eventloom.plans.daily import ingest_days, refresh_marts
from eventloom.plans.flatten import Merge
from eventloom.schemas import NESTED_EVENT
from eventloom.sources.guards import path_exists
from eventloom.sources.warehouse import Warehouse
from eventloom.streaming.merging import index_days, is_indexed, merge_events


def touched_days(batch: DataFrame) -> list[str]:
    """Days present in a batch: one short text per calendar day reaches the driver."""
    return sorted(r[0] for r in batch.select("event_date").distinct().collect())


def ingest_new_files(
    warehouse: Warehouse,
    landing: str,
    checkpoint: str,
    merge: Merge = "regroup",
    refresh: Callable[[Warehouse, list[str]], None] | None = refresh_marts,
    max_files_per_batch: int | None = None,
    late: Literal["reread", "merge"] = "reread",
) -> list[str]:
    """Process all files that arrived in ``landing`` since the last call, then return.

    The stream only tells which days changed. Those days are read back whole from the
    landing folder and replaced, so a file that arrives late, or a batch that runs again
    after a failure, leaves the same result as one clean run. ``landing`` must be
    partitioned by ``event_date``, else each batch would read all of it. A day that several
    batches touch is flattened by each, but the marts are refreshed once, at the end:
    ``refresh(warehouse, days)``, with options bound by the caller, or None for no refresh.

    With ``late="merge"`` a batch reads its own files and the digests of the stored rows of
    their days, and adds what is new (:mod:`eventloom.streaming.merging`). A batch that runs
    again after a failure, or meets a stored day without digests, reads its days whole.

    A batch notes its days beside the checkpoint before it is committed, and the notes go
    once the marts are refreshed, so a run that fails in between is made good by the next.
    """
    if late not in ("reread", "merge"):
        raise ValueError(f"unknown way to take late files {late!r}")
    spark = warehouse.spark
    pending = f"{checkpoint.rstrip('/')}-pending-days"
    if path_exists(spark, landing) and not path_exists(spark, f"{landing}/event_date=*"):
        if path_exists(spark, f"{landing}/*"):
            raise ValueError(f"{landing} is not partitioned by event_date")

    def flatten_days(batch: DataFrame, number: int) -> None:
        days = touched_days(batch)
        if not days:
            return
        note = f"{pending}/batch={number}"
        again = path_exists(spark, note)
        # The note comes first: a batch that finds its own note broke off before.
        noted = spark.createDataFrame([(day,) for day in days], "day string").coalesce(1)
        noted.write.mode("overwrite").parquet(note)
        if late == "merge" and not again and is_indexed(warehouse, days):
            merge_events(warehouse, batch, days, merge)
            return
        nested = spark.read.schema(NESTED_EVENT).parquet(landing)
        ingest_days(warehouse, nested, days, merge)
        if late == "merge":
            index_days(warehouse, days)

    # A batch is read whole, whatever is selected of it. Where only its days matter, the
    # stream has no other column, and no column of the files is read.
    reader = spark.readStream.schema(NESTED_EVENT if late == "merge" else "event_date string")
    if max_files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    query = (
        reader.parquet(landing)
        .writeStream.foreachBatch(flatten_days)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if not path_exists(spark, f"{pending}/batch=*"):
        return []
    noted = spark.read.schema("day string, batch int").parquet(pending)
    days = sorted(r[0] for r in noted.select("day").distinct().collect())
    if days and refresh is not None:
        refresh(warehouse, days)
        spark.createDataFrame([], "day string, batch int").write.mode("overwrite").option(
            "partitionOverwriteMode", "static"
        ).partitionBy("batch").parquet(pending)
    return days
