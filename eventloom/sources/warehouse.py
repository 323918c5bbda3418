"""Day-partitioned Parquet tables: append, replace days, replace all."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom import schemas
from eventloom.schemas import as_schema, conform
from eventloom.sources.guards import matching_paths, path_exists
from eventloom.sources.scratch import delete_dir


class TableSpec(NamedTuple):
    """Schema of a table, the column it is partitioned by and the order within files."""

    schema: T.StructType
    partition: str | None
    sort: tuple[str, ...] = ()


_EVENTS = TableSpec(schemas.FLAT_EVENT, "event_date", ("event_name", "user_pseudo_id"))
TABLES: dict[str, TableSpec] = {
    "raw_events": _EVENTS,
    "stored_events": _EVENTS,
    "daily_summary": TableSpec(schemas.DAILY_SUMMARY, "event_date"),
    "orders": TableSpec(schemas.ORDERS, "event_date"),
    "order_items": TableSpec(schemas.ORDER_ITEMS, "event_date"),
    "session_funnel": TableSpec(schemas.SESSION_FUNNEL, "session_date", ("user_pseudo_id",)),
    "funnel_daily": TableSpec(schemas.FUNNEL_DAILY, "event_date"),
    "device_channel_daily": TableSpec(schemas.DEVICE_CHANNEL_DAILY, "session_date"),
    "device_channel": TableSpec(schemas.DEVICE_CHANNEL, None),
    "user_day_totals": TableSpec(schemas.USER_DAY_TOTALS, "event_date"),
    "user_day_facts": TableSpec(schemas.USER_DAY_FACTS, "event_date"),
    "event_digests": TableSpec(schemas.EVENT_DIGESTS, "event_date"),
    "user_day_sketches": TableSpec(schemas.USER_DAY_SKETCHES, "event_date"),
    "day_sketches": TableSpec(schemas.DAY_SKETCHES, "event_date"),
    "user_last_session": TableSpec(schemas.USER_LAST_SESSION, "as_of", ("user_pseudo_id",)),
    "churn_flags": TableSpec(schemas.CHURN_FLAGS, "decided_on"),
    "feature_day_totals": TableSpec(schemas.FEATURE_DAY_TOTALS, "event_date"),
    "feature_day_facts": TableSpec(schemas.FEATURE_DAY_FACTS, "event_date"),
    "user_features": TableSpec(schemas.USER_FEATURES, None),
    "predictions": TableSpec(schemas.PREDICTIONS, "prediction_date"),
    "prediction_trend": TableSpec(schemas.PREDICTION_TREND, "prediction_date"),
    "run_metrics": TableSpec(schemas.RUN_METRICS, "prediction_date"),
    "runs": TableSpec(schemas.RUNS, "prediction_date"),
}

Day = str | date


@dataclass(frozen=True)
class Warehouse:
    """Tables below one folder that all executors can reach."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def read(self, name: str, days: Sequence[Day] | None = None) -> DataFrame:
        """A table in its declared schema; ``days`` prunes partitions before the scan."""
        spec = TABLES[name]
        if days is not None and not days:
            return self.spark.createDataFrame([], spec.schema)
        df = self.spark.read.schema(spec.schema).parquet(self.path(name))
        df = df.select(*spec.schema.fieldNames())
        if days is None:
            return df
        if spec.partition is None:
            raise ValueError(f"{name} is not partitioned by day")
        return df.where(F.col(spec.partition).isin(*days))

    def days(self, name: str) -> list[Day]:
        """Days the table has a folder for, ascending, of the partition column's type.

        Folder names alone tell; no file is opened. A day that was emptied is among them.
        """
        spec = TABLES[name]
        found = matching_paths(self.spark, f"{self.path(name)}/{spec.partition}=*")
        texts = sorted(path.rsplit("=", 1)[1] for path in found)
        if isinstance(spec.schema[spec.partition].dataType, T.DateType):
            return [date.fromisoformat(text) for text in texts]
        return texts

    def drop_days(self, name: str, days: Sequence[Day]) -> None:
        """Delete the folders of ``days``."""
        for day in days:
            delete_dir(self.spark, self._day_path(name, day))

    def exists(self, name: str) -> bool:
        return path_exists(self.spark, self.path(name))

    def _writer(self, name: str, df: DataFrame):
        """Writer over well-sized files: AQE splits large days and merges small ones."""
        spec = TABLES[name]
        conform(df, spec.schema)
        if spec.partition is None:
            return df.hint("rebalance").write
        laid_out = df.hint("rebalance", spec.partition)
        if spec.sort:
            laid_out = laid_out.sortWithinPartitions(spec.partition, *spec.sort)
        return laid_out.write.partitionBy(spec.partition)

    def append(self, name: str, df: DataFrame) -> None:
        """Add rows; running a day twice stores it twice."""
        self._writer(name, df).mode("append").parquet(self.path(name))

    def replace_days(self, name: str, df: DataFrame, days: Sequence[Day]) -> None:
        """Make ``days`` hold exactly the rows of ``df``; other days stay untouched.

        A row of any other day, or of none, stops the write with that day named. A day for
        which ``df`` has no row ends up empty, also if it held rows before.
        """
        spec = TABLES[name]
        if spec.partition is None:
            raise ValueError(f"{name} is not partitioned by day")
        before = {day: self._files(name, day) for day in days}
        day = F.col(spec.partition)
        foreign = F.concat(
            F.lit(f"{name}: a row of day "), F.coalesce(day.cast("string"), F.lit("NULL")),
            F.lit(" is not among the days to replace"),
        )
        checked = F.when(day.isin(*days), day).otherwise(
            F.raise_error(foreign).cast(spec.schema[spec.partition].dataType)
        )
        chosen = df.withColumn(spec.partition, checked)
        self._writer(name, chosen).mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).parquet(self.path(name))
        rest = T.StructType([f for f in spec.schema.fields if f.name != spec.partition])
        for day in days:
            # File names are unique per write: an old file still there means that no row
            # of this day was written.
            if before[day] & self._files(name, day):
                self.spark.createDataFrame([], rest).write.mode("overwrite").parquet(
                    self._day_path(name, day)
                )

    def _day_path(self, name: str, day: Day) -> str:
        return f"{self.path(name)}/{TABLES[name].partition}={day}"

    def _files(self, name: str, day: Day) -> set[str]:
        return set(matching_paths(self.spark, f"{self._day_path(name, day)}/part-*"))

    def replace_all(self, name: str, df: DataFrame) -> None:
        """Replace the whole table. ``df`` must not read the table it replaces."""
        self._writer(name, df).mode("overwrite").option(
            "partitionOverwriteMode", "static"
        ).parquet(self.path(name))

    def accumulate(
        self, source: str, target: str, days: Sequence[Day], replace: bool = False
    ) -> None:
        """Add the given days of one table to another of the same schema, by name.

        They are appended, or with ``replace`` put in place of those days' rows, so that a
        second run leaves one copy.
        """
        rows = as_schema(self.read(source, days), TABLES[target].schema)
        if replace:
            self.replace_days(target, rows, days)
        else:
            self.append(target, rows)

    def sql(self, query: str, tables: Sequence[str] = (), **args: object) -> DataFrame:
        """Run SQL over named tables. Values are bound as ``:name``, never pasted in.

        Table names in the query are bound too: ``IDENTIFIER(:name)`` finds the view of
        the table of that name.
        """
        bound: dict[str, object] = dict(args)
        for name in tables:
            view = f"warehouse_{name}"
            self.read(name).createOrReplaceTempView(view)
            bound[name] = view
        return self.spark.sql(query, args=bound)


def union_days(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, columns matched by name, absent ones NULL."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first
