"""Tables partitioned by day and bucketed by user: what belongs to a user lies together.

A scan of all days has one partition per bucket, so sums per user, windows per user and joins
on the user need no exchange, however long the history is. Only the rows of the days that are
written are shuffled, once, as they are written.

The layout is declared in the session's catalog over a folder, under a name that follows from
the folder; declaring it again, in another session too, finds what is stored there.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.schemas import as_schema
from eventloom.sources.guards import path_exists
from eventloom.sources.warehouse import TABLES

USER = "user_pseudo_id"
_OVERWRITE = "spark.sql.sources.partitionOverwriteMode"


@dataclass(frozen=True)
class UserTables:
    """Bucketed tables below one folder. ``buckets`` is fixed when a table is first written."""

    spark: SparkSession
    root: str
    buckets: int = 32

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}-{self.buckets}-buckets"

    def _declared(self, name: str) -> str:
        """Name of the catalog table over the folder, its days looked up anew."""
        spec = TABLES[name]
        table = f"by_user_{name}_{zlib.crc32(self.path(name).encode()):08x}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spec.schema.fields)
        if not self.spark.catalog.tableExists(table):
            self.spark.sql(
                f"CREATE TABLE {table} ({columns}) USING parquet "
                f"PARTITIONED BY (`{spec.partition}`) "
                f"CLUSTERED BY ({USER}) SORTED BY ({USER}) INTO {self.buckets} BUCKETS "
                "LOCATION :path",
                args={"path": self.path(name)},
            )
        if path_exists(self.spark, self.path(name)):
            self.spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
        return table

    def replace_days(self, name: str, df: DataFrame) -> None:
        """Make the days that ``df`` has rows of hold exactly those rows; others stay.

        Rows are dealt out by user as the buckets are, so a task writes a bucket's file of
        each day and a bucket has one file a day.
        """
        spec = TABLES[name]
        columns = [c for c in spec.schema.fieldNames() if c != spec.partition]
        rows = as_schema(df, spec.schema).select(*columns, spec.partition)
        dealt = rows.repartition(self.buckets, F.col(USER))
        # Inserting takes no option of the writer: the session says which days are replaced.
        before = self.spark.conf.get(_OVERWRITE)
        self.spark.conf.set(_OVERWRITE, "dynamic")
        try:
            dealt.write.mode("overwrite").insertInto(self._declared(name))
        finally:
            self.spark.conf.set(_OVERWRITE, before)

    def read(self, name: str) -> DataFrame:
        """All days, one partition per bucket where a plan can use that."""
        return self.spark.table(self._declared(name)).select(*TABLES[name].schema.fieldNames())
