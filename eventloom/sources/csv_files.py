"""CSV in and out: sharded files with a header row."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.schemas import as_schema
from eventloom.sources.guards import MissingInput, path_exists, require_path
from eventloom.sources.warehouse import TABLES, Warehouse, union_days


def write_csv(df: DataFrame, path: str) -> None:
    """One CSV file with header per partition. NULL and empty text stay apart."""
    df.write.mode("overwrite").option("header", True).option("emptyValue", '""').csv(path)


def write_sorted_csv(df: DataFrame, path: str, *order: str | Column) -> None:
    """CSV files that read one after the other, by name, are sorted by ``order``.

    The rows are dealt out by ranges of ``order``, so every task sorts and writes a range of
    its own and the files are numbered as the ranges are. A name alone sorts upwards with
    NULLs last.
    """
    keys = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order]
    write_csv(df.orderBy(*keys), path)


def with_file_positions(rows: DataFrame, name: str = "position") -> DataFrame:
    """Number the rows of files read from 1, in the order of file names and within files.

    ``rows`` is a scan. Rows are numbered per file; one short row per file adds up how many
    rows the files before it have.
    """
    columns = rows.columns
    placed = rows.select(
        "*",
        F.col("_metadata.file_name").alias("_file"),
        F.struct("_metadata.file_block_start", F.monotonically_increasing_id()).alias("_at"),
    )
    in_file = F.row_number().over(Window.partitionBy("_file").orderBy("_at"))
    sizes = placed.groupBy("_file").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_file", F.coalesce(before, F.lit(0)).alias("_before"))
    numbered = placed.withColumn("_row", in_file).join(offsets, "_file")
    return numbered.select(*columns, (F.col("_before") + F.col("_row")).alias(name))


def _reader(spark: SparkSession, multi_line: bool):
    """A file is split among tasks unless its texts may hold line ends (``multi_line``)."""
    return (
        spark.read.option("header", True)
        .option("mode", "PERMISSIVE")
        .option("multiLine", multi_line)
        .option("escape", "\\")
    )


_BLOCK = 4 << 20  # files up to this size are read through for their first line
_AT_ONCE = 64  # larger files asked for their first line in one job


def _first_lines(spark: SparkSession, small: Sequence[str], large: Sequence[str]):
    """(path, first line) of files.

    Small files are scanned together. Of a large file a limit of one row reads no more than a
    buffer: the scan stops there.
    """
    found = []
    if small:
        lines = spark.read.text(list(small)).select(
            F.col("_metadata.file_path").alias("path"),
            F.struct(
                "_metadata.file_block_start", F.monotonically_increasing_id().alias("n")
            ).alias("at"),
            "value",
        )
        found += lines.groupBy("path").agg(F.min_by("value", "at").alias("header")).collect()
    for k in range(0, len(large), _AT_ONCE):
        frames = [
            spark.read.text(path).limit(1).select(F.lit(path).alias("path"), "value")
            for path in large[k : k + _AT_ONCE]
        ]
        found += reduce(DataFrame.unionAll, frames).collect()
    return found


def _files_by_header(spark: SparkSession, pattern: str) -> dict[str, list[str]]:
    """Paths of the files by header line, from at most a block of each file.

    A path and a header line per file reach the driver. Empty files are left out.
    """
    if not path_exists(spark, pattern):
        return {}
    files = spark.read.format("binaryFile").load(pattern).select("path", "length")
    sizes = {r.path: r.length for r in files.where("length > 0").collect()}
    small = sorted(path for path, size in sizes.items() if size <= _BLOCK)
    large = sorted(path for path, size in sizes.items() if size > _BLOCK)
    by_header: dict[str, list[str]] = {}
    for path, header in _first_lines(spark, small, large):
        by_header.setdefault(header.rstrip("\r"), []).append(path)
    return {header: sorted(paths) for header, paths in sorted(by_header.items())}


def read_csv_shards(
    spark: SparkSession,
    pattern: str,
    schema: T.StructType,
    columns: Sequence[str] | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """All files matching ``pattern`` as one frame, columns matched by header name.

    There is one scan per distinct header and not one per file. A column missing from some
    files is NULL there, one that ``schema`` does not know is left out, and a field that
    does not fit its type is NULL. Only ``columns`` are parsed.
    """
    by_header = _files_by_header(spark, pattern)
    if not by_header:
        raise MissingInput(f"no CSV files match {pattern}")
    wanted = list(columns or schema.fieldNames())
    frames = []
    for paths in by_header.values():
        names = spark.read.option("header", True).csv(paths[0]).columns
        known = set(schema.fieldNames())
        order = T.StructType(
            [schema[n] if n in known else T.StructField(n, T.StringType()) for n in names]
        )
        frames.append(
            _reader(spark, multi_line)
            .schema(order)
            .csv(paths)
            .select(*[n for n in names if n in wanted])
        )
    empty = spark.createDataFrame([], schema).select(*wanted)
    return union_days(empty, *frames).select(*wanted)


def scan_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    columns: Sequence[str] | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Lazy scan of one file or folder with declared types, columns found by their names."""
    return read_csv_shards(spark, path, schema, columns, multi_line)


_NUMBERS = (T.IntegerType(), T.LongType(), T.DoubleType())


def _common(one: T.DataType, other: T.DataType) -> T.DataType:
    if one == other:
        return one
    if one in _NUMBERS and other in _NUMBERS:
        return max(one, other, key=_NUMBERS.index)
    return T.StringType()


def infer_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Scan with column types guessed from the data. Reads the data once to guess.

    Columns are matched by header name. One that is guessed otherwise under other headers
    has the widest type if all are numbers, and else is text.
    """
    require_path(spark, path)
    by_header = _files_by_header(spark, path)
    if not by_header:
        raise MissingInput(f"no CSV files match {path}")
    guesses = [
        (paths, _reader(spark, multi_line).option("inferSchema", True).csv(paths).schema)
        for paths in by_header.values()
    ]
    types: dict[str, T.DataType] = {}
    for _, guess in guesses:
        for f in guess:
            types[f.name] = _common(types.get(f.name, f.dataType), f.dataType)
    frames = [
        _reader(spark, multi_line)
        .schema(T.StructType([T.StructField(f.name, types[f.name]) for f in guess]))
        .csv(paths)
        for paths, guess in guesses
    ]
    return union_days(*frames)


def load_csv(
    warehouse: Warehouse, path: str, table: str, infer: bool = False, multi_line: bool = False
) -> None:
    """Append CSV files with a header to a table of the warehouse, by column name."""
    schema = TABLES[table].schema
    if infer:
        df = infer_csv(warehouse.spark, path, multi_line)
    else:
        df = scan_csv(warehouse.spark, path, schema, multi_line=multi_line)
    warehouse.append(table, as_schema(df, schema))
