"""What several operators share: tables, written intermediates, texts as byte buffers.

Operators that work in Arrow batches see a whole column of texts as one UTF-8 buffer
with offsets, so that hashing and counting run over arrays and not over Python strings.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.sources.scratch import new_dir

# Java regular expression of the white space that parts words.
SPACE = r"[\x09-\x0D\x20]"

U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows of ``df`` as a table in the shared folder: lineage ends there."""
    path = new_dir(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def split_words(text: Column) -> Column:
    """Array of the words of a text; NULL and empty texts have none."""
    parts = F.split(F.coalesce(text, F.lit("")), f"{SPACE}+")
    head = (F.get(parts, F.lit(0)) == "").cast("int")
    tail = (F.element_at(parts, -1) == "").cast("int")
    return F.slice(parts, head + 1, F.greatest(F.size(parts) - head - tail, F.lit(0)))


def text_bytes(table_sum: DataFrame, text: str) -> tuple[int, int]:
    """Rows and UTF-8 bytes of all texts: one row reaches the driver."""
    row = table_sum.agg(F.count(F.lit(1)), F.sum(F.octet_length(text))).first()
    return row[0], row[1] or 0


# -- Arrow columns as buffers ----------------------------------------------------------


def utf8_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a NULL text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    starts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    first, last = int(starts[0]), int(starts[-1])
    if data is None or first == last:
        return np.zeros(0, np.uint8), np.zeros(len(starts), np.int64)
    return np.frombuffer(data, np.uint8)[first:last], starts - first


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def word_spans(
    data: np.ndarray, offsets: np.ndarray, inside: np.ndarray | None = None
) -> tuple[np.ndarray, ...]:
    """(starts, ends, document of each word); words never cross documents.

    ``inside`` says which bytes belong to words; all but white space if not given.
    """
    if inside is None:
        inside = ~_IS_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[:-1][np.diff(offsets) > 0]
    begins[edges] = inside[edges]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    lasts = edges[1:] - 1
    stops[lasts] = inside[lasts]
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(stops) + 1
    docs = np.searchsorted(offsets, starts, side="right") - 1
    return starts, ends, docs


# Fixed random-looking constants: odd multipliers of the hashes.
_BASE = 0x9E3779B97F4A7C15
_MIX = 0xD6E8FEB86659FD93


def mix(h: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values over all others, one to one."""
    h = h ^ (h >> U64(32))
    h = h * U64(_MIX)
    h ^= h >> U64(29)
    h *= U64(0xFF51AFD7ED558CCD)
    h ^= h >> U64(32)
    return h


def _byte_codes() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=U64) * U64(_BASE))


_CODES = _byte_codes()
_POWERS = {}


def _powers(n: int) -> np.ndarray:
    if len(_POWERS.get("p", ())) < n:
        size = 1 << max(8, (n - 1).bit_length())
        powers = np.ones(size, U64)
        powers[1:] = U64(0xA24BAED4963EE407)
        _POWERS["p"] = np.multiply.accumulate(powers)
    return _POWERS["p"]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each word, equal in every process."""
    lengths = ends - starts
    total = np.cumsum(lengths)
    out, begin = np.empty(len(starts), U64), 0
    while begin < len(starts):
        # About a megabyte at a time, one word at least.
        before = total[begin] - lengths[begin]
        stop = max(begin + 1, int(np.searchsorted(total, before + (1 << 20), side="right")))
        size = lengths[begin:stop]
        firsts = total[begin:stop] - size - before
        within = np.arange(int(size.sum()), dtype=np.int64) - np.repeat(firsts, size)
        values = _CODES[data[within + np.repeat(starts[begin:stop], size)]]
        values *= _powers(int(size.max()))[within]
        out[begin:stop] = np.add.reduceat(values, firsts) + size.astype(U64)
        begin = stop
    return mix(out)


def slices_of_documents(offsets: np.ndarray, size: int = 2 << 20):
    """Ranges of documents of about ``size`` bytes, one document at least."""
    begin, n = 0, len(offsets) - 1
    while begin < n:
        stop = int(np.searchsorted(offsets, offsets[begin] + size, side="right")) - 1
        stop = min(n, max(begin + 1, stop))
        yield begin, stop
        begin = stop
