"""Documents in blocks, and questions about keys that blocks ask one another.

A block is a few megabytes of documents that one task holds. It sends the sorted distinct
keys it has to buckets, ranges of the 64-bit key space, one row of packed arrays per
(block, bucket). A bucket compares the keys of all blocks and answers each row with one bit
per key. So a key costs about ten bytes in the shuffle and a bit on the way back, a key that
a third of all documents share arrives once per block, and the sizes of blocks and buckets
stay the same at every scale: their numbers follow the bytes of the input.

Which block a document is in depends on its id and text alone, and blocks are sorted, so a
task that is run again after a lost executor asks and answers the same.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import U64, text_bytes

QUESTIONS = "block int, bucket int, keys binary, checks binary, orders binary"
ANSWERS = "block int, bucket int, bits binary"


def blocked(
    docs: DataFrame, id_column: str, text_column: str, block_bytes: int, bucket_bytes: int,
    carry: bool = False,
) -> tuple[DataFrame, int]:
    """(block, doc_id, text) of all rows, and the number of buckets. NULL texts are empty.

    With ``carry`` a struct of all other columns comes along, whatever their names.
    """
    others = [c for c in docs.columns if c not in (id_column, text_column)]
    more = [F.struct(*others).alias("carried")] if carry and others else []
    rows = docs.select(
        F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"), *more
    )
    _, size = text_bytes(rows, "text")
    blocks, buckets = -(-size // block_bytes) or 1, -(-size // bucket_bytes) or 1
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int")
    return rows.select(place.alias("block"), *rows.columns), buckets


def in_order(rows: pa.Table) -> pa.Table:
    """Rows of a block by id, then text; a NULL id comes first."""
    keys = [("doc_id", "ascending"), ("text", "ascending")]
    return rows.take(pc.sort_indices(rows, sort_keys=keys, null_placement="at_start"))


def planes(values: np.ndarray) -> bytes:
    """The arrays of first bytes, second bytes and so on: sorted values compress that way."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def from_planes(planes: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    by_byte = np.frombuffer(planes, np.uint8).reshape(size, len(planes) // size)
    return np.ascontiguousarray(by_byte.T).view(kind).ravel()


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each key, by its upper half; sorted keys have sorted buckets."""
    return ((keys >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)


def _bucket_runs(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets that sorted ``keys`` are in, and where the keys of each begin and end."""
    place = bucket_of(keys, buckets)
    cuts = np.flatnonzero(np.r_[True, place[1:] != place[:-1], True]) if len(keys) else [0]
    return place[cuts[:-1]], np.asarray(cuts)


def questions(
    block: int, keys: np.ndarray, checks: np.ndarray, orders: np.ndarray | None, buckets: int
) -> list[tuple]:
    """Rows for sorted distinct ``keys`` with further bits and, if asked for, orders."""
    rows = []
    found, cuts = _bucket_runs(keys, buckets)
    for bucket, begin, end in zip(found.tolist(), cuts[:-1], cuts[1:], strict=True):
        part = slice(begin, end)
        order = b"" if orders is None else planes(orders[part])
        rows.append((block, bucket, planes(keys[part]), planes(checks[part]), order))
    return rows


def as_table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [column.split() for column in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [[]] * len(fields)
    return pa.table(
        [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields, strict=True)],
        names=[name for name, _ in fields],
    )


def together(rows: pa.Table, check: type, order: type | None):
    """All keys of a bucket side by side, sorted so that equal ones are adjacent."""
    blobs = rows.column("keys").to_pylist()
    counts = np.array([len(b) // 8 for b in blobs])
    keys = np.concatenate([from_planes(b, U64) for b in blobs])
    checks = np.concatenate([from_planes(b, check) for b in rows.column("checks").to_pylist()])
    by_key = np.argsort(keys, kind="stable")
    k, c = keys[by_key], checks[by_key]
    if ((k[1:] == k[:-1]) & (c[1:] != c[:-1])).any():
        by_key = np.lexsort((checks, keys))
        k, c = keys[by_key], checks[by_key]
    same = np.zeros(len(k), bool)
    same[1:] = (k[1:] == k[:-1]) & (c[1:] == c[:-1])
    orders = None
    if order is not None:
        orders = np.concatenate([from_planes(b, order) for b in rows.column("orders").to_pylist()])
    return counts, keys, by_key, same, orders


def answer_rows(rows: pa.Table, counts: np.ndarray, *bits: np.ndarray) -> pa.Table:
    ends = np.cumsum(counts)
    answers = [
        (block, bucket, b"".join(np.packbits(x[end - n : end]).tobytes() for x in bits))
        for block, bucket, n, end in zip(
            rows.column("block").to_pylist(), rows.column("bucket").to_pylist(),
            counts.tolist(), ends.tolist(), strict=True,
        )
    ]
    return as_table(answers, ANSWERS)


def shared(check: type):
    """Answer: does any other block have this key?"""

    def answer(rows: pa.Table) -> pa.Table:
        counts, keys, by_key, same, _ = together(rows, check, None)
        several = same.copy()
        several[:-1] |= same[1:]
        bits = np.zeros(len(keys), bool)
        bits[by_key] = several
        return answer_rows(rows, counts, bits)

    return answer


def _behind_first(by_key, same, orders, blocks) -> np.ndarray:
    """Whether an entry is not the least (order, block) of its run of equal keys."""
    runs = np.flatnonzero(~same)
    run_of = np.cumsum(~same) - 1
    o, b = orders[by_key], blocks[by_key]
    least = np.minimum.reduceat(o, runs)[run_of]
    first_block = np.minimum.reduceat(np.where(o == least, b, np.iinfo(b.dtype).max), runs)
    late = (o != least) | (b != first_block[run_of])
    bits = np.zeros(len(late), bool)
    bits[by_key] = late
    return bits


def earlier(check: type, order: type):
    """Answer: does any other block have this key, with its document before ours?

    Rows for negative buckets are a block's notes to itself and go back as they are.
    """

    def answer(rows: pa.Table) -> pa.Table:
        if rows.column("bucket")[0].as_py() < 0:
            notes = rows.select(["block", "bucket", "keys"])
            return notes.rename_columns(["block", "bucket", "bits"])
        counts, _, by_key, same, orders = together(rows, check, order)
        blocks = np.repeat(rows.column("block").to_numpy(), counts)
        return answer_rows(rows, counts, _behind_first(by_key, same, orders, blocks))

    return answer


def shared_and_earlier(check: type, order: type):
    """Two answers: has any other block this key; has one before ours key and check bits?"""

    def answer(rows: pa.Table) -> pa.Table:
        counts, keys, by_key, same, orders = together(rows, check, order)
        blocks = np.repeat(rows.column("block").to_numpy(), counts)
        behind = _behind_first(by_key, same, orders, blocks)
        k = keys[by_key]
        alike = np.zeros(len(k), bool)
        alike[1:] = k[1:] == k[:-1]
        runs = np.flatnonzero(~alike)
        several = (
            np.minimum.reduceat(blocks[by_key], runs) != np.maximum.reduceat(blocks[by_key], runs)
        )[np.cumsum(~alike) - 1]
        bits = np.zeros(len(k), bool)
        bits[by_key] = several
        return answer_rows(rows, counts, bits, behind)

    return answer


def answers_of(rows: pa.Table, n: int, buckets: int, keys: np.ndarray, answers: int = 1):
    """Bits for sorted ``keys`` of a block, one array per answer, in the keys' order."""
    found, cuts = _bucket_runs(keys, buckets)
    runs = {b: (cuts[i], cuts[i + 1]) for i, b in enumerate(found.tolist())}
    out = [np.zeros(n, bool) for _ in range(answers)]
    for bucket, bits in zip(
        rows.column("bucket").to_pylist(), rows.column("bits").to_pylist(), strict=True
    ):
        if bucket < 0:
            continue
        a, b = runs[bucket]
        packed = np.frombuffer(bits, np.uint8)
        width = len(packed) // answers
        for i, values in enumerate(out):
            values[a:b] = np.unpackbits(packed[i * width : (i + 1) * width], count=b - a)
    return out
