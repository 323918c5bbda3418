"""Repeated byte strings removed by buckets of suffix positions that are told apart in depth.

The question for a position is whether the ``length`` bytes that start there also start
earlier. Positions are in buckets by a hash of their first bytes, at doubling depths. No
bucket is sorted by the buckets of later offsets, as bucket-pointer refinement does: a
bucket's name follows from the bytes alone, so tasks need not exchange names.

* The bucket of a position at depth 2q follows from its bucket at depth q and that of the
  position q later, so each depth reuses the one before (1, 2, 4, ... 32 bytes).
* Each string holds its least 32-gram. A run of neighbouring positions whose strings share
  the same least 32-gram is placed in that bucket together. A bucket of one run only needs
  no refinement: none of its strings occurs again.
* Runs of larger buckets are compared by the full-depth buckets of their first and last
  position, which together hold all bytes of the run's strings. A run that occurs earlier
  as a whole is settled, and so is every string in it. This settles the inside of copies.
* The positions of the other runs in large buckets, the first of their kind or the rims of
  copies, are taken to full depth one by one and compared with the earliest like them.

Buckets are 64-bit hashes, so every document finds its own; Spark brings equal ones
together (96 bits tell runs apart). Every position of every text takes part.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm.common import _CODES, U64, mix, utf8_buffer
from eventloom.llm.exchange import (
    ANSWERS,
    QUESTIONS,
    answers_of,
    as_table,
    blocked,
    earlier,
    in_order,
    questions,
    shared_and_earlier,
)

Q = 32  # depth of the buckets that runs are placed in; a power of two
_SLICE = 1 << 20  # bytes worked on at a time
_LOW, _HIGH = U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F)


def _refine(here: np.ndarray, later: np.ndarray) -> np.ndarray:
    """Bucket of twice the depth, from the buckets at a position and one depth later."""
    h = here * _LOW + later
    h ^= h >> U64(31)
    h *= _HIGH
    return h


def _buckets(data: np.ndarray) -> np.ndarray:
    """Bucket of every position at depth Q."""
    b, depth = _CODES[data], 1
    while depth < Q and len(b) > depth:
        b = _refine(b[:-depth], b[depth:])
        depth *= 2
    return b if depth == Q else b[:0]


def _full_depth(b: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Bucket at depth ``length`` of the positions ``at``, from buckets at depth Q."""
    h = b[at]
    for offset in range(Q, length, Q):
        h = _refine(h, b[at + min(offset, length - Q)])
    return mix(h)


def _least(b: np.ndarray, width: int) -> np.ndarray:
    """Least of ``width`` neighbours, for every place where so many follow."""
    least, size = b, 1
    while size * 2 <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    rest = width - size
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


class _Runs:
    """Runs of a block: bucket, first and last position, document, refined bucket."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int):
        self.length, width = length, length - Q + 1
        firsts, lasts, places, refined = [], [], [], []
        for begin, stop in _slices(offsets, length):
            piece = data[begin : min(stop + length - 1, len(data))]
            b = _buckets(piece)
            least = _least(b, width)[: stop - begin]
            if not len(least):
                continue
            # A string must end in the document in which it starts.
            at = np.arange(begin, begin + len(least))
            room = _document_ends(offsets, begin, len(least)) >= at + length
            change = np.ones(len(least), bool)
            change[1:] = (least[1:] != least[:-1]) | (room[1:] != room[:-1])
            # The leftmost least gram drops out; the same may follow, as another one.
            change[1:] |= b[: len(least) - 1] == least[:-1]
            edges = offsets[(offsets > begin) & (offsets < begin + len(least))] - begin
            change[edges] = True
            first = np.flatnonzero(change)
            last = np.append(first[1:], len(least)) - 1
            keep = room[first]
            first, last = first[keep], last[keep]
            firsts.append(first + begin)
            lasts.append(last + begin)
            places.append(mix(least[first]))
            ends = _full_depth(b, last, length)
            refined.append(
                mix(_refine(_full_depth(b, first, length), ends) + (last - first).astype(U64))
            )

        def join(parts: list[np.ndarray], kind: type) -> np.ndarray:
            return np.concatenate(parts) if parts else np.zeros(0, kind)

        self.first, self.last = join(firsts, np.int64), join(lasts, np.int64)
        self.bucket, self.refined = join(places, U64), join(refined, U64)

    def positions(self, chosen: np.ndarray) -> np.ndarray:
        """All positions of the chosen runs, in order."""
        first, count = self.first[chosen], (self.last - self.first + 1)[chosen]
        within = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        return np.repeat(first, count) + within


def _slices(offsets: np.ndarray, length: int):
    """Ranges of start positions of about a megabyte; documents may be cut anywhere."""
    total = int(offsets[-1])
    for begin in range(0, max(0, total - length + 1), _SLICE):
        yield begin, min(begin + _SLICE, total)


def _document_ends(offsets: np.ndarray, begin: int, count: int) -> np.ndarray:
    """End of the document each of ``count`` positions from ``begin`` on is in."""
    at = np.clip(offsets, begin, begin + count)
    return np.repeat(offsets[1:], np.diff(at))


def _pairs(bucket: np.ndarray, refined: np.ndarray):
    """Distinct (bucket, refined) pairs, sorted: first row of each, number of each row.

    The check bits are the upper half of ``refined``, as they are between blocks.
    """
    checks = (refined >> U64(32)).astype(np.uint32)
    order = np.lexsort((np.arange(len(bucket)), checks, bucket))
    k, c = bucket[order], checks[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
    number = np.empty(len(k), np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number, checks


def _orders(rows: pa.Table, offsets: np.ndarray, at: np.ndarray, least: int, kind: type):
    """Rank of the document of each position: its id less the smallest id; NULL is least."""
    ids = rows.column("doc_id").combine_chunks()
    values = ids.cast(pa.int64()).fill_null(least - 1).to_numpy(zero_copy_only=False)
    ranks = (values - (least - 1)).astype(kind)
    return ranks[np.searchsorted(offsets, at, side="right") - 1]


class _Refinement:
    """The three turns a block takes; what lies between them happens in buckets."""

    def __init__(self, length: int, buckets: int, least: int, kind: type, texts: bool = False):
        self.length, self.buckets, self.texts = length, buckets, texts
        self.least, self.kind = least, kind

    def ask_runs(self, rows: pa.Table) -> pa.Table:
        block = rows.column("block")[0].as_py()
        rows = in_order(rows)
        data, offsets = utf8_buffer(rows.column("text"))
        runs = _Runs(data, offsets, self.length)
        first, _, checks = _pairs(runs.bucket, runs.refined)
        orders = _orders(rows, offsets, runs.first[first], self.least, self.kind)
        return as_table(
            questions(block, runs.bucket[first], checks[first], orders, self.buckets), QUESTIONS
        )

    def _settle(self, runs: _Runs, answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """Runs that occur earlier as a whole; runs whose positions need a look each."""
        first, number, _ = _pairs(runs.bucket, runs.refined)
        keys = runs.bucket[first]
        several, behind = answers_of(answers, len(first), self.buckets, keys, 2)
        settled = behind[number] | (first[number] != np.arange(len(number)))
        _, inverse, counts = np.unique(runs.bucket, return_inverse=True, return_counts=True)
        large = several[number] | (counts > 1)[inverse]
        return settled, large & ~settled

    def ask_positions(self, rows: pa.Table, answers: pa.Table) -> pa.Table:
        block = rows.column("block")[0].as_py()
        rows = in_order(rows)
        data, offsets = utf8_buffer(rows.column("text"))
        runs = _Runs(data, offsets, self.length)
        settled, looked_at = self._settle(runs, answers)
        at = runs.positions(looked_at)
        keys, first = np.unique(self._at_full_depth(data, at), return_index=True)
        orders = _orders(rows, offsets, at[first], self.least, self.kind)
        none = np.zeros(len(keys), np.uint8)
        asked = questions(block, keys, none, orders, self.buckets)
        # What the first answers came to, for the last turn.
        notes = np.packbits(settled).tobytes() + np.packbits(looked_at).tobytes()
        return as_table([*asked, (block, -1 - block, notes, b"", b"")], QUESTIONS)

    def _at_full_depth(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        parts = []
        for begin in range(0, len(data), _SLICE):
            own = at[np.searchsorted(at, begin) : np.searchsorted(at, begin + _SLICE)]
            if len(own):
                b = _buckets(data[begin : begin + _SLICE + self.length])
                parts.append(_full_depth(b, own - begin, self.length))
        return np.concatenate(parts) if parts else np.zeros(0, U64)

    def remove(self, rows: pa.Table, answers: pa.Table) -> pa.Table:
        rows = in_order(rows)
        data, offsets = utf8_buffer(rows.column("text"))
        runs = _Runs(data, offsets, self.length)
        n = len(runs.first)
        notes = [
            bits
            for bucket, bits in zip(
                answers.column("bucket").to_pylist(), answers.column("bits").to_pylist(),
                strict=True,
            )
            if bucket < 0
        ]
        packed = np.frombuffer(notes[0], np.uint8)
        half = len(packed) // 2
        settled = np.unpackbits(packed[:half], count=n).astype(bool)
        looked_at = np.unpackbits(packed[half:], count=n).astype(bool)
        at = runs.positions(looked_at)
        keys, first, inverse = np.unique(
            self._at_full_depth(data, at), return_index=True, return_inverse=True
        )
        (behind,) = answers_of(answers, len(keys), self.buckets, keys)
        gone = at[behind[inverse] | (first[inverse] != np.arange(len(at)))]

        cover = np.zeros(len(data) + 1, np.int32)
        np.add.at(cover, runs.first[settled], 1)
        np.add.at(cover, runs.last[settled] + self.length, -1)
        np.add.at(cover, gone, 1)
        np.add.at(cover, gone + self.length, -1)
        removed = np.cumsum(cover[:-1]) > 0
        return self._rest(rows, data, offsets, removed)

    def _rest(self, rows, data, offsets, removed) -> pa.Table:
        begins = removed.copy()
        begins[1:] &= ~removed[:-1]
        inner = offsets[:-1][np.diff(offsets) > 0]
        begins[inner] = removed[inner]
        total = np.concatenate(([0], np.cumsum(removed)))
        spans = np.concatenate(([0], np.cumsum(begins)))
        n_removed = np.diff(total[offsets])
        digests, left = [], []
        for i, gone in enumerate(n_removed.tolist()):
            part = slice(offsets[i], offsets[i + 1])
            kept = (data[part][~removed[part]] if gone else data[part]).tobytes()
            digests.append(hashlib.sha256(kept).hexdigest())
            if self.texts:
                left.append(kept.decode("utf-8", errors="ignore"))
        columns = [
            rows.column("doc_id"), pa.array(np.diff(offsets)), pa.array(n_removed),
            pa.array(np.diff(spans[offsets])), pa.array(digests),
        ]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        if self.texts:
            columns += [pa.array(left, pa.string()), rows.column("text").is_null()]
            names += ["kept_text", "was_null"]
        if "carried" in rows.column_names:
            columns.append(rows.column("carried"))
            names.append("carried")
        return pa.table(columns, names)


def remove_repeated_bytes(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = 100,
    keep_texts: bool = False,
    block_bytes: int = 4 << 20,
    bucket_bytes: int = 6 << 20,
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row of ``docs``.

    With ``keep_texts`` also ``kept_text``, whether the text was NULL and, in the struct
    ``carried``, the other columns, which are not looked at otherwise. A character of which
    only some bytes go is left out of ``kept_text`` whole. Of equal
    strings the one in the smallest id stays, in one document the first; rows with the same
    id count in the order of their blocks, a NULL id before all others. NULL texts are empty;
    texts shorter than ``length`` bytes lose nothing. An empty table gives no rows.
    """
    if length < 2 * Q:
        raise ValueError(f"length must be at least {2 * Q}")
    rows, buckets = blocked(
        docs, id_column, text_column, block_bytes, bucket_bytes, carry=keep_texts
    )
    ids = docs.agg(F.min(id_column), F.max(id_column)).first()
    least, most = (ids[0] or 0, ids[1] or 0)
    # Four bytes per rank where the ids' range allows.
    kind = np.uint32 if most - least < (1 << 32) - 2 else np.uint64
    work = _Refinement(length, buckets, least, kind, keep_texts)
    id_kind = rows.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {id_kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )
    if keep_texts:
        schema += ", kept_text string, was_null boolean"
    schema = T.StructType.fromDDL(schema)
    if "carried" in rows.columns:
        schema = schema.add("carried", rows.schema["carried"].dataType)
    by_block = rows.groupBy("block")
    settled = (
        by_block.applyInArrow(lambda rows: work.ask_runs(rows), QUESTIONS)
        .groupBy("bucket")
        .applyInArrow(shared_and_earlier(np.uint32, kind), ANSWERS)
    )
    answers = (
        by_block.cogroup(settled.groupBy("block"))
        .applyInArrow(lambda rows, found: work.ask_positions(rows, found), QUESTIONS)
        .groupBy("bucket")
        .applyInArrow(earlier(np.uint8, kind), ANSWERS)
    )
    return by_block.cogroup(answers.groupBy("block")).applyInArrow(
        lambda rows, found: work.remove(rows, found), schema
    )


def without_repeated_bytes(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options
) -> DataFrame:
    """``docs`` with repeated strings cut out of their texts; same columns.

    Rows of which nothing is left are dropped; empty and NULL texts stay as they are.
    """
    found = remove_repeated_bytes(docs, id_column, text_column, keep_texts=True, **options)
    text = F.when(~F.col("was_null"), F.col("kept_text"))
    named = {id_column: F.col("doc_id"), text_column: text}
    return found.where("n_removed = 0 or n_removed < n_bytes").select(
        *[named.get(c, F.col(f"carried.`{c}`")).alias(c) for c in docs.columns]
    )
