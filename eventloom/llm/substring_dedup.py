"""Repeated token windows removed: Rabin-Karp hashes of all windows, counted in Spark.

A window is a fixed number of consecutive words of one document. Its hash rolls along the
document's words. Blocks of documents send the distinct hashes they hold to buckets, which
count in how many blocks each occurs; a block knows its own counts. Windows counted twice
or more, anywhere, are merged into maximal intervals of words, and those are removed. What
is judged is the input, not what is left.

A window is told from others by 80 bits of hash across blocks. Every window of every
document is hashed and counted; none is sampled.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from eventloom.llm.common import U64, mix, utf8_buffer, word_hashes, word_spans
from eventloom.llm.exchange import (
    ANSWERS,
    QUESTIONS,
    answers_of,
    as_table,
    blocked,
    in_order,
    questions,
    shared,
)

_STEP = 0x9FB21C651E98DF25  # odd base of the rolling hash


def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n + 1, base, U64)
    powers[0] = 1
    return np.multiply.accumulate(powers)


def rolling_hashes(tokens: np.ndarray, width: int, base: int = _STEP) -> np.ndarray:
    """Hash of every window of ``width`` tokens: sum of token * base^(width - 1 - place).

    A window's sum is that of two half windows; sums of 1, 2, 4, ... tokens are built by
    doubling, and the binary digits of ``width`` say which to put together.
    """
    n = len(tokens) - width + 1
    if n <= 0:
        return np.zeros(0, U64)
    powers = _powers(base, width)
    total, done = np.zeros(n, U64), 0
    part, size = tokens, 1
    while size <= width:
        if width & size:
            total = total * powers[size] + part[done : done + n]
            done += size
        if 2 * size <= width:
            part = part[:-size] * powers[size] + part[size:]
        size *= 2
    return mix(total)


def _windows(rows: pa.Table, width: int):
    """Words of a block and the hashes, checks and places of all its windows."""
    data, offsets = utf8_buffer(rows.column("text"))
    starts, ends, docs = word_spans(data, offsets)
    words = word_hashes(data, starts, ends)
    hashes = rolling_hashes(words, width)
    inside = docs[width - 1 :] == docs[: len(hashes)] if len(hashes) else np.zeros(0, bool)
    places = np.flatnonzero(inside)
    return offsets, docs, words, hashes[places], places


def _ask(width: int, buckets: int):
    def ask(rows: pa.Table) -> pa.Table:
        block = rows.column("block")[0].as_py()
        _, _, words, hashes, places = _windows(in_order(rows), width)
        keys, first = np.unique(hashes, return_index=True)
        # Further bits of each key, from sums with another base over the same words.
        second = rolling_hashes(words, width, 0x8EBC6AF09C88C6E3)
        checks = (second[places[first]] >> U64(48)).astype(np.uint16)
        return as_table(questions(block, keys, checks, None, buckets), QUESTIONS)

    return ask


def _remove(width: int, buckets: int, texts: bool):
    def remove(rows: pa.Table, answers: pa.Table) -> pa.Table:
        rows = in_order(rows)
        _, docs, words, hashes, places = _windows(rows, width)
        keys, inverse, counts = np.unique(hashes, return_inverse=True, return_counts=True)
        (elsewhere,) = answers_of(answers, len(keys), buckets, keys)
        repeated = places[(elsewhere | (counts > 1))[inverse]]
        cover = np.zeros(len(words) + 1, np.int32)
        np.add.at(cover, repeated, 1)
        np.add.at(cover, repeated + width, -1)
        kept = np.cumsum(cover[:-1]) == 0
        n = np.bincount(docs, minlength=len(rows))
        removed = np.bincount(docs, weights=~kept, minlength=len(rows)).astype(np.int64)
        at, digests, left = 0, [], []
        for text, size, gone in zip(
            rows.column("text").cast(pa.large_binary()).to_pylist(), n.tolist(),
            removed.tolist(), strict=True,
        ):
            tokens = (text or b"").split()
            if gone:
                tokens = compress(tokens, kept[at : at + size])
            at += size
            joined = b" ".join(tokens)
            digests.append(hashlib.sha256(joined).hexdigest())
            left.append(joined.decode() if texts else None)
        columns = [rows.column("doc_id"), pa.array(n), pa.array(removed), pa.array(digests)]
        names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
        if texts:
            columns.append(pa.array(left, pa.string()))
            names.append("kept_text")
        return pa.table(columns, names)

    return remove


def remove_repeated_windows(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    width: int = 35,
    keep_texts: bool = False,
    block_bytes: int = 4 << 20,
    bucket_bytes: int = 16 << 20,
) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, if asked for, kept_text of every row.

    NULL and empty texts have no words; texts shorter than a window lose none. Repeated
    rows are documents like any other: their windows repeat, so both lose them. NULL ids
    are kept. An empty table gives no rows; other columns are not looked at.
    """
    rows, buckets = blocked(docs, id_column, text_column, block_bytes, bucket_bytes)
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string"
    if keep_texts:
        schema += ", kept_text string"
    by_block = rows.groupBy("block")
    answers = (
        by_block.applyInArrow(_ask(width, buckets), QUESTIONS)
        .groupBy("bucket")
        .applyInArrow(shared(np.uint16), ANSWERS)
    )
    return by_block.cogroup(answers.groupBy("block")).applyInArrow(
        _remove(width, buckets, keep_texts), schema
    )
