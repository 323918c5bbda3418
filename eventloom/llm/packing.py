"""Packing token sequences: first-fit decreasing in randomised groups of documents.

A document is cut at every multiple of the sequence length. Full pieces are sequences by
themselves; the last pieces of a group's documents are packed first-fit decreasing, with a
tournament tree over the bins' free space finding the first bin that fits in log time.

A piece depends on its document alone, so ids never leave the task that made them: the
shuffle carries one short row per document's last piece. Groups are a hash of id, text and
the number of the row among equal ones of its task, modulo a number of groups that follows
the number of documents. So a group holds about ``group_size`` of them at any scale, and
neither a source nor repeated rows can fill one.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, row long"
)
PACKED = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)
# Beyond this many characters the second library takes over: it has no regex stack limit.
LONG_TEXT = 1_000_000


class Encoder:
    """Token ids of a text; two libraries with the same vocabulary and the same result.

    The faster one does the work and hands over ids as an array. Texts of over a million
    characters go to the other.
    """

    def __init__(self, path: str):
        import tiktoken
        import tokenizers

        with open(path, encoding="utf-8") as file:
            self.slow = tokenizers.Tokenizer.from_str(file.read())
        special = {
            token.content: i for i, token in self.slow.get_added_tokens_decoder().items()
        }
        raw = _byte_symbols()
        ranks = {
            bytes(raw[c] for c in piece): i
            for piece, i in self.slow.get_vocab(with_added_tokens=False).items()
            if piece not in special
        }
        self.fast = tiktoken.Encoding(
            "packing", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens=special
        )

    def __call__(self, text: str) -> np.ndarray:
        if len(text) > LONG_TEXT:
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, "<u4")
        return self.fast.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False)


# Fixed value: how byte-level vocabularies of this kind part a text before merging.
_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def _byte_symbols() -> dict[str, int]:
    """Byte of each symbol: printable bytes stand for themselves, others follow from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _pieces(path: str, length: int, end_id: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(path)
        task, seen = TaskContext.get().partitionId(), Counter()
        for batch in batches:
            rows = []
            for doc_id, text, row in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                batch.column(2).to_pylist(), strict=True,
            ):
                # Equal rows may change places; the numbers they get are the same ones.
                seen[row] += 1
                if seen[row] > 1:
                    row = hash((row, task, seen[row]))
                ids = np.append(encode(text or ""), np.uint32(end_id)).astype("<u4")
                for start in range(0, len(ids), length):
                    piece = ids[start : start + length]
                    rows.append(
                        (doc_id, start, len(piece), zlib.crc32(piece.tobytes()), len(ids), row)
                    )
            columns = zip(*rows, strict=True) if rows else [[]] * 6
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "row"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names
            )

    return cut


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset in the bin) of each size; sizes are tried largest first, ties in order.

    A complete binary tree holds the largest free space below each node; a size walks down
    to the leftmost leaf that has room. Bins not yet opened have all their space free.
    """
    n = len(sizes)
    leaves = 1 << max(0, (n - 1).bit_length())
    tree = [capacity] * (2 * leaves)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for item in np.argsort(-sizes, kind="stable").tolist():
        size, node = int(sizes[item]), 1
        while node < leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        bins[item], offsets[item] = node - leaves, capacity - tree[node]
        tree[node] -= size
        while node > 1:
            node //= 2
            best = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == best:
                break
            tree[node] = best
    return bins, offsets


def _pack_group(capacity: int):
    def pack(pieces: pd.DataFrame) -> pd.DataFrame:
        # One order for the same rows, however they arrive after a lost executor.
        pieces = pieces.sort_values(
            ["doc_id", "doc_tokens", "ids_crc32", "start"], kind="stable", na_position="first"
        )
        sizes = pieces["length"].to_numpy()
        full = sizes == capacity
        bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        bins[~full], offsets[~full] = first_fit_decreasing(sizes[~full], capacity)
        used = int(bins[~full].max()) + 1 if (~full).any() else 0
        bins[full] = used + np.arange(int(full.sum()))
        group = int(pieces["pack_group"].iloc[0])
        return pieces.assign(sequence_id=(group << 32) | bins, offset=offsets)[
            [c.split()[0] for c in PACKED.split(", ")]
        ]

    return pack


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = 2048,
    end_id: int = 1,
    group_size: int = 4096,
    seed: int = 42,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A NULL or empty text is the end id alone. Repeated rows are packed each for itself.
    A NULL id is kept. An empty table gives no rows; other columns are not looked at.
    Sequence ids are unique over all groups: the group in the upper 32 bits.
    """
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(text_column).alias("text"),
    ).withColumn("row", F.xxhash64("doc_id", "text", F.lit(seed)))
    groups = max(1, -(-docs.count() // group_size))
    pieces = rows.mapInArrow(_pieces(tokenizer, length, end_id), PIECES)
    # Full pieces go to the group of their document too, where they cost one row each;
    # a long text's pieces are dealt out by their start.
    grouped = pieces.withColumn(
        "pack_group",
        F.pmod(
            F.when(F.col("length") == length, F.xxhash64("row", "start")).otherwise(
                F.xxhash64("row")
            ),
            F.lit(groups),
        ),
    ).drop("row")
    return grouped.groupBy("pack_group").applyInPandas(_pack_group(length), PACKED)
