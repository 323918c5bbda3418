"""Brown class-based n-grams: words exchanged between classes, texts scored by class bigrams.

P(word | word before) = P(class | class before) * P(word | class). Which class a word is in
is learned by exchange: a word moves to the class where the likelihood of all training tokens
gains most, given the classes of its neighbours.

1. Tasks cut the documents they read into blocks of some megabytes. A block keeps its tokens
   as ranks among its distinct words, the most frequent first.
2. The words (64-bit hashes) go with their counts to buckets of the key space, the lexicon:
   every word of the training documents with its count.
3. A turn of the exchange: buckets tell the blocks the present classes of their words; blocks
   count, for each word, the classes to its left and right; buckets add these up. The matrix
   of class bigrams, a few thousand numbers, goes through the driver. Each bucket then walks
   through its words, most frequent first, in its own copy of the matrix. The classes with the
   best likelihood of all turns stay.
4. Buckets tell the blocks classes and counts, and blocks score their documents.

Blocks and lists stay on the executors' disks between turns, dealt by block and by bucket, so a
turn moves classes and counts only. Everything is counted over all training documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import (
    U64,
    slices_of_documents,
    text_bytes,
    utf8_buffer,
    word_hashes,
    word_spans,
    written,
)
from eventloom.llm.exchange import bucket_of, from_planes, planes
from eventloom.sources.scratch import delete_scratch

LISTS = "block long, bucket int, keys binary, counts binary"
REPLIES = "block long, bucket int, places binary, classes binary, counts binary"
CONTEXTS = "bucket int, places binary, entries binary, slots binary, counts binary"
WORDS = "bucket int, words binary, counts binary, classes binary"
END = U64(0xE0D0_F7E4_7E57_0001)  # stands for the end of a text; no word's hash but by chance
_NONE = 255  # class of words that no training document has


def _packed(values: np.ndarray) -> bytes:
    """The bytes of an array, compressed."""
    return len(values).to_bytes(8, "little") + values.dtype.str.encode().ljust(4) + (
        pa.compress(planes(values), codec="zstd", asbytes=True) if len(values) else b""
    )


def _unpacked(data: bytes) -> np.ndarray:
    n, kind = int.from_bytes(data[:8], "little"), np.dtype(data[8:12].decode().strip())
    if not n:
        return np.zeros(0, kind)
    return from_planes(
        pa.decompress(data[12:], n * kind.itemsize, codec="zstd", asbytes=True), kind
    )


def _small(values: np.ndarray) -> np.ndarray:
    """Counts in as few bytes as hold them."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0))))


# -- blocks ----------------------------------------------------------------------------


def tokens_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens with A-Z lowered, an end after each document; tokens per document."""
    lowered = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    starts, ends, docs = word_spans(lowered, offsets)
    n = len(offsets) - 1
    size = np.bincount(docs, minlength=n) + 1
    tokens = np.full(len(starts) + n, END, U64)
    tokens[np.arange(len(starts)) + docs] = word_hashes(lowered, starts, ends)
    return tokens, size


def _cut(batches: Iterator[pa.RecordBatch], block_bytes: int):
    """(block, documents of a batch, their ids, held out, tokens, tokens per document).

    Blocks are numbered within their task, so a task that runs again makes the same.
    """
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        data, offsets = utf8_buffer(batch.column("text"))
        held = batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
        for a, b in slices_of_documents(offsets, block_bytes):
            number += 1
            part = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            yield number, batch.column("doc_id")[a:b], held[a:b], *tokens_of(*part)


def _blocks(block_bytes: int, kind: pa.DataType):
    """Blocks with their tokens as ranks: words by falling count, then by hash."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, ids, held, tokens, size in _cut(batches, block_bytes):
            _, places, totals = np.unique(tokens, return_inverse=True, return_counts=True)
            rank = np.empty(len(totals), np.int64)
            rank[_by_count(totals)] = np.arange(len(totals))
            sent = (held.astype(np.uint8), _small(size), _small(rank[places]), _small(totals))
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([ids.to_pylist()], kind),
                 *(pa.array([_packed(x)], pa.binary()) for x in sent)],
                ["block", "doc_ids", "held", "sizes", "tokens", "totals"],
            )

    return blocks


def _by_count(totals: np.ndarray) -> np.ndarray:
    return np.argsort(-totals.astype(np.int64), kind="stable")


def _lists(block_bytes: int, buckets: int):
    """A row per block and bucket: sorted words and how often training documents have them."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _, held, tokens, size in _cut(batches, block_bytes):
            keys, places = np.unique(tokens, return_inverse=True)
            train = places[np.repeat(~held, size)]
            counts = _small(np.bincount(train, minlength=len(keys)))
            place = bucket_of(keys, buckets)
            cuts = np.flatnonzero(np.r_[True, place[1:] != place[:-1], True])
            yield pa.RecordBatch.from_arrays(
                [pa.array([block] * (len(cuts) - 1), pa.int64()),
                 pa.array(place[cuts[:-1]], pa.int32()),
                 *(pa.array([_packed(x[a:b]) for a, b in zip(cuts, cuts[1:])], pa.binary())
                   for x in (keys, counts))],
                ["block", "bucket", "keys", "counts"],
            )

    return send


def _sums(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes, sorted, and the sum of each one's counts."""
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order].astype(np.int64)
    first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else []
    if not len(codes):
        return codes, counts
    return codes[first], np.add.reduceat(counts, first)


def _joined(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    parts = [_unpacked(x).astype(kind) for x in column.to_pylist()]
    return np.concatenate([np.zeros(0, kind), *parts])


def _lexicon(rows: pa.Table) -> pa.Table:
    """Words of a bucket with their counts, and sums the driver wants to know."""
    keys, counts = _sums(_joined(rows.column("keys"), U64), _joined(rows.column("counts"), np.int64))
    keys, counts = keys[counts > 0], counts[counts > 0]
    top = np.argsort(-counts, kind="stable")[:_NONE]
    stats = [len(keys), int(counts.sum()), int((counts == 1).sum()), int((counts == 2).sum())]
    return pa.table(
        [rows.column("bucket").slice(0, 1), pa.array([_packed(keys)], pa.binary()),
         pa.array([_packed(_small(counts))], pa.binary()), pa.array([stats], pa.list_(pa.int64())),
         pa.array([keys[top].view(np.int64).tolist()], pa.list_(pa.int64())),
         pa.array([counts[top].tolist()], pa.list_(pa.int64()))],
        ["bucket", "words", "counts", "stats", "top_words", "top_counts"],
    )


# -- the exchange ----------------------------------------------------------------------


def _reply(with_counts: bool):
    """To each block: the places in the lexicon, from 1, and the classes of its words."""

    def reply(lists: pa.Table, state: pa.Table) -> pa.Table:
        words, counts, classes = (
            _unpacked(state.column(c)[0].as_py()) if len(state) else np.zeros(0, kind)
            for c, kind in (("words", U64), ("counts", np.int64), ("classes", np.uint8))
        )
        rows = []
        for block, bucket, keys in zip(
            *(lists.column(c).to_pylist() for c in ("block", "bucket", "keys")), strict=True
        ):
            keys = _unpacked(keys)
            at = np.minimum(np.searchsorted(words, keys), max(len(words) - 1, 0))
            known = words[at] == keys if len(words) else np.zeros(len(keys), bool)
            place = np.where(known, at + 1, 0)
            group = np.full(len(keys), _NONE, np.uint8)
            number = np.zeros(len(keys), np.int64)
            group[known], number[known] = classes[at[known]], counts[at[known]]
            sent = (_small(place), group, _small(number) if with_counts else number[:0])
            rows.append((block, bucket, *map(_packed, sent)))
        kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
        columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
        return pa.table(
            [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)],
            [c.split()[0] for c in REPLIES.split(", ")],
        )

    return reply


def _answers(replies: pa.Table, column: str, kind: type) -> np.ndarray:
    """What the buckets say of a block's words, in the order of its list."""
    order = np.argsort(replies.column("bucket").to_numpy(), kind="stable")
    return _joined(replies.column(column).take(pa.array(order)), kind)


def _places(blocks: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Held out, tokens per document, and each token's place in the block's sorted words."""
    held, size, tokens, totals = (
        _unpacked(blocks.column(c)[0].as_py()) for c in ("held", "sizes", "tokens", "totals")
    )
    return held == 1, size.astype(np.int64), _by_count(totals)[tokens]


def _neighbours(blocks: pa.Table, classes: np.ndarray, k: int):
    """Tokens of the training documents with their left class (k: the start) and right class
    (-1 after the end)."""
    held, size, tokens = _places(blocks)
    train = np.repeat(~held, size)
    ends = np.cumsum(size)
    own = classes[tokens].astype(np.int64)
    left, right = np.empty(len(own), np.int64), np.full(len(own), -1, np.int64)
    left[1:], right[:-1] = own[:-1], own[1:]
    left[ends - size], right[ends - 1] = k, -1
    return tokens[train], left[train], right[train]


def _contexts(k: int):
    """To each bucket: how often its words have each class to the left and to the right."""

    def count(blocks: pa.Table, replies: pa.Table) -> pa.Table:
        classes = _answers(replies, "classes", np.uint8)
        places = _answers(replies, "places", np.int64)
        tokens, left, right = _neighbours(blocks, classes, k)
        slots = 2 * k + 1
        codes = np.concatenate((tokens * slots + left, (tokens * slots + k + 1 + right)[right >= 0]))
        codes, counts = np.unique(codes, return_counts=True)
        word, slot = codes // slots, (codes % slots).astype(np.uint8)
        rows, at = [], 0
        sizes = {
            bucket: int.from_bytes(part[:8], "little")
            for bucket, part in zip(
                replies.column("bucket").to_pylist(), replies.column("classes").to_pylist(), strict=True
            )
        }
        for bucket in sorted(sizes):
            a, b = np.searchsorted(word, (at, at + sizes[bucket]))
            at += sizes[bucket]
            if a < b:
                some, entries = np.unique(word[a:b], return_counts=True)
                sent = (_small(places[some] - 1), _small(entries), slot[a:b], _small(counts[a:b]))
                rows.append((bucket, *map(_packed, sent)))
        kinds = (pa.int32(), *[pa.binary()] * 4)
        columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
        return pa.table(
            [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)],
            [c.split()[0] for c in CONTEXTS.split(", ")],
        )

    return count


def _entries(rows: pa.Table, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """(place * slots + slot, count) of all contexts sent to a bucket, added up."""
    codes = []
    for places, entries, slot in zip(
        *(rows.column(c).to_pylist() for c in ("places", "entries", "slots")), strict=True
    ):
        place = np.repeat(_unpacked(places).astype(np.int64), _unpacked(entries))
        codes.append(place * slots + _unpacked(slot))
    return _sums(np.concatenate([np.zeros(0, np.int64), *codes]), _joined(rows.column("counts"), np.int64))


def _matrix(k: int):
    """A block's share of the matrix of class bigrams."""

    def matrix(blocks: pa.Table, replies: pa.Table) -> pa.Table:
        classes = _answers(replies, "classes", np.uint8)
        tokens, left, _ = _neighbours(blocks, classes, k)
        cells = np.bincount(left * k + classes[tokens], minlength=(k + 1) * k)
        return pa.table([pa.array([cells.tolist()], pa.list_(pa.int64()))], ["matrix"])

    return matrix


GATHERED = f"{WORDS}, codes binary, sums binary, matrix array<long>"


def _gather(k: int):
    """All contexts of a bucket's words, and its share of the matrix of class bigrams."""

    def gather(contexts: pa.Table, state: pa.Table) -> pa.Table:
        slots = 2 * k + 1
        codes, sums = _entries(contexts, slots)
        classes = _unpacked(state.column("classes")[0].as_py())
        lefts = codes % slots <= k
        matrix = np.zeros((k + 1) * k, np.int64)
        np.add.at(
            matrix, codes[lefts] % slots * k + classes[codes[lefts] // slots], sums[lefts]
        )
        out = state.select([c.split()[0] for c in WORDS.split(", ")]).slice(0, 1)
        steps = np.diff(codes, prepend=0)
        for name, value in (("codes", _small(steps)), ("sums", _small(sums))):
            out = out.append_column(name, pa.array([_packed(value)], pa.binary()))
        return out.append_column("matrix", pa.array([matrix.tolist()], pa.list_(pa.int64())))

    return gather


def _h(x: np.ndarray) -> np.ndarray:
    x = np.maximum(x, 0)
    return x * np.log(np.maximum(x, 1))


def likelihood(matrix: np.ndarray) -> float:
    """Log-likelihood of the training tokens but for a constant of their counts."""
    rows, columns = matrix.sum(axis=1), matrix.sum(axis=0)
    return float(_h(matrix).sum() - _h(rows).sum() - _h(columns).sum())


def exchange(
    codes: np.ndarray, sums: np.ndarray, classes: np.ndarray, matrix: np.ndarray, batch: int = 256
) -> np.ndarray:
    """New classes of a bucket's words: each goes where the likelihood is largest.

    ``codes`` are place * (2k + 1) + slot, sorted; slots up to k are left classes, the others
    right ones. Words are taken by falling count, ``batch`` at a time; each batch sees the
    moves of those before it.
    """
    k = matrix.shape[1]
    slots = 2 * k + 1
    n, classes = matrix.astype(np.float64), classes.astype(np.int64)
    begin = np.searchsorted(codes, np.arange(len(classes) + 1) * slots)
    total = np.concatenate(([0], np.cumsum(sums)))
    order = np.argsort(-(total[begin[1:]] - total[begin[:-1]]), kind="stable")
    for s in range(0, len(order), batch):
        some = order[s : s + batch]
        length = begin[some + 1] - begin[some]
        some, length = some[length > 0], length[length > 0]
        if not len(some):
            continue
        first = np.cumsum(length) - length
        at = np.arange(int(length.sum())) - np.repeat(first, length) + np.repeat(begin[some], length)
        slot, count = codes[at] % slots, sums[at].astype(np.float64)
        owner = np.repeat(np.arange(len(some)), length)
        left = slot <= k
        own = classes[some]
        # Row e of ``cells``: what entry e adds to, for every class its word might be in.
        cells = np.where(left[:, None], n[np.minimum(slot, k)], n[:k, np.maximum(slot - k - 1, 0)].T)
        gain = np.add.reduceat(_h(cells + count[:, None]) - _h(cells), first)
        mine = cells[np.arange(len(at)), own[owner]]
        stay = np.add.reduceat(_h(mine) - _h(mine - count), first)
        lefts, rights = (
            np.bincount(owner, weights=count * side, minlength=len(some)) for side in (left, ~left)
        )
        rows, columns = n.sum(axis=1)[:k], n.sum(axis=0)
        gain -= _h(rows + rights[:, None]) - _h(rows) + _h(columns + lefts[:, None]) - _h(columns)
        stay -= (
            _h(rows[own]) - _h(rows[own] - rights) + _h(columns[own]) - _h(columns[own] - lefts)
        )
        gain[np.arange(len(some)), own] = stay
        best = np.argmax(gain, axis=1)
        moved = gain[np.arange(len(some)), best] > stay + 1e-9
        go = moved[owner]
        a, b, side = own[owner][go], best[owner][go], left[go]
        c, x = slot[go], count[go]
        np.add.at(n, (c[side], a[side]), -x[side])
        np.add.at(n, (c[side], b[side]), x[side])
        np.add.at(n, (a[~side], c[~side] - k - 1), -x[~side])
        np.add.at(n, (b[~side], c[~side] - k - 1), x[~side])
        classes[some[moved]] = best[moved]
    return classes.astype(np.uint8)


def _exchanged(matrix: np.ndarray):
    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("bucket", "words", "counts")]
            for bucket, words, counts, classes, codes, sums in zip(
                *columns, *(batch.column(c).to_pylist() for c in ("classes", "codes", "sums")),
                strict=True,
            ):
                codes = np.cumsum(_unpacked(codes).astype(np.int64))
                new = exchange(codes, _unpacked(sums), _unpacked(classes), matrix)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([bucket], pa.int32()),
                     *(pa.array([x], pa.binary()) for x in (words, counts, _packed(new)))],
                    ["bucket", "words", "counts", "classes"],
                )

    return move


def _first_classes(top: dict[int, int], k: int):
    """The most frequent words are classes of their own, all others are one."""

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, words, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                keys = _unpacked(words).view(np.int64)
                classes = np.full(len(keys), k - 1, np.uint8)
                for key, number in top.items():
                    classes[keys == key] = number
                yield pa.RecordBatch.from_arrays(
                    [pa.array([bucket], pa.int32()),
                     *(pa.array([x], pa.binary()) for x in (words, counts, _packed(classes)))],
                    ["bucket", "words", "counts", "classes"],
                )

    return begin


# -- the model -------------------------------------------------------------------------


@dataclass
class ClassModel:
    """Smoothed probabilities; a few thousand numbers.

    An absolute discount of every known word's count makes room for one unknown word per
    class. The context after an unknown word is a mixture of all classes.
    """

    tokens: int
    types: int
    discount: float
    matrix: np.ndarray  # class bigrams; the last row is the start of a text
    class_types: np.ndarray
    prior: float = 1.0

    def __post_init__(self):
        k = self.matrix.shape[1]
        self.sizes = self.matrix.sum(axis=0)
        share = (self.sizes + 1) / (self.sizes.sum() + k)
        rows = self.matrix.sum(axis=1, keepdims=True)
        known = (self.matrix + self.prior * share) / (rows + self.prior)
        mixed = self.class_types / max(self.types, 1)
        # Contexts: the classes, the start, an unknown word before.
        self.transitions = np.vstack([known, mixed @ known[:k] if self.types else share])
        self.unknown = np.where(
            self.sizes > 0, self.discount * self.class_types / np.maximum(self.sizes, 1), 1.0
        )

    def scores(self, classes: np.ndarray, counts: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """log10 probability of each token after the one before; texts begin at ``starts``."""
        k = self.matrix.shape[1]
        before = np.empty(len(classes), np.int64)
        before[1:] = np.where(classes[:-1] == _NONE, k + 1, classes[:-1])
        before[starts] = k
        known = classes != _NONE
        own = np.where(known, classes, 0)
        to_class = np.log10(self.transitions)[before, own]
        emitted = (counts - self.discount) / np.maximum(self.sizes, 1)[own]
        to_unknown = np.log10(self.transitions @ self.unknown)[before]
        return np.where(known, to_class + np.log10(np.where(known, emitted, 1)), to_unknown)


SCORED = "held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score(model: ClassModel, kind: pa.DataType):
    def score(blocks: pa.Table, replies: pa.Table) -> pa.Table:
        held, size, tokens = _places(blocks)
        counts = _answers(replies, "counts", np.int64)[tokens]
        classes = _answers(replies, "classes", np.int64)[tokens]
        starts = np.cumsum(size) - size
        base = np.log10((counts + 1) / (model.tokens + model.types + 1))
        own = model.scores(classes, counts, starts) if model.tokens else base
        n = len(held)
        return pa.table(
            [pa.array(blocks.column("doc_ids")[0].as_py(), kind), pa.array(held), pa.array(size),
             pa.array(np.add.reduceat((counts > 0).astype(np.int64), starts)),
             pa.array(np.full(n, model.tokens)), pa.array(np.add.reduceat(base, starts)),
             pa.array(np.add.reduceat(own, starts))],
            ["doc_id", *[c.split()[0] for c in SCORED.split(", ")]],
        )

    return score


def _class_types(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        total = np.zeros(_NONE, np.int64)
        for classes in batch.column(0).to_pylist():
            total += np.bincount(_unpacked(classes), minlength=_NONE)[:_NONE]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(total[some])], ["cell", "n"]
        )


def _cells(rows: DataFrame, column: str, k: int) -> np.ndarray:
    """Sum over all rows of an array of (k + 1) * k numbers."""
    cells = rows.select(F.posexplode(column).alias("cell", "n")).groupBy("cell").agg(F.sum("n"))
    matrix = np.zeros((k + 1) * k, np.int64)
    for cell, n in cells.collect():
        matrix[cell] = n
    return matrix.reshape(k + 1, k)


def score_texts(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    classes: int = 32,
    turns: int = 3,
    folds: int = 7,
    held_out_fold: int = 2,
    block_bytes: int = 8 << 20,
    bucket_bytes: int = 16 << 20,
    report: dict | None = None,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    Rows with crc32 of the id as text modulo ``folds`` other than ``held_out_fold`` are learned
    from; so are those with a NULL id. NULL and empty texts are the end token alone. Repeated
    rows are learned from and scored each for itself. Without training rows every token is
    unknown and both scores are 0. An empty table gives no rows; other columns are not looked
    at. ``docs`` is a table as read, or any plan whose partitions hold the same rows in the
    same order when run again. From 2 to 127 classes. ``report`` receives the likelihood of
    every turn, the model and the table of classes.
    """
    spark = docs.sparkSession
    fold = F.pmod(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(folds))
    rows = docs.select(
        F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"),
        F.coalesce(fold == held_out_fold, F.lit(False)).alias("held_out"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    _, size = text_bytes(rows, "text")
    buckets = -(-size // bucket_bytes) or 1
    # With fewer partitions than a shuffle has, what is kept would be dealt again each turn.
    parts = max(buckets, int(spark.conf.get("spark.sql.shuffle.partitions")))
    arrow_kind = rows.select("doc_id").limit(0).toArrow().schema.field(0).type
    cut = rows.mapInArrow(
        _blocks(block_bytes, pa.list_(arrow_kind)),
        f"block long, doc_ids array<{kind}>, held binary, sizes binary, tokens binary, "
        "totals binary",
    )
    blocks = cut.repartition(parts, "block").persist(StorageLevel.DISK_ONLY)
    lists = (
        rows.mapInArrow(_lists(block_bytes, buckets), LISTS)
        .repartition(parts, "bucket")
        .persist(StorageLevel.DISK_ONLY)
    )
    lexicon = written(
        lists.groupBy("bucket").applyInArrow(
            _lexicon,
            "bucket int, words binary, counts binary, stats array<long>, "
            "top_words array<long>, top_counts array<long>",
        ),
        "classes-lexicon",
    )
    types, tokens, once, twice = lexicon.agg(
        *(F.coalesce(F.sum(F.col("stats")[i]), F.lit(0)) for i in range(4))
    ).first()
    frequent = lexicon.select(F.explode(F.arrays_zip("top_words", "top_counts")).alias("t"))
    top = frequent.select("t.*").orderBy(F.desc("top_counts"), "top_words").limit(classes - 1)
    first = {row["top_words"]: i for i, row in enumerate(top.collect())}
    state = written(
        lexicon.select("bucket", "words", "counts").mapInArrow(_first_classes(first, classes), WORDS),
        "classes-state",
    )

    def asked(state: DataFrame, counts: bool):
        replies = (
            lists.groupBy("bucket").cogroup(state.groupBy("bucket"))
            .applyInArrow(_reply(counts), REPLIES)
        )
        return blocks.groupBy("block").cogroup(replies.groupBy("block"))

    best, matrix = None, None
    for turn in range(turns + 1):
        if turn < turns:
            contexts = asked(state, False).applyInArrow(_contexts(classes), CONTEXTS)
            gathered = written(
                contexts.groupBy("bucket").cogroup(state.groupBy("bucket"))
                .applyInArrow(_gather(classes), GATHERED),
                "classes-gathered",
            )
            matrix = _cells(gathered, "matrix", classes)
        else:
            shares = asked(state, False).applyInArrow(_matrix(classes), "matrix array<long>")
            matrix = _cells(shares, "matrix", classes)
        value = likelihood(matrix)
        if report is not None:
            report.setdefault("likelihoods", []).append(value)
        if best is None or value > best[0]:
            best = value, state, matrix
        if turn < turns:
            state = written(gathered.mapInArrow(_exchanged(matrix), WORDS), "classes-state")
            delete_scratch(gathered)

    _, state, matrix = best
    per_class = np.zeros(classes, np.int64)
    members = state.select("classes").mapInArrow(_class_types, "cell int, n long")
    for cell, n in members.groupBy("cell").agg(F.sum("n")).collect():
        per_class[cell] = n
    discount = once / (once + 2 * twice) if once and twice else 0.5
    model = ClassModel(tokens, types, discount, matrix, per_class)
    if report is not None:
        report.update(model=model, state=state)
    scored = written(
        asked(state, True).applyInArrow(_score(model, arrow_kind), f"doc_id {kind}, {SCORED}"),
        "classes-scored",
    )
    lists.unpersist()
    blocks.unpersist()
    return scored
