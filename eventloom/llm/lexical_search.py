"""Ranked lexical search: term at a time over accumulators, rarest terms first.

The documents stay where they are read. A task turns a few megabytes of them at a time into
lists (document, occurrences) of the terms asked for, and goes through each item's terms from
the rarest to the most frequent. A document gets an accumulator when a term meets it. As soon
as the largest gains of the terms still to come add up to less than the kth best partial score
(or the kth best score of earlier documents of the task), a document without an accumulator
can no longer be among the first k: no more are made, and those there are brought to their
exact scores. A task hands on at most k documents of an item; the first k of all are among
them.

Document counts of terms, the number of documents and of all terms come from a scan before.
The items are the stated query set. They go to the tasks with the code, ``query_bytes`` of
text at a time; a larger set is asked in as many passes over the documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import slices_of_documents, utf8_buffer, word_spans

FOUND = "item int, doc_id long, score long"
# Letters and digits of ASCII, and every byte of a character beyond it.
_TERM = np.zeros(256, bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_SLICE = 8 << 20


def terms_of(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All terms of all documents with A-Z lowered, and the document of each."""
    inside = _TERM[data]
    starts, ends, docs = word_spans(data, offsets, inside)
    lowered = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)[inside]
    edges = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int64)
    terms = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(edges), pa.py_buffer(lowered)]
    )
    return terms, docs


def _slices(column: pa.Array) -> Iterator[tuple[int, int, pa.Array, np.ndarray]]:
    """(first document, one behind the last, terms, document of each from 0)."""
    data, offsets = utf8_buffer(column)
    for a, b in slices_of_documents(offsets, _SLICE):
        yield a, b, *terms_of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])


def _lists(terms: pa.Array, docs: np.ndarray, n: int, vocabulary: pa.Array):
    """(term number, document, occurrences) of the terms asked for, by term, then document."""
    number = pc.index_in(terms, value_set=vocabulary)
    known = pc.is_valid(number).to_numpy(zero_copy_only=False)
    number = number.fill_null(0).to_numpy().astype(np.int64)[known]
    both, tf = np.unique(number * n + docs[known], return_counts=True)
    return both // n, both % n, tf.astype(np.int64)


def _count(vocabulary: pa.Array):
    """Per task: documents with each term, documents with any term (-1), all terms (-2)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, some, total = np.zeros(len(vocabulary), np.int64), 0, 0
        for batch in batches:
            for a, b, terms, docs in _slices(batch.column(0)):
                some += len(np.unique(docs))
                total += len(docs)
                term, _, _ = _lists(terms, docs, b - a, vocabulary)
                df += np.bincount(term, minlength=len(df))
        met = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[-1, -2, met], pa.int32()), pa.array(np.r_[some, total, df[met]])],
            ["term", "n"],
        )

    return count


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def lengths_ratio(n: np.ndarray, n_docs: int, total: int) -> np.ndarray:
    """100 - 50 + (50 * n * N) div L of each document length."""
    if len(n) and 50 * int(n.max()) * n_docs >= 1 << 63:
        return np.array([50 + 50 * x * n_docs // total for x in n.tolist()], np.int64)
    return 50 + 50 * n * n_docs // max(total, 1)


class _Best:
    """The first k of an item so far, by falling score, then id; NULL ids come last."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.doc, self.null = (np.zeros(0, t) for t in (np.int64, np.int64, bool))

    def floor(self) -> int:
        return int(self.score[-1]) if len(self.score) == self.k else 0

    def add(self, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        score, doc, null = (
            np.concatenate(pair)
            for pair in ((self.score, score), (self.doc, doc), (self.null, null))
        )
        order = np.lexsort((doc, null, -score))[: self.k]
        self.score, self.doc, self.null = score[order], doc[order], null[order]


def accumulate(
    terms: np.ndarray, cuts: np.ndarray, docs: np.ndarray, gains: np.ndarray,
    bounds: np.ndarray, score: np.ndarray, k: int, floor: int,
) -> tuple[np.ndarray, int]:
    """Adds the gains of ``terms``, rarest first, to ``score``; documents with an accumulator.

    ``cuts`` says where each term's documents and gains lie, ``bounds`` its largest gain.
    Gains are above 0. Scores of documents that can be among the first k and reach ``floor``
    are exact. The number of times an accumulator was refused comes with them.
    """
    terms = terms[cuts[terms + 1] > cuts[terms]]
    rest = np.concatenate((np.cumsum(bounds[terms][::-1])[::-1], [0]))
    made: list[np.ndarray] = []
    refused, open_ = 0, True
    for i, term in enumerate(terms.tolist()):
        met, gain = docs[cuts[term] : cuts[term + 1]], gains[cuts[term] : cuts[term + 1]]
        if open_ and rest[i] < floor:
            open_ = False
        if open_:
            made.append(met[score[met] == 0])
            score[met] += gain
            # The kth partial score is at most the gains so far.
            if rest[i + 1] <= rest[0] - rest[i + 1]:
                so_far = np.concatenate(made)
                if len(so_far) >= k:
                    partial = score[so_far]
                    floor = max(floor, int(np.partition(partial, len(partial) - k)[-k]))
        else:
            alive = score[met] > 0
            refused += len(met) - int(alive.sum())
            score[met[alive]] += gain[alive]
    return np.unique(np.concatenate([np.zeros(0, np.int64), *made])), refused


def _rank(vocabulary: pa.Array, weights: np.ndarray, items: list[np.ndarray], n_docs: int,
          total: int, k: int):
    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [_Best(k) for _ in items]
        for batch in batches:
            ids = batch.column(0)
            null = pc.is_null(ids).to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy()
            for a, b, terms, owners in _slices(batch.column(1)):
                term, docs, tf = _lists(terms, owners, b - a, vocabulary)
                if not len(term):
                    continue
                lengths = np.bincount(owners, minlength=b - a)
                m = lengths_ratio(lengths, n_docs, total)[docs]
                gains = weights[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m))
                some = gains > 0
                term, docs, gains = term[some], docs[some], gains[some]
                cuts = np.searchsorted(term, np.arange(len(weights) + 1))
                bounds = np.zeros(len(weights), np.int64)
                met = np.flatnonzero(np.diff(cuts))
                bounds[met] = np.maximum.reduceat(gains, cuts[met])
                score = np.zeros(b - a, np.int64)
                for own, first in zip(items, best, strict=True):
                    floor = first.floor()
                    some, _ = accumulate(own, cuts, docs, gains, bounds, score, k, floor)
                    good = some[(score[some] > 0) & (score[some] >= floor)]
                    if len(good):
                        first.add(score[good], ids[a:b][good], null[a:b][good])
                    score[some] = 0
        for item, first in enumerate(best):
            if len(first.score):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(first.score), item), pa.int32()),
                     pa.array(first.doc, pa.int64(), mask=first.null), pa.array(first.score)],
                    ["item", "doc_id", "score"],
                )

    return rank


def _item_terms(texts: list[str | None]) -> tuple[pa.Array, list[np.ndarray]]:
    """Distinct terms of all items, and the numbers of each item's terms."""
    terms, owners = terms_of(*utf8_buffer(pa.array(texts, pa.large_string())))
    coded = terms.dictionary_encode()
    numbers = coded.indices.to_numpy()
    return coded.dictionary, [
        np.unique(numbers[owners == i]).astype(np.int64) for i in range(len(texts))
    ]


def _one_pass(docs: DataFrame, items: DataFrame, k: int) -> DataFrame:
    spark = docs.sparkSession
    rows = items.collect()
    kind = items.schema["item_id"].dataType
    vocabulary, numbers = _item_terms(["\n".join(row["texts"]) for row in rows])
    counts = dict(
        docs.select("text")
        .mapInArrow(_count(vocabulary), "term int, n long")
        .groupBy("term")
        .agg(F.sum("n"))
        .collect()
    )
    n_docs, total = counts.get(-1, 0), counts.get(-2, 0)
    df = np.array([counts.get(t, 0) for t in range(len(vocabulary))], np.int64)
    weights = np.array([weight(n_docs, int(x)) for x in df], np.int64)
    rare_first = [own[np.argsort(df[own], kind="stable")] for own in numbers]
    found = docs.select("doc_id", "text").mapInArrow(
        _rank(vocabulary, weights, rare_first, n_docs, total, k), FOUND
    )
    # The lists of some hundred tasks first, then what is left of them.
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    place = F.row_number()
    some = Window.partitionBy("item", "tasks").orderBy(*order)
    found = found.withColumn("tasks", F.expr("spark_partition_id() div 256"))
    found = found.withColumn("rank", place.over(some)).where(F.col("rank") <= k)
    whole = Window.partitionBy("item").orderBy(*order)
    found = found.withColumn("rank", place.over(whole)).where(F.col("rank") <= k)
    names = spark.createDataFrame(
        [(i, row["item_id"]) for i, row in enumerate(rows)], f"item int, item_id {kind.simpleString()}"
    )
    return found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 50,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    query_bytes: int = 8 << 20,
) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each item, score above 0.

    Ids of documents are integers. NULL and empty texts have no terms: such documents are not
    counted and never found, such items find nothing. Repeated documents are found each for
    itself. Items with one id are one item with the terms of all their rows; a NULL item id
    is an id. Equal scores come by ascending document id, NULL ids last. Without documents or
    items there are no rows; other columns are not looked at.
    """
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    )
    asked = items.select(
        F.col(item_column).alias("item_id"), F.coalesce(F.col(item_text_column), F.lit("")).alias("text")
    )
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = -(-size // query_bytes) or 1
    grouped = asked.groupBy("item_id").agg(F.collect_set("text").alias("texts"))
    turn = F.pmod(F.xxhash64("item_id"), F.lit(passes))
    parts = [_one_pass(rows, grouped.where(turn == p), k) for p in range(passes)]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out
