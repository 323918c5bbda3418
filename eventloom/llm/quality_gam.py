"""Quality scores from a generalised additive model with pairwise interactions.

Each feature has a lookup table over its bins, and so has each chosen pair of features.
Training goes round the features again and again; each turn fits one shallow tree of a
single feature to the gradient and adds a small part of it to that feature's table. The
pairs that explain most of what is left get tables of their own in the same way. A score is
the sum of one table entry per feature and pair, through the logistic function: vectorised
additions over bin numbers, in Arrow batches.

Training rows are a bounded sample of the labelled documents (``max_rows``, those with the
smallest hashed id); everything else runs over all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import (
    _IS_SPACE,
    U64,
    mix,
    slices_of_documents,
    utf8_buffer,
    word_hashes,
    word_spans,
)

FEATURES = (
    "words", "bytes_per_word", "distinct_words", "repeated_triples", "symbols", "marks",
    "pipes", "capitals", "digits", "non_ascii", "lines_per_word", "repeated_lines",
    "sentence_ends", "repeated_chars",
)


def _classes() -> np.ndarray:
    """Bit set of each byte: what it counts as."""
    bits = np.zeros(256, np.uint8)
    groups = (b"#*$%&<>{}[]~^=_\\", b"!?", b"|", bytes(range(65, 91)), b"0123456789", b".")
    for bit, members in enumerate(groups):
        bits[list(members)] |= 1 << bit
    bits[128:192] |= 1 << 6  # continuation bytes: one for each accented letter at least
    bits[10] |= 1 << 7
    return bits


_CLASSES = _classes()


def _per_document(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of a 0/1 array over each document."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeats(keys: np.ndarray, docs: np.ndarray, n: int) -> np.ndarray:
    """Items of each document that equal another of the same document, less one per value."""
    order = np.lexsort((keys, docs))
    k, d = keys[order], docs[order]
    same = (k[1:] == k[:-1]) & (d[1:] == d[:-1])
    return np.bincount(d[1:][same], minlength=n)


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row per document, a column per name in FEATURES; a few megabytes at a time."""
    parts = [
        _features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        for a, b in slices_of_documents(offsets)
    ]
    return np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))


def _features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n = len(offsets) - 1
    starts, ends, docs = word_spans(data, offsets)
    hashes = word_hashes(data, starts, ends)
    words = np.bincount(docs, minlength=n)
    per_word = 1 / np.maximum(words, 1)
    size = np.diff(offsets)
    per_byte = 1 / np.maximum(size, 1)
    counts = [_per_document((_CLASSES[data] >> b) & 1, offsets) for b in range(8)]
    symbols, marks, pipes, capitals, digits, dots, wide, breaks = counts
    triples = mix(hashes[:-2] + U64(3) * mix(hashes[1:-1] + U64(5) * hashes[2:]))
    inside = docs[2:] == docs[:-2]
    line_starts, line_ends, line_docs = _lines(data, offsets)
    lines = np.bincount(line_docs, minlength=n)
    repeated_lines = _repeats(word_hashes(data, line_starts, line_ends), line_docs, n)
    same = np.zeros(len(data), bool)
    same[1:] = (data[1:] == data[:-1]) & ~_IS_SPACE[data[1:]]
    return np.stack(
        [
            np.log1p(words),
            np.bincount(docs, weights=ends - starts, minlength=n) * per_word,
            1 - _repeats(hashes, docs, n) * per_word,
            _repeats(triples[inside], docs[2:][inside], n) * per_word,
            symbols * per_word,
            marks * per_word,
            pipes * per_word,
            capitals * per_byte,
            digits * per_byte,
            wide * per_byte,
            (breaks + 1) * per_word,
            repeated_lines / np.maximum(lines, 1),
            dots * per_word,
            _per_document(same, offsets) * per_byte,
        ],
        axis=1,
    )


def _lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(starts, ends, document) of the lines that are not empty."""
    cuts = np.flatnonzero(data == 10)
    starts = np.unique(np.concatenate((offsets[:-1], cuts + 1)))
    ends = np.append(starts[1:], len(data))[: len(starts)]
    ends = ends - ((ends > starts) & (data[np.maximum(ends - 1, 0)] == 10) if len(data) else 0)
    keep = (ends > starts) & (starts < len(data))
    starts, ends = starts[keep], ends[keep]
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


# -- the model -------------------------------------------------------------------------


@dataclass
class AdditiveModel:
    """Intercept, bin edges of the features, their tables, and tables of feature pairs."""

    intercept: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for j, (edges, tab) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += tab[np.searchsorted(edges, x[:, j], side="right")]
        for (a, b), tab in zip(self.pairs, self.pair_tables, strict=True):
            i = np.searchsorted(self.pair_edges[a], x[:, a], side="right")
            total += tab[i, np.searchsorted(self.pair_edges[b], x[:, b], side="right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _cut(x: np.ndarray, bins: int) -> np.ndarray:
    """Inner bin edges at quantiles of one feature."""
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def _tree(gradient: np.ndarray, weight: np.ndarray, depth: int, ridge: float) -> np.ndarray:
    """Values over the bins of a tree of ``depth`` levels, from sums per bin."""
    total = gradient.sum() / (weight.sum() + ridge)
    if depth == 0 or len(gradient) < 2:
        return np.full(len(gradient), total)
    g, w = np.cumsum(gradient)[:-1], np.cumsum(weight)[:-1]
    g_all, w_all = gradient.sum(), weight.sum()
    gain = g * g / (w + ridge) + (g_all - g) ** 2 / (w_all - w + ridge)
    at = int(np.argmax(gain)) + 1
    return np.concatenate(
        (
            _tree(gradient[:at], weight[:at], depth - 1, ridge),
            _tree(gradient[at:], weight[at:], depth - 1, ridge),
        )
    )


def fit(
    x: np.ndarray,
    y: np.ndarray,
    rounds: int = 150,
    bins: int = 32,
    depth: int = 2,
    rate: float = 0.1,
    pairs: int = 8,
    pair_bins: int = 8,
    pair_rounds: int = 40,
    ridge: float = 2.0,
) -> AdditiveModel:
    """Cyclic boosting on log loss. Without rows of both classes the score is constant."""
    positive = (y.sum() + 1) / (len(y) + 2)
    intercept = float(np.log(positive / (1 - positive)))
    d = x.shape[1]
    if len(np.unique(y)) < 2:
        return AdditiveModel(intercept, [np.zeros(0)] * d, [np.zeros(1)] * d)
    edges = [_cut(x[:, j], bins) for j in range(d)]
    cells = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    margin = np.full(len(y), intercept)

    def slope() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-margin))
        return y - p, np.maximum(p * (1 - p), 1e-6)

    for _ in range(rounds):
        for j in range(d):
            g, w = slope()
            n = len(tables[j])
            step = rate * _tree(
                np.bincount(cells[j], g, n), np.bincount(cells[j], w, n), depth, ridge
            )
            tables[j] += step
            margin += step[cells[j]]

    pair_edges = [_cut(x[:, j], pair_bins) for j in range(d)]
    small = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(pair_edges)]
    sizes = [len(e) + 1 for e in pair_edges]
    g, w = slope()
    gains = {}
    for a in range(d):
        for b in range(a + 1, d):
            cell, n = small[a] * sizes[b] + small[b], sizes[a] * sizes[b]
            gains[a, b] = (
                np.bincount(cell, g, n) ** 2 / (np.bincount(cell, w, n) + 10 * ridge)
            ).sum()
    chosen = sorted(gains, key=gains.get, reverse=True)[:pairs]
    pair_tables = [np.zeros((sizes[a], sizes[b])) for a, b in chosen]
    for _ in range(pair_rounds):
        for k, (a, b) in enumerate(chosen):
            g, w = slope()
            cell, n = small[a] * sizes[b] + small[b], sizes[a] * sizes[b]
            step = rate * np.bincount(cell, g, n) / (np.bincount(cell, w, n) + 10 * ridge)
            pair_tables[k] += step.reshape(sizes[a], sizes[b])
            margin += step[cell]
    # Tables are centred, so that the intercept alone is the average score.
    for tab, cell in zip(tables, cells, strict=True):
        mean = tab[cell].mean()
        tab -= mean
        intercept += mean
    return AdditiveModel(intercept, edges, tables, pair_edges, chosen, pair_tables)


# -- over documents --------------------------------------------------------------------


def fold(doc_id: Column, folds: int = 5) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))


def _features_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = features(*utf8_buffer(batch.column("text")))
        rows = pa.array(list(values), pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([rows, batch.column("y")], ["x", "y"])


def training_rows(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    max_rows: int = 20_000,
) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most ``max_rows`` labelled documents outside fold 0.

    Labels are 0 or 1; others and NULL ones are left out, and of several labels of a
    document the smallest counts. The sample is what bounds the broadcast and the driver.
    """
    usable = (
        labels.where(F.col(label).isin(0, 1) & (fold(F.col(id_column)) != 0))
        .groupBy(F.col(id_column).alias("doc_id"))
        .agg(F.min(label).cast("double").alias("y"))
    )
    sample = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    text = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    rows = (
        text.join(F.broadcast(sample), "doc_id")
        .select("text", "y")
        .mapInArrow(_features_of, "x array<double>, y double")
        .toPandas()
    )
    if not len(rows):
        return np.zeros((0, len(FEATURES))), np.zeros(0)
    x, y = np.stack(rows["x"].to_numpy()), rows["y"].to_numpy()
    # Rows come in any order; a model must not depend on it.
    order = np.lexsort((y, *x.T))
    return x[order], y[order]


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    id_column: str = "doc_id",
    text_column: str = "text",
    threshold: float = 0.3,
    max_rows: int = 20_000,
) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``.

    NULL texts count as empty and are scored like any other. Repeated rows are scored each.
    Without usable labels all scores are 0.5; an empty table gives no rows.
    """
    x, y = training_rows(docs, labels, label, id_column, text_column, max_rows)
    model = fit(x, y)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = model.score(features(*utf8_buffer(batch.column("text"))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(values),
                 pa.array((values >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        (fold(F.col(id_column)) == 0).alias("held_out"),
        F.col(text_column).alias("text"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        score, f"doc_id {kind}, held_out boolean, score double, predicted int"
    )
