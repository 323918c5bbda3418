"""Exact self-join of word n-gram sets at a Jaccard threshold, by set-relation skipping.

1. Blocks of documents ask in how many documents each n-gram occurs. A set's n-grams are
   ordered rarest first; two sets as similar as asked share one of the first few (the
   prefix). N-grams no other document has cannot be shared, so only the rest are indexed.
2. Equal sets are one set from here on.
3. Index lists are read block by block: entries lie in blocks by position, and a block is
   skipped whole where position and size leave too few common n-grams. Pairs that remain
   must agree in a parity signature, which bounds the number of n-grams they differ in.
4. Of the pairs that pass, one whose sets are already related through other candidates of
   the task is skipped. The pairs read are compared in full, and the links found form classes.
5. A pair that looked similar and is not breaks the relations built on it. If there are
   such pairs, lists of more than one class are read again, and nothing is skipped then but
   pairs within a class. With ``skip_related=False`` that is the only reading.

No link between different classes is lost: every pair with a common prefix n-gram that
could reach the threshold is compared, or its sets are in one class by compared links. A
list too long for one task is dealt out in parts, and pairs of parts are read by tasks of
their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import U64, mix, utf8_buffer, word_hashes, word_spans, written
from eventloom.llm.components import components, with_least
from eventloom.llm.exchange import (
    ANSWERS,
    QUESTIONS,
    answer_rows,
    answers_of,
    as_table,
    blocked,
    questions,
    together,
)
from eventloom.sources.scratch import delete_scratch, release, scratch_paths

SETS = (
    "n_shingles long, key_high long, key_low long, tokens array<long>, places array<int>, "
    "shingles binary, signature binary"
)
# Document frequencies are told apart at these; the rarest n-grams come first.
_CLASSES = (2, 4, 16, 256, 4096, 65536, 1 << 20)
_DENSE = 64  # entries up to which a list is read pair by pair


def _lowered(data: np.ndarray) -> np.ndarray:
    capital = (data >= 65) & (data <= 90)
    return np.where(capital, data + 32, data).astype(np.uint8)


def _sequence_hash(words: np.ndarray) -> U64:
    weights = np.arange(3, 2 * len(words) + 3, 2, U64)
    return mix((words * weights).sum(keepdims=True))[0]


def shingles(rows: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of the distinct word n-grams, by document, then hash.

    A document with fewer words than ``width`` has the sequence of its words as one.
    """
    data, offsets = utf8_buffer(rows.column("text"))
    data = _lowered(data)
    starts, ends, docs = word_spans(data, offsets)
    words = word_hashes(data, starts, ends)
    counts = np.bincount(docs, minlength=len(rows))
    n = len(words) - width + 1
    grams = np.zeros(max(n, 0), U64)
    for k in range(width if n > 0 else 0):
        grams = mix(grams + words[k : k + n] * U64(2 * k + 3))
    inside = docs[width - 1 :] == docs[: len(grams)] if n > 0 else np.zeros(0, bool)
    first = np.cumsum(counts) - counts
    short = [
        (_sequence_hash(words[first[d] : first[d] + counts[d]]), d)
        for d in np.flatnonzero((counts > 0) & (counts < width)).tolist()
    ]
    keys = np.concatenate((grams[inside], np.array([h for h, _ in short], U64)))
    owners = np.concatenate(
        (docs[: len(grams)][inside], np.array([d for _, d in short], np.int64))
    )
    order = np.lexsort((keys, owners))
    keys, owners = keys[order], owners[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1])
    return keys[new], owners[new]


_MASK = ~U64(0xFFFF)  # 48 bits are enough to tell how often an n-gram occurs


def _ask(width: int, buckets: int):
    def ask(rows: pa.Table) -> pa.Table:
        block = rows.column("block")[0].as_py()
        grams, _ = shingles(rows, width)
        keys, counts = np.unique(grams & _MASK, return_counts=True)
        some = np.minimum(counts, 255).astype(np.uint8)
        return as_table(
            questions(block, keys, np.zeros(len(keys), np.uint8), some, buckets), QUESTIONS
        )

    return ask


def _frequencies(rows: pa.Table) -> pa.Table:
    """Answer: the class of each key's document frequency, three bits."""
    counts, keys, by_key, same, some = together(rows, np.uint8, np.uint8)
    runs = np.flatnonzero(~same)
    total = np.add.reduceat(some[by_key].astype(np.int64), runs)
    classes = np.searchsorted(_CLASSES, total, side="right")[np.cumsum(~same) - 1]
    out = np.zeros(len(keys), np.int64)
    out[by_key] = classes
    return answer_rows(rows, counts, *[(out >> b) & 1 == 1 for b in range(3)])


def least_common(total: np.ndarray, percent: int) -> np.ndarray:
    """Fewest common elements of sets with so many elements together, to be similar enough.

    100 * i >= percent * (total - i), in whole numbers.
    """
    return -(-percent * total // (100 + percent))


def signature(grams: np.ndarray) -> bytes:
    """Parity of the number of n-grams in each of one to two cells per n-gram, at most 8192.

    An n-gram in one of two sets only changes one cell, so the sets differ in at least as
    many n-grams as their signatures in cells. A longer signature folds into a shorter one.
    """
    cells = 8 * min(1024, max(8, 1 << (len(grams) // 8).bit_length()))
    counts = np.bincount((grams & U64(cells - 1)).astype(np.int64), minlength=cells)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


class _Signatures:
    """Signatures of a task's sets, compared pair by pair at the shorter length."""

    def __init__(self, blobs: list[bytes]):
        self.size = np.array([len(b) for b in blobs])
        self.blobs, self.folded = blobs, {}

    def _at(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows at one length, and the row of each set; longer ones are folded."""
        if size not in self.folded:
            chosen = np.flatnonzero(self.size >= size)
            table = np.zeros((len(chosen), size // 8), U64)
            for k, i in enumerate(chosen.tolist()):
                parts = np.frombuffer(self.blobs[i], U64).reshape(-1, size // 8)
                table[k] = np.bitwise_xor.reduce(parts, axis=0)
            row = np.zeros(len(self.size), np.int64)
            row[chosen] = np.arange(len(chosen))
            self.folded[size] = table, row
        return self.folded[size]

    def cells_apart(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), np.int64)
        shorter = np.minimum(self.size[x], self.size[y])
        for size in np.unique(shorter).tolist():
            table, row = self._at(size)
            at = np.flatnonzero(shorter == size)
            for part in np.array_split(at, 1 + len(at) * size // (8 << 20)):
                apart = table[row[x[part]]] ^ table[row[y[part]]]
                out[part] = np.bitwise_count(apart).sum(axis=1)
        return out


def _describe(width: int, buckets: int, percent: int):
    """Each document's set: size, key, indexed n-grams with places, and all n-grams."""

    def describe(rows: pa.Table, answers: pa.Table) -> pa.Table:
        grams, owners = shingles(rows, width)
        keys, inverse = np.unique(grams & _MASK, return_inverse=True)
        bits = answers_of(answers, len(keys), buckets, keys, 3)
        classes = (bits[0] + 2 * bits[1].astype(np.int64) + 4 * bits[2])[inverse]
        n = np.bincount(owners, minlength=len(rows))
        first = np.cumsum(n) - n
        key = [np.zeros(len(rows), U64) for _ in range(2)]
        some = np.flatnonzero(n > 0)
        if len(some):
            key[0][some] = np.add.reduceat(mix(grams), first[some])
            key[1][some] = np.add.reduceat(mix(grams ^ U64(0x5851F42D4C957F2D)), first[some])
        order = np.lexsort((grams, classes, owners))
        place = np.arange(len(grams)) - np.repeat(first, n)
        # A similar set has at least percent of these elements in common with it.
        prefix = n - -(-percent * n // 100) + 1
        indexed = (place < np.repeat(prefix, n)) & (classes[order] > 0)
        per_row = np.bincount(owners[order][indexed], minlength=len(rows))
        ends = np.concatenate(([0], np.cumsum(per_row)))
        tokens = grams[order][indexed].view(np.int64)
        lists = lambda values, kind: pa.ListArray.from_arrays(
            pa.array(ends, pa.int32()), pa.array(values, kind)
        )
        own = [grams[first[i] : first[i] + n[i]] if per_row[i] else None for i in range(len(rows))]
        blobs = [None if g is None else g.tobytes() for g in own]
        signatures = [None if g is None else signature(g) for g in own]
        return pa.table(
            [rows.column("doc_id"), pa.array(n), pa.array(key[0].view(np.int64)),
             pa.array(key[1].view(np.int64)), lists(tokens, pa.int64()),
             lists(place[indexed], pa.int32()), pa.array(blobs, pa.binary()),
             pa.array(signatures, pa.binary())],
            ["doc_id", *[c.split()[0] for c in SETS.split(", ")]],
        )

    return describe


# -- index lists -----------------------------------------------------------------------

_PAIRS = "a long, b long"


def _sorted_lists(rows: pa.Table):
    """Entries by n-gram, size and set, and where each list begins and ends."""
    column = lambda name: rows.column(name).to_numpy()
    order = np.lexsort((column("set"), column("n"), column("token")))
    token, sets, n, place = (column(c)[order] for c in ("token", "set", "n", "place"))
    cuts = np.flatnonzero(np.r_[True, token[1:] != token[:-1], True])
    return order, sets, n, place, cuts


def _may_reach(n, m, i, j, percent: int) -> np.ndarray:
    """Whether sets of n and m elements with a common one at places i and j can be similar.

    Common elements are at or before these places, or after both of them.
    """
    most = np.minimum(i, j) + 1 + np.minimum(n - i, m - j) - 1
    return most >= least_common(n + m, percent)


def _size_floor(n: np.ndarray, percent: int) -> np.ndarray:
    return -(-percent * n // 100)


def _blocks_of(n: np.ndarray, place: np.ndarray) -> list[np.ndarray]:
    """Entries of one list in blocks by position."""
    order = np.lexsort((n, place))
    cuts = np.flatnonzero(np.r_[True, np.diff(place[order]) > 0])
    return np.split(order, cuts[1:])


def _skipping(n, place, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of one long list, by blocks of equal position; an entry skips the blocks that
    hold no size with which it can reach.

    Within a pair of blocks sizes are sorted, so each entry meets a range of sizes.
    """
    blocks = _blocks_of(n, place)
    for p, block in enumerate(blocks):
        i = place[block[0]]
        for second in blocks[p:]:
            j = place[second[0]]
            low2, high2 = n[second].min(), n[second].max()
            # Of all sizes m, one where m - j is nearest to n - i has the best bound: a step
            # towards it adds one common element, and at most one to what is needed.
            best = np.clip(n[block] - i + j, low2, high2)
            first = block[_may_reach(n[block], best, i, j, percent)]
            sizes = n[second]
            begin = np.searchsorted(sizes, _size_floor(n[first], percent))
            end = np.searchsorted(sizes, n[first] * 100 // percent, side="right")
            for s in range(0, len(first), 256):
                count = np.maximum(end[s : s + 256] - begin[s : s + 256], 0)
                x = np.repeat(first[s : s + 256], count)
                within = np.arange(len(x)) - np.repeat(np.cumsum(count) - count, count)
                yield x, second[np.repeat(begin[s : s + 256], count) + within]


class _Relations:
    """Which labels are related so far: a forest over those seen in this task."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, label: int) -> int:
        parent = self.parent
        while (up := parent.get(label, label)) != label:
            parent[label] = parent.get(up, up)
            label = up
        return label

    def roots(self, labels: np.ndarray) -> np.ndarray:
        distinct, inverse = np.unique(labels, return_inverse=True)
        return np.array([self.root(x) for x in distinct.tolist()], np.int64)[inverse]

    def relate(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)
        return a != b


def _candidates(percent: int, skip: bool):
    """Pairs of different classes that may be similar; with ``skip`` only those not related
    through pairs already read."""

    def pairs(rows: pa.Table) -> pa.Table:
        order, sets, n, place, cuts = _sorted_lists(rows)
        label, part, left, right = (
            rows.column(c).to_numpy()[order] for c in ("label", "part", "left", "right")
        )
        distinct, at, number = np.unique(sets, return_index=True, return_inverse=True)
        blobs = rows.column("signature").take(pa.array(order[at])).to_pylist()
        signatures, relations = _Signatures(blobs), _Relations()
        found: list[np.ndarray] = []

        def read(x: np.ndarray, y: np.ndarray) -> None:
            # Entries of two parts only meet entries of the other part.
            ok = (label[x] != label[y]) & ((left[x] == right[x]) | (part[x] != part[y]))
            ok &= _may_reach(n[x], n[y], place[x], place[y], percent)
            x, y = x[ok], y[ok]
            total = n[x] + n[y]
            most = total - 2 * least_common(total, percent)
            ok = signatures.cells_apart(number[x], number[y]) <= most
            x, y = x[ok], y[ok]
            if not skip:
                both = np.stack((sets[x], sets[y]), axis=1)
                found.append(np.unique(np.sort(both, axis=1), axis=0))
                return
            while len(x):
                # One pair for each class met, then what these did not relate.
                a, b = relations.roots(label[x]), relations.roots(label[y])
                open_ = a != b
                x, y, b = x[open_], y[open_], b[open_]
                _, first = np.unique(b, return_index=True)
                for i in first.tolist():
                    if relations.relate(int(label[x[i]]), int(label[y[i]])):
                        found.append(np.sort(sets[[x[i], y[i]]])[None])

        size = np.diff(cuts)
        begin = np.repeat(cuts[:-1], size)
        here = np.arange(len(sets))
        apart = np.repeat(np.arange(len(size)), size) * (int(n.max()) + 1)
        low = np.maximum(np.searchsorted(apart + n, apart + _size_floor(n, percent)), begin)
        short = np.repeat(size <= _DENSE, size)
        for s in range(0, len(sets), 8192):
            some = here[s : s + 8192][short[s : s + 8192]]
            count = some - low[some]
            x = np.repeat(some, count)
            within = np.arange(len(x)) - np.repeat(np.cumsum(count) - count, count)
            read(x, np.repeat(low[some], count) + within)
        for k in np.flatnonzero(size > _DENSE).tolist():
            own = slice(cuts[k], cuts[k + 1])
            for x, y in _skipping(n[own], place[own], percent):
                read(x + cuts[k], y + cuts[k])
        both = np.unique(np.concatenate([np.zeros((0, 2), np.int64), *found]), axis=0)
        return pa.table([both[:, 0], both[:, 1]], ["a", "b"])

    return pairs


def _similar(percent: int):
    """Whether each pair is similar, by counting the common elements of both sets."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(
                batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True
            ):
                x, y = np.frombuffer(x, U64), np.frombuffer(y, U64)
                both = np.sort(np.concatenate((x, y)), kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                ok.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(ok, pa.bool_())], ["a", "b", "ok"]
            )

    return compare


def _compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs with ``ok``: a join brings each pair its two sets."""
    full = sets.where(F.col("shingles").isNotNull()).select("set", "shingles")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("set")).distinct()
    if ends.count() <= _FEW:
        # So few sets are wanted that the others need not be shuffled.
        full = full.join(F.broadcast(ends), "set", "left_semi")
    x = full.select(F.col("set").alias("a"), F.col("shingles").alias("x"))
    y = full.select(F.col("set").alias("b"), F.col("shingles").alias("y"))
    rows = pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y")
    return rows.mapInArrow(_similar(percent), f"{_PAIRS}, ok boolean")


_FEW = 500_000  # numbers of sets that go into a broadcast: four megabytes


# -- the join --------------------------------------------------------------------------


def set_classes(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    width: int = 3,
    percent: int = 90,
    list_part: int = 20_000,
    skip_related: bool = True,
    block_bytes: int = 4 << 20,
    bucket_bytes: int = 16 << 20,
) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs``.

    Sets are linked when 100 * common >= percent * union; a component's id is the smallest
    id in it. NULL and empty texts and texts without words have empty sets, linked with
    nothing, and are their own component. Every row is a document: rows with one id and
    different texts are linked as their texts are, and may be in different components. A
    NULL id is never the smallest; a component of NULL ids alone has a NULL id. An empty
    table gives no rows; other columns are not looked at.
    """
    spark = docs.sparkSession
    before = scratch_paths(spark)
    rows, buckets = blocked(docs, id_column, text_column, block_bytes, bucket_bytes)
    kind = rows.schema["doc_id"].dataType.simpleString()
    by_block = rows.groupBy("block")
    answers = (
        by_block.applyInArrow(_ask(width, buckets), QUESTIONS)
        .groupBy("bucket")
        .applyInArrow(_frequencies, ANSWERS)
    )
    described = by_block.cogroup(answers.groupBy("block")).applyInArrow(
        _describe(width, buckets, percent), f"doc_id {kind}, {SETS}"
    )
    # Rows are numbered as they are written, so the numbers stay.
    sets = written(described.withColumn("set", F.monotonically_increasing_id()), "jaccard-sets")
    release(spark)

    # Equal sets are one: the least row number stands for all of them.
    key = ["n_shingles", "key_high", "key_low"]
    equal = written(
        sets.where("n_shingles > 0")
        .groupBy(*key)
        .agg(F.min("set").alias("set"), F.min("doc_id").alias("least_id")),
        "jaccard-equal",
    )
    reps = sets.where(F.size("tokens") > 0).join(equal.select("set"), "set", "left_semi")
    entries = reps.select(
        "set", F.col("n_shingles").alias("n"),
        F.explode(F.arrays_zip("tokens", "places")).alias("e"),
    ).select(
        "set", "n", F.col("e.tokens").alias("token"),
        F.col("e.places").cast("long").alias("place"),
    )
    sizes = entries.groupBy("token").agg(F.count(F.lit(1)).alias("many")).where("many > 1")
    parts = F.ceil(F.col("many") / list_part).cast("int")
    part = F.when(F.col("parts") > 1, F.pmod(F.xxhash64("set"), "parts")).otherwise(0)
    listed = written(
        entries.join(sizes, "token")
        .withColumn("parts", parts)
        .select("token", "set", "n", "place", "parts", part.cast("int").alias("part")),
        "jaccard-lists",
    )
    signed = sets.where(F.col("signature").isNotNull()).select("set", "signature")

    links = failed = classes = None
    for skip in (True, False) if skip_related else (False,):
        entries = listed
        if classes is None:
            entries = entries.withColumn("label", F.col("set"))
        else:
            labels = classes.select(F.col("node").alias("set"), "label")
            entries = entries.join(labels, "set", "left").withColumn(
                "label", F.coalesce("label", "set")
            )
            several = entries.groupBy("token").agg(
                F.min("label").alias("low"), F.max("label").alias("high")
            )
            entries = entries.join(
                several.where("low < high").select("token"), "token", "left_semi"
            )
        # A long list's parts meet two by two.
        other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
        dealt = entries.join(signed, "set").withColumn("with", other).select(
            "token", "set", "n", "place", "label", "part", "signature",
            F.least("part", "with").alias("left"), F.greatest("part", "with").alias("right"),
        )
        deal = F.pmod(F.xxhash64("token", "left", "right"), F.lit(buckets * 4))
        pairs = (
            dealt.groupBy(deal.alias("deal"))
            .applyInArrow(_candidates(percent, skip=skip), _PAIRS)
            .distinct()
        )
        if failed is not None:
            pairs = pairs.join(failed, ["a", "b"], "left_anti")
        pairs = written(pairs, "jaccard-pairs")
        compared = written(_compared(pairs, sets, percent).distinct(), "jaccard-compared")
        good = compared.where("ok").select("a", "b")
        bad = compared.where("not ok").select("a", "b")
        links = good if links is None else links.union(good)
        failed = bad if failed is None else failed.union(bad)
        classes = components(links)
        if bad.isEmpty():
            break

    # A class's id is the least of its documents' ids; a set without links is its own class.
    linked = equal.join(classes.select(F.col("node").alias("set"), "label"), "set")
    linked = with_least(linked, "label", "least_id", "set", "class").select(
        "set", "class", F.lit(True).alias("linked")
    )
    label = F.when(F.col("linked"), F.col("class")).otherwise(F.col("least_id"))
    named = equal.join(linked, "set", "left").select(*key, label.alias("class"))
    empty = F.when(F.col("n_shingles") == 0, F.col("doc_id"))
    final = sets.select("doc_id", *key).join(named, key, "left").select(
        "doc_id", "n_shingles", F.coalesce(empty, "class").alias("component_id")
    )
    final = written(final, "jaccard-classes")
    done = scratch_paths(spark)
    release(spark, [p for p in done if p not in before], keep=final)
    return final


def one_per_class(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options
) -> DataFrame:
    """``docs`` without the documents that are linked with one of a smaller id.

    Rows with a NULL id stay unless they are linked with a row that has one. Of rows with
    one id each stays if the text of any of them does.
    """
    classes = set_classes(docs, id_column, text_column, **options)
    stay = classes.where(F.col("component_id").eqNullSafe(F.col("doc_id"))).select(
        F.col("doc_id").alias("__stays")
    )
    stay = written(stay.distinct(), "jaccard-stay")
    delete_scratch(classes)
    return docs.join(stay, F.col(id_column).eqNullSafe(F.col("__stays")), "left_semi")
