"""Document fingerprints by order MinHash, and how alike two fingerprints are.

A text's k-mers are runs of ``K`` tokens (words, long ones cut). Each is numbered by how
often it came before, so repeats count apart. Their hashes fall into bins; in every bin the
least few are selected, put back in the order they have in the text and hashed together.
Such a tuple agrees between two texts only if they share the k-mers and their order, so the
share of agreeing bins follows the edit distance, not just the common words.

All of it is built-in functions inside the row. Hash and position are packed in one 64-bit
number (40 and 24 bits), so that sorting runs over plain numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import written

TOKEN = r"[^\x09-\x0D\x20]{1,8}"
_HIGH = ~((1 << 24) - 1)  # the 40 bits of hash
_LOW = (1 << 24) - 1  # the 24 bits of position
_BIN_BITS = 5  # 32 bins
_TAKE = 2  # selected per bin


def _let(value: Column, use) -> Column:
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _high(x: Column) -> Column:
    return x.bitwiseAND(F.lit(_HIGH))


def _place(x: Column) -> Column:
    return x.bitwiseAND(F.lit(_LOW))


def _bin(x: Column) -> Column:
    return F.shiftrightunsigned(x, 64 - _BIN_BITS)


def _numbered(kmer: Column, occurrence: Column, place: Column) -> Column:
    """Hash of an occurrence-numbered k-mer, with its position."""
    return _high(F.xxhash64(kmer, occurrence)).bitwiseOR(place)


def _unrepeated(kmers: Column) -> Column:
    zero = F.lit(0)
    return F.transform(kmers, lambda h, i: _numbered(h, zero, i.cast("long")))


def _repeated(kmers: Column) -> Column:
    """As above where k-mers repeat: sorting brings equal ones together, in text order."""
    packed = F.sort_array(F.transform(kmers, lambda h, i: h.bitwiseOR(i.cast("long"))))

    def runs(s: Column) -> Column:
        begins = F.filter(
            F.sequence(F.lit(0), F.size(s) - 1),
            lambda j: (j == 0) | (_high(F.get(s, j)) != _high(F.get(s, j - 1))),
        )
        return _let(
            begins,
            lambda b: F.flatten(
                F.transform(
                    b,
                    lambda at, r: F.transform(
                        F.slice(s, at + 1, F.coalesce(F.get(b, r + 1), F.size(s)) - at),
                        lambda x, o: _numbered(_high(x), o, _place(x)),
                    ),
                )
            ),
        )

    return _let(packed, runs)


def with_signature(df: DataFrame, text: str, into: str, k: int = 2) -> DataFrame:
    """``df`` with an array of one number per bin that is not empty: bin and tuple hash.

    A text of fewer than ``k`` tokens is one k-mer; one without tokens has no numbers. A
    text without tokens but not empty is its own single k-mer.
    """
    tokens = F.regexp_extract_all(F.col(text), F.lit(TOKEN), F.lit(0))
    count = F.greatest(F.size("__tokens") - (k - 1), F.lit(0))
    shifted = [F.slice("__tokens", F.lit(j + 1), count) for j in range(k)]
    kmers = (
        F.when(
            F.size("__tokens") >= k,
            F.transform(F.arrays_zip(*shifted), lambda z: _high(F.xxhash64(z))),
        )
        .when(F.col(text) != "", F.array(_high(F.xxhash64(text))))
        .otherwise(F.array().cast("array<bigint>"))
    )
    repeats = F.size(F.array_distinct("__kmers")) < F.size("__kmers")
    numbered = F.when(repeats, _repeated(F.col("__kmers"))).otherwise(
        _unrepeated(F.col("__kmers"))
    )
    least = F.filter(
        "__numbered",
        lambda x, j: (j < _TAKE) | (_bin(F.get("__numbered", j - _TAKE)) != _bin(x)),
    )

    def tuple_hash(x: Column, y: Column) -> Column:
        """Hash of the selected k-mers of a bin in text order, below the bin's number."""
        pair = F.when(
            _place(x) < _place(y), F.xxhash64(_high(x), _high(y))
        ).otherwise(F.xxhash64(_high(y), _high(x)))
        value = F.when(_bin(x) == _bin(y), pair).otherwise(F.xxhash64(_high(x)))
        value = F.coalesce(value, F.xxhash64(_high(x)))
        return F.shiftleft(_bin(x), 64 - _BIN_BITS).bitwiseOR(
            F.shiftrightunsigned(value, _BIN_BITS)
        )

    def tuples(picked: Column) -> Column:
        return F.array_compact(
            F.transform(
                picked,
                lambda x, j: F.when(
                    (j == 0) | (_bin(F.get(picked, j - 1)) != _bin(x)),
                    tuple_hash(x, F.get(picked, j + 1)),
                ),
            )
        )

    # Steps are columns of their own, so that each is computed once per row.
    return (
        df.withColumn("__tokens", tokens)
        .withColumn("__kmers", kmers)
        .withColumn("__numbered", F.sort_array(numbered))
        .withColumn("__least", least)
        .withColumn(into, tuples(F.col("__least")))
        .drop("__tokens", "__kmers", "__numbered", "__least")
    )


def likeness(a: str, b: str) -> Column:
    """0 to 1: estimated share of common k-mers in order. Two empty ones are alike.

    The share of bins that agree is that share to the power of the numbers selected.
    """
    bins = lambda c: F.transform(c, _bin)
    agree = F.size(F.array_intersect(a, b))
    either = F.size(F.array_union(bins(F.col(a)), bins(F.col(b))))
    return F.when(either == 0, 1.0).otherwise(F.pow(agree / either, F.lit(1 / _TAKE)))


def fingerprint_text(signature: Column) -> Column:
    return F.array_join(
        F.transform(signature, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), ""
    )


# -- each document against its neighbour ------------------------------------------------


def successors(keys: DataFrame, part_rows: int = 200_000) -> DataFrame:
    """Each (id, hash, n) row with the next one's; the last is followed by the first.

    Rows are dealt out by ranges of their order. Within a range a window finds the next;
    the last of a range is followed by the first of the next range, found in a table with
    a row per range.
    """
    parts = max(1, -(-keys.count() // part_rows))
    ranged = written(
        keys.repartitionByRange(parts, F.col("id").asc_nulls_first(), "hash").withColumn(
            "part", F.spark_partition_id()
        ),
        "ranges",
    )
    order = (F.col("id").asc_nulls_first(), F.col("hash"))
    row = F.struct("id", "hash", "n")
    within = Window.partitionBy("part").orderBy(*order)
    firsts = (
        ranged.withColumn("r", F.row_number().over(within)).where("r = 1")
        .select("part", row.alias("first"))
    )
    by_part = Window.orderBy("part")
    to_next = firsts.select(
        F.col("part"),
        F.coalesce(
            F.lead("first").over(by_part),
            F.first("first").over(by_part.rowsBetween(Window.unboundedPreceding, 0)),
        ).alias("after"),
    )
    found = ranged.withColumn("next", F.lead(row).over(within))
    return found.join(F.broadcast(to_next), "part").select(
        "id", "hash", "n", F.coalesce("next", "after").alias("next")
    )


def compare_with_next(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", k: int = 2
) -> DataFrame:
    """Fingerprints of every text and of its edited form, and how alike they are.

    The edited text has its last quarter of code points replaced by as many from the start
    of the next document in order of id (then of a hash of the text). NULL texts are empty;
    a NULL id comes first. Rows equal in id and text are one document here: they share
    the next one and the result, and each is returned. A table of one document has itself
    as the next; an empty table gives no rows. Other columns are not looked at.
    """
    texts = docs.select(
        F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    ).withColumn("hash", F.xxhash64("text"))
    keys = texts.select("id", "hash", F.char_length("text").alias("n")).distinct()
    chain = written(successors(keys), "successors")
    mine = lambda a, b: F.col(a).eqNullSafe(F.col(b))

    # The start of each text, as long as the one before it needs, goes to that one.
    before = chain.select(
        F.col("next.id").alias("own_id"), F.col("next.hash").alias("own_hash"),
        F.col("id").alias("to_id"), F.col("hash").alias("to_hash"),
        F.floor(F.col("n") / 4).cast("int").alias("need"),
    )
    heads = (
        texts.join(before, mine("id", "own_id") & (F.col("hash") == F.col("own_hash")))
        .select(
            "to_id", "to_hash",
            F.substring(F.col("text"), F.lit(1), F.col("need")).alias("head"),
        )
        .dropDuplicates(["to_id", "to_hash"])
    )
    both = texts.join(heads, mine("id", "to_id") & (F.col("hash") == F.col("to_hash")))
    n = F.char_length("text")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), n - F.floor(n / 4).cast("int")), F.col("head")
    )
    rows = both.withColumn("edited", edited)
    rows = with_signature(with_signature(rows, "text", "own", k), "edited", "changed", k)
    signed = written(
        rows.select(
            "id", "hash", n.cast("long").alias("n_chars"),
            F.sha2(F.col("edited"), 256).alias("edited_sha256"), "own", "changed",
        ),
        "signatures",
    )

    one_each = signed.select(
        F.col("id").alias("next_id"), F.col("hash").alias("next_hash"),
        F.col("own").alias("following"),
    ).dropDuplicates(["next_id", "next_hash"])
    links = chain.select(
        F.col("id").alias("from_id"), F.col("hash").alias("from_hash"),
        F.col("next.id").alias("then_id"), F.col("next.hash").alias("then_hash"),
    )
    following = links.join(
        one_each, mine("then_id", "next_id") & (F.col("then_hash") == F.col("next_hash"))
    ).select("from_id", "from_hash", "following")
    return signed.join(
        following, mine("id", "from_id") & (F.col("hash") == F.col("from_hash"))
    ).select(
        F.col("id").alias("doc_id"), "n_chars", "edited_sha256",
        fingerprint_text(F.col("own")).alias("fingerprint"),
        fingerprint_text(F.col("changed")).alias("edited_fingerprint"),
        likeness("own", "changed").alias("near_edited"),
        likeness("own", "following").alias("near_next"),
    )
