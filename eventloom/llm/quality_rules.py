"""Quality rules whose cut-offs limit the share of good documents they reject.

A rule rejects a document when one of its measures is above a cut-off. Cut-offs are chosen
on labelled documents, per stratum, in two parts. A fifth of the good documents and the bad
ones draft an order of all candidates, those first that cost few good documents for the bad
ones they catch. The other good documents, which had no part in it, are the holdout: the
candidates join in that order, and each step is admitted while the exact binomial test
rejects "the rules admitted so far reject more than ``max_false_rejection`` of good
documents". The first step that fails ends the sequence, so the level need be divided by the
number of strata only (fixed-sequence testing). With probability ``1 - error`` no stratum
loses a larger share of its good documents. A stratum with no more good documents than the
test needs (about 230 in the holdout) has no cut-offs, and the rules reject nothing there.

Everything is built-in functions: measures are computed inside the row, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import split_words, written

# Measure of each rule, over the counts, and its candidate cut-offs from strict to lenient.
RULES: dict[str, tuple[str, tuple[float, ...]]] = {
    "symbols": ("n_symbols / n_words", (0.05, 0.1, 0.2, 0.4, 0.8, 1.5, 2.5)),
    "repeated_lines": ("n_dup_lines / n_lines", (0.05, 0.1, 0.2, 0.3, 0.5, 0.7)),
    "repeated_words": ("n_repeat_words / n_words", (0.01, 0.02, 0.05, 0.1, 0.15)),
    "long_words": ("word_chars / n_words", (7.0, 7.5, 8.0, 9.0, 10.0, 12.0, 15.0)),
    "short_words": ("-word_chars / n_words", (-4.0, -3.5, -3.0, -2.5, -2.0, -1.5)),
}
STRATA = ("en", "de", "fr", "es")
OTHER = "other"
MEASURED = "__counts"  # names with two underscores are ours


def _let(value: Column, use) -> Column:
    """``use(value)``, with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def repeated_words(window_hashes: Column, width: int) -> Column:
    """Words covered by windows whose hash occurs twice or more.

    Sorting (hash, position) brings equal windows together; their positions, sorted, cover
    ``width`` words each, less what the next one covers.
    """
    last = F.size(window_hashes) - 1
    pairs = F.sort_array(
        F.arrays_zip(window_hashes.alias("h"), F.sequence(F.lit(0), last).alias("i"))
    )

    def covered(positions: Column) -> Column:
        return F.aggregate(
            F.transform(
                positions,
                lambda p, k: F.coalesce(
                    F.least(F.lit(width), F.get(positions, k + 1) - p), F.lit(width)
                ),
            ),
            F.lit(0),
            lambda total, x: total + x,
        )

    def positions(sorted_pairs: Column) -> Column:
        alike = F.filter(
            sorted_pairs,
            lambda x, k: (x["h"] == F.get(sorted_pairs, k + 1)["h"])
            | (x["h"] == F.get(sorted_pairs, k - 1)["h"]),
        )
        return F.sort_array(F.transform(alike, lambda x: x["i"]))

    several = F.size(F.array_distinct(window_hashes)) < F.size(window_hashes)
    return F.when(several, _let(_let(pairs, positions), covered)).otherwise(0)


def measure(
    docs: DataFrame, text_column: str = "text", window: int = 5, into: str = MEASURED
) -> DataFrame:
    """``docs`` with a struct of counts; the text is read once and nothing is shuffled.

    NULL and empty texts have no words, lines or symbols.
    """
    work = ("__words", "__hashes", "__windows")
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.withColumn("__words", split_words(F.col(text_column)))
    rows = rows.withColumn("__hashes", F.transform("__words", lambda w: F.xxhash64(w)))
    count = F.greatest(F.size("__words") - (window - 1), F.lit(0))
    shifted = [F.slice("__hashes", F.lit(k + 1), count) for k in range(window)]
    rows = rows.withColumn(
        "__windows", F.transform(F.arrays_zip(*shifted), lambda z: F.xxhash64(z))
    )
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x09-\x0D\x20]"))
    counts = F.struct(
        F.size("__words").cast("long").alias("n_words"),
        F.char_length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        _let(lines, lambda a: F.size(a) - F.size(F.array_distinct(a)))
        .cast("long").alias("n_dup_lines"),
        repeated_words(F.col("__windows"), window).cast("long").alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_lines"),
    )
    return rows.withColumn(into, counts).drop(*work)


def base_failed(counts: str = MEASURED, min_words: int = 10, max_repeat: int = 20) -> Column:
    n, repeated = F.col(f"{counts}.n_words"), F.col(f"{counts}.n_repeat_words")
    return (n < min_words) | (100 * repeated > max_repeat * n)


def _value(rule: str, counts: str) -> Column:
    """Measure of one rule; a text without words or lines has none, so nothing rejects it."""
    over, under = RULES[rule][0].split(" / ")
    sign, over = (-1, over[1:]) if over[0] == "-" else (1, over)
    top, bottom = F.col(f"{counts}.{over}"), F.col(f"{counts}.{under}")
    return sign * top / F.when(bottom > 0, bottom)


def stratum(column: str, strata: Sequence[str] = STRATA) -> Column:
    """One of a fixed list of strata; everything else, NULL too, is one more."""
    return F.when(F.col(column).isin(*strata), F.col(column)).otherwise(OTHER)


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Bin(n, p), exact, for k <= n * p; 1 where k is larger.

    The largest term is X = k; it is built in logarithms, the others relative to it.
    """
    one, k, n = F.lit(1).cast("long"), k.cast("long"), n.cast("long")
    ups = F.when(k >= 1, F.sequence(one, k)).otherwise(F.array().cast("array<bigint>"))
    log_top = F.aggregate(
        ups, F.lit(0.0), lambda acc, i: acc + F.log((n - i + 1).cast("double") / i)
    ) + k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(1 - p))
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def add(acc: Column, i: Column) -> Column:
        # From X = i to X = i - 1.
        term = acc["term"] * i / (n - i + 1) * ((1 - p) / p)
        return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"))

    relative = F.aggregate(F.reverse(ups), start, add, lambda acc: acc["sum"])
    return F.when(k > n * p, 1.0).otherwise(F.exp(log_top) * relative)


def _drafted(rows: DataFrame, risk: float) -> DataFrame:
    """The step of each candidate per stratum: a row per stratum, an array of steps.

    A candidate that catches no bad document, or that costs the draft more than ``risk`` by
    itself, has no step (NULL). Bad documents are counted over all strata.
    """
    counted = rows.groupBy("stratum").agg(
        F.count_if("draft").alias("n"),
        F.array(
            *[
                F.struct(
                    F.count_if(F.col("draft") & over).alias("lost"),
                    F.count_if(~F.col("good") & over).alias("caught"),
                )
                for over in _rejections()
            ]
        ).alias("all"),
    )
    each = counted.select("stratum", "n", F.posexplode("all").alias("j", "c")).select(
        "stratum", "n", "j", "c.lost",
        F.sum("c.caught").over(Window.partitionBy("j")).alias("caught"),
    )
    useful = (F.col("caught") > 0) & (F.col("lost") <= risk * F.col("n"))
    price = (F.col("lost") + 0.5) / F.nullif("caught", F.lit(0))
    order = Window.partitionBy("stratum").orderBy((~useful).cast("int"), price, F.desc("j"))
    step = F.when(useful, F.row_number().over(order))
    return (
        each.withColumn("step", step)
        .groupBy("stratum")
        .agg(F.sort_array(F.collect_list(F.struct("j", "step"))).alias("s"))
        .select("stratum", F.transform("s", lambda x: x["step"]).alias("steps"))
    )


def _rejections() -> list[Column]:
    """Whether each candidate rejects a row that has the rules' values, in RULES' order."""
    return [
        F.coalesce(F.col(rule) > cut, F.lit(False))
        for rule, (_, grid) in RULES.items()
        for cut in grid
    ]


def cutoffs(
    labelled: DataFrame,
    label: str,
    stratum_column: str,
    id_column: str,
    max_false_rejection: float = 0.02,
    error: float = 0.05,
    counts: str = MEASURED,
    strata: Sequence[str] = STRATA,
) -> DataFrame:
    """One row per stratum, one column per rule: the cut-off, or NULL where none is safe.

    ``labelled`` has the counts, the label, the stratum column and an id, which deals good
    rows to draft and holdout. Good rows are those with label 1, bad ones those with label 0.
    Rows equal in id, stratum and counts count once. At most ``len(strata) + 1`` rows, whatever the
    input.
    """
    rows = (
        labelled.where(F.col(label).isin(0, 1))
        .select(
            F.col(id_column).alias("id"),
            stratum(stratum_column, strata).alias("stratum"),
            (F.col(label) == 1).alias("good"),
            *[_value(rule, counts).alias(rule) for rule in RULES],
        )
        .distinct()
        .withColumn("draft", F.col("good") & (F.pmod(F.xxhash64("id"), F.lit(5)) == 0))
    )
    rows = written(rows, "rule-labelled")
    path = written(_drafted(rows, max_false_rejection), "rule-order")
    rejections = _rejections()
    # The step at which a good document goes.
    first = F.array_min(
        F.array(*[F.when(over, F.get("steps", F.lit(j))) for j, over in enumerate(rejections)])
    )
    lost = F.array(*[F.count_if(F.col("first") <= k + 1) for k in range(len(rejections))])
    held = (
        rows.where("good AND NOT draft")
        .join(F.broadcast(path), "stratum")
        .withColumn("first", first)
        .groupBy("stratum")
        .agg(F.count(F.lit(1)).alias("n"), lost.alias("lost"))
    )
    level = error / (len(strata) + 1)
    # Steps lose more and more, so those admitted are the first ones.
    admitted = F.size(
        F.filter("lost", lambda k: binomial_tail(k, F.col("n"), max_false_rejection) <= level)
    )
    chosen, j = [], 0
    for rule, (_, grid) in RULES.items():
        taken = [
            F.when(F.get("steps", F.lit(j + i)) <= F.col("admitted"), F.lit(cut))
            for i, cut in enumerate(grid)
        ]
        chosen.append(F.coalesce(*taken).alias(rule))  # from strict to lenient
        j += len(grid)
    return (
        held.withColumn("admitted", admitted)
        .join(F.broadcast(path), "stratum")
        .select("stratum", *chosen)
    )


def verdicts(
    measured: DataFrame, chosen: DataFrame, stratum_column: str, counts: str = MEASURED,
    strata: Sequence[str] = STRATA,
) -> DataFrame:
    """``measured`` with ``__base_failed`` and ``__kept``.

    The cut-offs are a row per stratum of a fixed list, so broadcasting them is bounded.
    """
    safe = chosen.select(
        F.col("stratum").alias("__stratum"),
        *[F.col(rule).alias(f"__{rule}") for rule in RULES],
    )
    rows = measured.withColumn("__in", stratum(stratum_column, strata)).join(
        F.broadcast(safe), F.col("__in") == F.col("__stratum"), "left"
    )
    rejected = F.lit(False)
    for rule in RULES:
        rejected |= F.coalesce(_value(rule, counts) > F.col(f"__{rule}"), F.lit(False))
    base = base_failed(counts)
    return (
        rows.withColumn("__base_failed", base)
        .withColumn("__kept", ~F.col("__base_failed") & ~rejected)
        .drop("__in", "__stratum", *[f"__{rule}" for rule in RULES])
    )


def judged(
    measured: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    id_column: str = "doc_id",
    stratum_column: str = "lang",
    max_false_rejection: float = 0.02,
) -> DataFrame:
    """Verdicts on measured documents, with cut-offs from those that are labelled.

    Of several labels of a document the smallest counts; rows without one are not used for
    the cut-offs. Without labels only the base rules reject.
    """
    known = labels.groupBy(F.col(id_column).alias("__id")).agg(F.min(label).alias("__label"))
    counted = measured.select(
        F.col(id_column).alias("__doc"), F.col(stratum_column).alias("__lang"), MEASURED
    )
    labelled = counted.join(known, F.col("__doc") == F.col("__id"))
    chosen = written(
        cutoffs(labelled, "__label", "__lang", "__doc", max_false_rejection), "rule-cutoffs"
    )
    return verdicts(measured, chosen, stratum_column)


def quality_report(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id",
    text_column: str = "text", stratum_column: str = "lang", **options,
) -> DataFrame:
    """Counts and verdict of every document, in one row each.

    NULL and empty texts fail the base rules. Repeated rows are judged each for itself; an
    empty table gives no rows. The counts are written once, so texts are measured once.
    """
    rows = docs.select(
        F.col(id_column).alias("doc_id"), F.col(text_column).alias("__text"),
        F.col(stratum_column).alias("lang"),
    )
    measured = written(measure(rows, "__text").drop("__text"), "rule-counts")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged(measured, labels.withColumnRenamed(id_column, "doc_id"), **options).select(
        "doc_id", *[F.col(f"{MEASURED}.{n}").alias(n) for n in names],
        F.col("__base_failed").alias("base_failed"), F.col("__kept").alias("kept"),
    )


def keep_good(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id",
    text_column: str = "text", stratum_column: str = "lang", **options,
) -> DataFrame:
    """The rows of ``docs`` that pass, unchanged.

    Documents and counts are written once together, so a row's verdict is its own even if
    ids repeat, and texts are not shuffled.
    """
    measured = written(measure(docs, text_column), "rule-documents")
    return (
        judged(measured, labels, id_column=id_column, stratum_column=stratum_column, **options)
        .where("__kept")
        .select(*docs.columns)
    )
