"""Personal data: exact base spans, and candidates chosen by gradient-boosted trees.

Base spans follow fixed formats (see BASE) with fixed checks. Looser generators propose
more spans, overlapping ones too. Boosted trees score a proposal from its format and its
surroundings. They learn which proposals agree with independent evidence (see
``agreement``): a loosely written address that is whole once spelt out, a check digit
together with the grouping of a card, a number introduced as a telephone. Per kind, the
lowest score whose proposals above it agree often enough on held-out documents becomes the
threshold. Of proposals that overlap, base spans stay, then better scores go first; what
overlaps nothing that was taken before is taken too.

Only built-in functions and the trees of Spark's own library run here. A text is read once:
its base spans and proposals are a small table, from which all the rest is computed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import written

KINDS = ("email", "ip", "card", "phone")

# Formats of the base spans. A match may begin where a run of its first characters begins,
# or right after the match before; that is where a leftmost match begins, and it keeps
# long runs linear. Possessive repeats give back nothing a later part could use.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Looser formats of the proposals: more ways to write an at sign or to part digits.
LOOSE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++(?:@|\x20?[(\[]at[)\]]\x20?)"
    r"[A-Za-z0-9-]++(?:(?:\.|\x20?[(\[]dot[)\]]\x20?)[A-Za-z0-9-]++)*+",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:[.,:][0-9]++){2,}+",
    "card": r"[0-9](?:[\x20./-]?[0-9]){8,}+",
    "phone": r"[+(]?[0-9](?:[\x20().-]{0,3}[0-9]){6,16}+",
}
# A text that lacks these has no match of the kind.
NEEDS = {"email": r"@|[(\[]at[)\]]", "ip": "[0-9]", "card": "[0-9]", "phone": "[0-9]"}

CUES = r"(?i)(?:tel|phone|call|mail|contact|card|visa|pay|addr|host|ip)[^\n]{0,12}$"
PHONE_CUES = r"(?i)\b(?:tel|telephone|phone|call|mobile|cell|fax|sms|whatsapp)\b[^\n0-9]{0,12}$"
IP_CUES = r"(?i)\b(?:ip|host|addr|address|server)\b[^\n0-9]{0,12}$"
_CHUNK = 64


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    return F.get(F.transform(F.array(value), use), F.lit(0))


def located(text: Column, pattern: str) -> Column:
    """Array of (start, len, match) of all matches, left to right, in code points.

    Matches and the gaps between them alternate, so a match starts where the lengths
    before it end. Sums run over chunks, which keeps texts with very many matches short of
    a quadratic number of additions.
    """
    parts = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"),
        F.split(text, pattern, -1).alias("g"),
    )

    def sizes(p: Column) -> Column:
        n = F.size(p["m"])
        return F.transform(
            F.arrays_zip(p["m"].alias("m"), F.slice(p["g"], F.lit(1), n).alias("g")),
            lambda z: F.struct(
                F.char_length(z["g"]).alias("gap"),
                F.char_length(z["m"]).alias("len"),
                z["m"].alias("match"),
            ),
        )

    def total(a: Column) -> Column:
        return F.aggregate(a, F.lit(0), lambda acc, x: acc + x["gap"] + x["len"])

    def chunk(a: Column, c: Column) -> Column:
        before = total(F.slice(a, F.lit(1), c * _CHUNK))
        return _let(
            F.struct(before.alias("at"), F.slice(a, c * _CHUNK + 1, F.lit(_CHUNK)).alias("a")),
            lambda s: F.transform(
                s["a"],
                lambda x, j: F.struct(
                    (s["at"] + total(F.slice(s["a"], F.lit(1), j)) + x["gap"]).alias("start"),
                    x["len"].alias("len"),
                    x["match"].alias("match"),
                ),
            ),
        )

    def starts(a: Column) -> Column:
        chunks = F.sequence(F.lit(0), F.floor((F.size(a) - 1) / _CHUNK).cast("int"))
        return F.when(
            F.size(a) > 0, F.flatten(F.transform(chunks, lambda c: chunk(a, c)))
        ).otherwise(_no_matches())

    return _let(_let(parts, sizes), starts)


def _no_matches() -> Column:
    return F.array().cast("array<struct<start:int,len:int,match:string>>")


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit holds; every second digit from the right counts double."""

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 1, twice).otherwise(digit)

    places = F.sequence(F.lit(0), F.length(digits) - 1)
    return F.aggregate(places, F.lit(0), add) % 10 == 0


def _small(part: Column) -> Column:
    """Whether a run of digits, of any length, is at most 255."""
    bare = F.regexp_replace(part, "^0+(?=[0-9])", "")
    return F.when(F.length(bare) <= 3, bare.try_cast("int") <= 255).otherwise(False)


def passes(kind: str, match: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(match, r"\."), _small)
    if kind == "card":
        n = F.length(_digits(match))
        return F.when(n.between(12, 19), luhn(_digits(match))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    return F.lit(True)


def _matches(text: Column, kind: str, pattern: str) -> Column:
    """Matches of one kind, with the kind's number; texts that cannot have any are skipped."""
    found = F.when(text.rlike(NEEDS[kind]), located(text, pattern)).otherwise(_no_matches())
    number = KINDS.index(kind)
    return F.transform(
        found,
        lambda x: F.struct(
            x["start"].alias("start"), F.lit(number).alias("kind"),
            (x["start"] + x["len"]).alias("end"), x["match"].alias("match"),
        ),
    )


def base_spans(text: Column) -> Column:
    """Sorted array of (start, kind, end) of all matches that pass their check."""

    def of(kind: str) -> Column:
        valid = F.filter(_matches(text, kind, BASE[kind]), lambda x: passes(kind, x["match"]))
        return F.transform(valid, lambda x: x.dropFields("match"))

    return F.sort_array(F.concat(*[of(kind) for kind in KINDS]))


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def _spelt_out(match: Column) -> Column:
    """An address with its bracketed signs written as such."""
    at = F.regexp_replace(match, r"\x20?[(\[]at[)\]]\x20?", "@")
    return F.regexp_replace(at, r"\x20?[(\[]dot[)\]]\x20?", ".")


def _before(text: Column, span: Column) -> Column:
    """At most 24 code points in front of a span."""
    return F.substring(
        text, F.greatest(span["start"] - 23, F.lit(1)), F.least(span["start"], F.lit(24))
    )


def _checked(match: Column) -> Column:
    """Whether a match has as many digits as a card, and the right check digit."""
    digits = _digits(match)
    return F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(False)


def agreement(span: Column, before: Column) -> Column:
    """Whether what is known besides the format speaks for a proposal.

    Addresses are whole once spelt out. Four numbers up to 255 are parted by dots, or
    introduced as a host. Cards have a right check digit and the groups of a card. Telephones
    have 9 to 15 digits and a plus, a bracketed area code or a word that introduces them.
    """
    match, number = span["match"], span["kind"]
    n = F.length(_digits(match))
    four = match.rlike("^[0-9]+([.,:][0-9]+){3}$")
    small = F.when(four, F.forall(F.split(match, "[.,:]"), _small)).otherwise(False)
    grouped = match.rlike(
        r"^[0-9]+$|^[0-9]{4}([ ./-])[0-9]{4}\1[0-9]{4}(\1[0-9]{1,7})?$"
        r"|^[0-9]{4}([ ./-])[0-9]{6}\3[0-9]{4,5}$"
    )
    says = {
        "email": _spelt_out(match).rlike(r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+$"),
        "ip": small & (~match.rlike("[,:]") | before.rlike(IP_CUES)),
        "card": grouped & _checked(match),
        "phone": n.between(9, 15)
        & (match.rlike(r"^\+|^\([0-9]{2,4}\)") | before.rlike(PHONE_CUES)),
    }
    return F.coalesce(
        *[F.when(number == KINDS.index(kind), says[kind]) for kind in KINDS], F.lit(False)
    )


def _features(text: Column, span: Column, before: Column) -> Column:
    """Numbers about how a proposal is written and what stands next to it."""
    match = span["match"]
    after = F.substring(text, span["end"] + 1, F.lit(2))
    count = lambda pattern: F.regexp_count(match, F.lit(pattern))
    groups = F.split(match, "[^0-9]+")
    lengths = F.transform(groups, lambda g: F.length(g))
    values = [
        *[(span["kind"] == i) for i in range(len(KINDS))],
        F.char_length(match), count("[0-9]"), count("[A-Za-z]"), count("@"), count(r"\."),
        count("-"), count(r"\x20"), count("[()]"), count("[,:/]"), match.startswith("+"),
        count("[0-9]+"), F.array_max(lengths), F.array_min(lengths),
        F.size(F.array_distinct(F.regexp_extract_all(match, F.lit("[^0-9]+"), F.lit(0)))),
        F.regexp_count(F.substring_index(_spelt_out(match), "@", -1), F.lit(r"\.[A-Za-z0-9]")),
        before.rlike(r"[A-Za-z0-9]$"), before.rlike(CUES), before.rlike(PHONE_CUES),
        before.rlike(IP_CUES), before.rlike(r"[=:\"']\x20?$"),
        after.rlike(r"^[A-Za-z0-9]"), after.rlike(r"^[%$\"')]"),
        match.startswith("("), _checked(match),
        F.forall(groups, lambda g: (F.length(g) <= 3) & _small(g)),
    ]
    return F.array(*[F.coalesce(v.cast("double"), F.lit(0.0)) for v in values])


def proposals(text: Column, spans: Column) -> Column:
    """Array of (start, kind, end, x, y, is_base): features, agreement, base span or not."""
    return F.transform(
        F.concat(*[_matches(text, k, LOOSE[k]) for k in KINDS]),
        lambda s: _let(
            _before(text, s),
            lambda before: F.struct(
                s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"),
                _features(text, s, before).alias("x"),
                agreement(s, before).cast("double").alias("y"),
                F.array_contains(spans, s.dropFields("match")).alias("is_base"),
            ),
        ),
    )


def with_spans(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``docs`` with key columns, base spans and proposals, from one look at each text."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    return (
        docs.withColumn("__text", text)
        .withColumn("__id", F.col(id_column).cast("string"))
        .withColumn("__hash", F.xxhash64("__text"))
        .withColumn("__base", base_spans(F.col("__text")))
        .withColumn("__proposed", proposals(F.col("__text"), F.col("__base")))
        .drop("__text")
    )


def fit_trees(candidates: DataFrame, max_rows: int, rounds: int, depth: int):
    """Boosted trees on a bounded sample of proposals; None unless both classes are there.

    Every kind has equal room for proposals that agree and that do not: what is rarer than
    its room counts whole. At most ``max_rows`` rows are learned from.
    """
    training = candidates.where("fold <> 0").withColumn(
        "draw", F.pmod(F.xxhash64("__id", "__hash", "start", "kind"), F.lit(1 << 20))
    )
    room = training.groupBy("kind", "y").agg(
        (F.lit(max_rows / (2 * len(KINDS))) / F.count(F.lit(1)) * (1 << 20)).alias("below")
    )
    sample = (
        training.join(F.broadcast(room), ["kind", "y"])
        .where("draw < below")
        .orderBy("draw", "__id", "__hash", "start", "kind")
        .limit(max_rows)
        .select(array_to_vector("x").alias("features"), F.col("y").alias("label"))
    )
    sample = written(sample.coalesce(1), "pii-sample")
    if sample.select("label").distinct().count() < 2:
        return None
    trees = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=42, maxBins=32)
    return trees.fit(sample)


def thresholds(scored: DataFrame, precision: float, least: int) -> DataFrame:
    """Lowest safe score per kind, over all held-out proposals; a row per kind at most.

    Scores are counted in a hundred steps; a step is safe when, of all proposals at or
    above it, at least ``precision`` agree and there are ``least`` of them.
    """
    steps = (
        scored.where("fold = 0")
        .groupBy("kind", F.floor(F.col("score") * 100).alias("step"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("good"))
    )
    above = Window.partitionBy("kind").orderBy(F.desc("step"))
    return (
        steps.select(
            "kind", "step", F.sum("n").over(above).alias("n"),
            F.sum("good").over(above).alias("good"),
        )
        .where((F.col("good") >= precision * F.col("n")) & (F.col("n") >= least))
        .groupBy("kind")
        .agg((F.min("step") / 100).alias("cut"))
    )


def added_spans(
    table: DataFrame,
    max_rows: int = 20_000,
    rounds: int = 10,
    depth: int = 4,
    precision: float = 0.9,
    least: int = 20,
) -> DataFrame | None:
    """Spans the trees add, as one array per (id, text hash); None if nothing can be learned.

    Rows equal in id and text share their proposals, which count once.
    """
    candidates = (
        table.select("__id", "__hash", F.explode("__proposed").alias("p"))
        .select("__id", "__hash", "p.*")
        .dropDuplicates(["__id", "__hash", "start", "kind", "end"])
        .withColumn("fold", F.pmod(F.xxhash64("__id", "__hash"), F.lit(5)))
    )
    candidates = written(candidates, "pii-proposals")
    model = fit_trees(candidates, max_rows, rounds, depth)
    if model is None:
        return None
    scored = model.transform(
        candidates.withColumn("features", array_to_vector("x"))
    ).select(
        "__id", "__hash", "start", "kind", "end", "y", "is_base", "fold",
        F.get(vector_to_array("probability"), F.lit(1)).alias("score"),
    )
    scored = written(scored, "pii-scores")
    cuts = thresholds(scored, precision, least)
    chosen = scored.join(F.broadcast(cuts), "kind").where("score >= cut")
    base = table.where(F.size("__base") > 0).select(
        "__id", "__hash", F.explode("__base").alias("s")
    )
    # Base spans take part with a score no proposal reaches.
    rows = chosen.where("NOT is_base").select(
        "__id", "__hash", "start", "end", "kind", "score"
    ).union(
        base.select("__id", "__hash", "s.start", "s.end", "s.kind", F.lit(2.0)).distinct()
    )
    by_start = Window.partitionBy("__id", "__hash").orderBy("start", "end", "kind")
    reach = F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("__new", (F.col("start") >= F.coalesce(reach, F.lit(0))).cast("int"))
    rows = rows.withColumn("island", F.sum("__new").over(by_start))
    span = F.struct((-F.col("score")).alias("rank"), "start", "kind", "end")
    return (
        rows.groupBy("__id", "__hash", "island")
        .agg(F.sort_array(F.collect_list(span)).alias("chain"))
        .where(F.get("chain", F.size("chain") - 1)["rank"] > -2)
        .groupBy("__id", "__hash")
        .agg(F.sort_array(F.flatten(F.collect_list(_taken(F.col("chain"))))).alias("__added"))
    )


def _taken(chain: Column) -> Column:
    """Spans of a chain, best first, that overlap none taken before; base spans left out."""
    start = F.slice(chain, 1, 0)

    def add(taken: Column, s: Column) -> Column:
        met = F.exists(taken, lambda t: (t["start"] < s["end"]) & (s["start"] < t["end"]))
        return F.when((s["rank"] == -2) | ~met, F.array_append(taken, s)).otherwise(taken)

    return F.transform(
        F.filter(F.aggregate(chain, start, add), lambda s: s["rank"] > -2),
        lambda s: s.dropFields("rank"),
    )


def _all_spans(found: DataFrame, added: DataFrame | None) -> DataFrame:
    """``found`` with ``__spans``: base and added spans, sorted."""
    if added is None:
        return found.withColumn("__spans", F.col("__base"))
    keys = added.select(
        F.col("__id").alias("__a"), F.col("__hash").alias("__b"), F.col("__added")
    )
    joined = found.join(
        keys, F.col("__id").eqNullSafe(F.col("__a")) & (F.col("__hash") == F.col("__b")), "left"
    )
    more = F.coalesce(F.col("__added"), F.array().cast(found.schema["__base"].dataType))
    return joined.withColumn("__spans", F.sort_array(F.concat("__base", more)))


def pii_report(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options
) -> DataFrame:
    """One row per row of ``docs``: counts per kind, digest of base spans, all spans.

    NULL texts count as empty: no spans. Repeated rows get equal rows; an empty table gives
    none. Other columns of ``docs`` are left out, so their names cannot clash.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("__t"))
    found = written(with_spans(rows, "doc_id", "__t").drop("__t"), "pii-spans")
    kinds = F.transform("__base", lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, i))).cast("long").alias(f"n_{k}")
        for i, k in enumerate(KINDS)
    ]
    return _all_spans(found, added_spans(found, **options)).select(
        "doc_id", *counts,
        F.sha2(span_text(F.col("__base")), 256).alias("base_sha256"),
        span_text(F.col("__spans")).alias("spans"),
    )


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; spans sorted by start.

    A span that begins inside an earlier one only lengthens what is taken out.
    """
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    begin = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def add(acc: Column, s: Column) -> Column:
        gap = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        label = F.when(s["start"] >= acc["at"], F.get(names, s["kind"])).otherwise("")
        return F.struct(
            F.concat(acc["out"], gap, label).alias("out"),
            F.greatest(acc["at"], s["end"]).alias("at"),
        )

    return F.aggregate(
        spans, begin, add,
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.char_length(text))),
    )


def redact_documents(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options
) -> DataFrame:
    """``docs`` with personal data replaced; rows without any are unchanged, NULL too.

    Only rows with spans or proposals meet the trees' choice in a join.
    """
    found = written(with_spans(docs, id_column, text_column), "pii-documents")
    added = added_spans(found, **options)
    touched = (F.size("__proposed") > 0) | (F.size("__base") > 0)
    changed = _all_spans(found.where(touched), added).withColumn(
        text_column, redacted(F.col(text_column), F.col("__spans"))
    )
    return changed.select(*docs.columns).unionByName(
        found.where(~touched).select(*docs.columns)
    )
