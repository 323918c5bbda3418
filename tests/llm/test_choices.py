"""Cut-offs and proposals that are chosen by what was learned, on planted rows."""

from __future__ import annotations

import random
from math import comb

from pyspark.sql import functions as F

from eventloom.llm import pii
from eventloom.llm.quality_rules import MEASURED, RULES, cutoffs

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def measures(c: dict[str, int]) -> dict[str, float | None]:
    def ratio(top, bottom):
        return top / bottom if bottom else None

    return {
        "symbols": ratio(c["n_symbols"], c["n_words"]),
        "repeated_lines": ratio(c["n_dup_lines"], c["n_lines"]),
        "repeated_words": ratio(c["n_repeat_words"], c["n_words"]),
        "long_words": ratio(c["word_chars"], c["n_words"]),
        "short_words": ratio(-c["word_chars"], c["n_words"]),
    }


def planted_counts(pick: random.Random, good: bool) -> tuple[int, ...]:
    n = pick.randint(50, 400)
    bad = not good and pick.random() < 0.7
    symbols = int(n * pick.choice([0.5, 1.0, 3.0])) if bad else int(n * pick.random() * 0.03)
    if good and pick.random() < 0.008:
        symbols = n
    lines = pick.randint(1, 30)
    again = int(lines * 0.6) if bad and pick.random() < 0.5 else 0
    return (n, int(n * pick.uniform(4.2, 6.5)), symbols, again, int(n * 0.02 * bad), lines)


def brute_cutoffs(rows, draft_ids, risk=0.02, error=0.05, n_strata=5):
    """{stratum: {rule: cut}} by the same procedure in plain loops."""
    grid = [(rule, cut) for rule, (_, cuts) in RULES.items() for cut in cuts]

    def rejects(m, j):
        value = m[grid[j][0]]
        return value is not None and value > grid[j][1]

    def tail(k, n):
        return sum(comb(n, i) * risk**i * (1 - risk) ** (n - i) for i in range(k + 1))

    rows = [(i, s, q, measures(dict(zip(COUNTS, c, strict=True)))) for i, s, q, c in rows]
    caught = [sum(rejects(m, j) for _, _, q, m in rows if q == 0) for j in range(len(grid))]
    found = {}
    for stratum in {r[1] for r in rows}:
        good = [(i, m) for i, s, q, m in rows if s == stratum and q == 1]
        draft = [m for i, m in good if i in draft_ids]
        held = [m for i, m in good if i not in draft_ids]
        lost = [sum(rejects(m, j) for m in draft) for j in range(len(grid))]
        order = sorted(
            (j for j in range(len(grid)) if caught[j] and lost[j] <= risk * len(draft)),
            key=lambda j: ((lost[j] + 0.5) / caught[j], -j),
        )
        admitted = []
        for j in order:
            gone = sum(any(rejects(m, x) for x in [*admitted, j]) for m in held)
            if gone > risk * len(held) or tail(gone, len(held)) > error / n_strata:
                break
            admitted.append(j)
        cuts = {}
        for j in admitted:
            rule, cut = grid[j]
            cuts[rule] = min(cut, cuts.get(rule, cut))
        found[stratum] = cuts
    return found


def test_cutoffs_against_plain_loops(spark):
    pick = random.Random(5)
    sizes = {"en": 1800, "de": 500, "fr": 120}
    rows = []
    for lang, n in sizes.items():
        for _ in range(n):
            good = pick.random() < 0.85
            rows.append((len(rows), lang, int(good), planted_counts(pick, good)))
    rows += rows[:300]  # rows that repeat count once
    schema = f"id long, lang string, quality int, {MEASURED} struct<" + ", ".join(
        f"{c}: long" for c in COUNTS
    ) + ">"
    df = spark.createDataFrame(rows, schema)
    draft = {
        r.id for r in df.where(F.pmod(F.xxhash64("id"), F.lit(5)) == 0).select("id").collect()
    }
    got = {
        r.stratum: {rule: r[rule] for rule in RULES if r[rule] is not None}
        for r in cutoffs(df, "quality", "lang", "id").collect()
    }
    want = brute_cutoffs(sorted(set(rows)), draft)
    assert got == want
    assert want["en"] and want["de"] and not want["fr"]


def check_digit(digits: str) -> str:
    total = sum(
        d - 9 * (d > 9)
        for d in (int(c) * (2 - i % 2) for i, c in enumerate(reversed(digits)))
    )
    return str(-total % 10)


def planted_texts(n: int):
    """(id, text, spans that are personal, spans written alike that are not)."""
    pick = random.Random(9)

    def number(k):
        return "".join(pick.choice("0123456789") for _ in range(k))

    def name():
        return "".join(pick.choice("abcdefghklmn") for _ in range(pick.randint(3, 8)))

    def card(valid):
        body = pick.choice("45") + number(14)
        last = check_digit(body)
        full = body + (last if valid else str((int(last) + 3) % 10))
        return ".".join(full[k : k + 4] for k in range(0, 16, 4))

    private = {
        "at": lambda: f"{name()} (at) {name()} (dot) org",
        "email": lambda: f"{name()}@{name()}.com",
        "phone": lambda: f"phone {pick.randint(2, 9)}{number(2)} {number(3)} {number(4)}",
        "plus": lambda: f"+1 {number(3)} {number(3)} {number(4)}",
        "card": lambda: card(True),
        "ip": lambda: ".".join(str(pick.randint(0, 255)) for _ in range(4)),
    }
    plain = {
        "other card": lambda: card(False),
        "amounts": lambda: f"about {pick.randint(1, 9)},{number(3)},{number(3)}",
        "ids": lambda: f"order {number(8)}",
        "version": lambda: f"version {pick.randint(1, 9)}.{number(1)}.{number(2)}",
    }
    for i in range(n):
        text, good, bad = f"Note {name()} ", [], []
        for kind in pick.sample([*private, *plain], 4):
            made = (private | plain)[kind]()
            begin = len(text) + (len("phone ") if kind == "phone" else 0)
            into = good if kind in private else bad
            into.append((kind, begin, len(text) + len(made)))
            text += made + pick.choice([" and ", ", then ", "; "]) + name() + " "
        yield i, text, good, bad


def test_loose_forms_are_found(spark):
    rows = list(planted_texts(900))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    found = {
        r.doc_id: {tuple(map(int, s.split(":")[1:])) for s in r.spans.split(",") if s}
        for r in pii.pii_report(docs.repartition(4)).collect()
    }
    total, hit, wrong = {}, {}, 0
    for i, _, good, bad in rows:
        for kind, begin, end in good:
            total[kind] = total.get(kind, 0) + 1
            hit[kind] = hit.get(kind, 0) + ((begin, end) in found[i])
        wrong += sum(any(b < x and s < e for s, x in found[i]) for _, b, e in bad)
    assert {k: hit[k] / total[k] for k in total} == {
        k: v for k, v in ((k, hit[k] / total[k]) for k in total) if v >= 0.9
    }
    assert wrong <= 0.1 * sum(hit[k] for k in ("at", "phone", "card"))


def test_spans_of_a_chain(spark):
    """Base span, then a loser that reaches over to a third one: the third stays."""
    chain = [(-2.0, 0, 0, 10), (-0.9, 20, 1, 30), (-0.8, 8, 2, 22), (-0.7, 30, 3, 35)]
    df = spark.createDataFrame(
        [(chain,)], "chain array<struct<rank: double, start: int, kind: int, end: int>>"
    )
    taken = df.select(pii._taken(F.col("chain")).alias("t")).first().t
    assert [tuple(s) for s in taken] == [(20, 1, 30), (30, 3, 35)]
