from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names the operators use for columns of their own, or might.
CLASHING = (
    "block", "bucket", "keys", "kept", "label", "n", "hash", "score", "base_failed", "y",
    "row", "stratum", "component_id", "n_words", "kept_text", "carried", "spans", "id",
)


def prose(n: int, seed: int) -> str:
    """Words from a small vocabulary, with line ends and letters beyond ASCII."""
    pick = random.Random(seed)
    vocabulary = [
        "".join(pick.choice("abcdeéñ") for _ in range(pick.randint(1, 7))) for _ in range(300)
    ]
    return "".join(
        pick.choice(vocabulary) + pick.choice([" ", " ", " ", " ", "\n", "\t", ". "])
        for _ in range(n)
    )


def edited(text: str, at: int) -> str:
    """The text with one word changed."""
    parts = text.split(" ")
    parts[at % len(parts)] = "changed"
    return " ".join(parts)


@pytest.fixture(scope="session")
def texts() -> list[tuple[int, str | None]]:
    """Odd and ordinary documents with unique ids, ascending."""
    base = prose(400, 1)
    passage = prose(60, 2)
    rows = [
        None, "", " \n\t ", "one", "Two words", "two WORDS", "ab " * 300, "x" * 250,
        base, base, edited(base, 3), edited(edited(base, 3), 90), edited(base, 200),
        prose(80, 3) + passage + prose(50, 4), prose(70, 5) + passage + prose(90, 6),
        passage * 3, prose(20_000, 7), "é" * 120 + prose(50, 8), "é" * 120 + prose(50, 9),
        "\n".join([prose(12, 10).replace("\n", " ")] * 6), "| a | b | # $ %\n" * 20,
        "Licensed under the Apache License, Version 2.0.\n" + prose(30, 11),
        "write to a.b@c-d.org or a@b or x@y.z@q.r; +1 (415) 555-0100 now",
        "card 4111 1111 1111 1111, not 4111 1111 1111 1112; ip 1.2.3.4.5.6.7.8 and 1.2.3.256",
        "host 010.001.000.255 " * 80, prose(60, 12).upper(), prose(60, 12),
    ]
    return list(enumerate(rows, start=10))


@pytest.fixture(scope="session")
def docs(spark, texts):
    langs = ["en", "de", None, "xx"]
    rows = [(i, t, langs[i % 4], f"src{i % 2}", len(t or "")) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def odd_docs(docs):
    """Repeated rows, a NULL id, and extra columns with names that may clash."""
    from pyspark.sql import functions as F

    rows = docs.where("doc_id < 24").union(docs.where("doc_id in (18, 22)"))
    rows = rows.union(docs.where("doc_id = 20").withColumn("doc_id", F.lit(None).cast("long")))
    return rows.withColumns({c: F.lit(f"own {c}") for c in CLASHING}).cache()


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame(
        [(i, int(i % 3 > 0), 0) for i in range(10, 40)] + [(11, None, 0), (12, 1, 0), (None, 1, 0)],
        "doc_id long, quality int, toxic int",
    )


@pytest.fixture(scope="session")
def rows_of():
    def rows(df, *columns):
        return [tuple(r) for r in df.orderBy("doc_id").select(*columns).collect()]

    return rows
