"""Lexical search and whitening against plain versions."""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.llm import whitening
from eventloom.llm.lexical_search import accumulate, ranked_search
from eventloom.llm.whitening import (
    characteristic_polynomial,
    null_vectors,
    products,
    root,
    roots_above,
    whiten,
)
from tests.llm.conftest import CLASHING

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def searched(docs, items, k=50):
    """[(item, rank, doc, score)] by scoring every document for every item."""
    bags = [(i, Counter(terms(t))) for i, t in docs]
    n_docs = sum(1 for _, b in bags if b)
    total = sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    out = []
    for item, wanted in asked.items():
        scores = []
        for doc, bag in bags:
            m = 50 + 50 * sum(bag.values()) * n_docs // max(total, 1)
            score = 0
            for t in wanted & bag.keys():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * (1_000_000_000 * bag[t] // (1000 * bag[t] + 20 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        scores.sort()
        out += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(scores[:k], start=1)]
    return out


def found(spark, docs, items, **options):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    q = spark.createDataFrame(items, "item_id long, text string")
    rows = ranked_search(d, q, **options).collect()
    return [(r.item_id, r["rank"], r.doc_id, r.score) for r in rows]


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


@pytest.fixture(scope="module")
def corpus():
    pick = random.Random(5)
    vocabulary = ["".join(pick.choice("abcÉéñ9") for _ in range(pick.randint(1, 4))) for _ in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    rows = [
        (i, " ,;\n"[pick.randint(0, 3)].join(pick.choices(vocabulary, weights, k=pick.randint(1, 80))))
        for i in range(600)
    ]
    rows += [(None, rows[3][1]), (7, rows[3][1]), (600, rows[3][1]), (601, rows[3][1].upper())]
    rows += [(700, None), (701, ""), (702, " ... !"), (703, "b " * 5000)]
    items = [(i, " ".join(pick.choices(vocabulary, k=12))) for i in range(25)]
    items += [(30, rows[3][1]), (30, "extra terms"), (31, None), (32, ""), (None, "b c"), (33, "zzzzzz")]
    return rows, items


@pytest.mark.parametrize("k", [50, 3])
def test_search_equals_scoring_everything(spark, corpus, k):
    docs, items = corpus
    assert in_order(found(spark, docs, items, k=k)) == in_order(searched(docs, items, k))


def test_search_in_several_passes(spark, corpus):
    docs, items = corpus
    several = found(spark, docs, items, k=4, query_bytes=400)
    assert in_order(several) == in_order(searched(docs, items, 4))


def test_search_without_documents_or_items(spark, corpus):
    docs, items = corpus
    assert found(spark, [], items) == []
    assert found(spark, docs, []) == []
    assert found(spark, [(1, None)], [(1, None)]) == []


def test_search_does_not_look_at_other_columns(spark, corpus):
    docs, items = corpus
    d = spark.createDataFrame(docs, "doc_id long, text string")
    q = spark.createDataFrame(items, "item_id long, text string")
    more = {c: F.lit(1) for c in (*CLASHING, "item", "rank", "texts", "tasks", "term")}
    rows = ranked_search(d.withColumns(more), q.withColumns(more), 3).collect()
    got = [(r.item_id, r["rank"], r.doc_id, r.score) for r in rows]
    assert in_order(got) == in_order(searched(docs, items, 3))


def test_accumulators_stop_and_survivors_are_exact():
    """A rare term decides; documents with the frequent one alone are refused."""
    n = 1000
    lists = [np.arange(10), np.arange(n)]
    docs = np.concatenate(lists)
    gains = np.concatenate((np.full(10, 100), np.arange(n) % 7 + 1)).astype(np.int64)
    cuts = np.array([0, 10, 10 + n])
    score = np.zeros(n, np.int64)
    some, refused = accumulate(np.array([0, 1]), cuts, docs, gains, np.array([100, 7]), score, 5, 0)
    assert some.tolist() == list(range(10)) and refused == n - 10
    assert score[:10].tolist() == [100 + i % 7 + 1 for i in range(10)]


# -- whitening -------------------------------------------------------------------------


def vectors(n, d, seed):
    pick = np.random.default_rng(seed)
    return (pick.normal(size=(n, d)) * np.linspace(0.2, 2, d) + pick.normal(size=d)).astype("f4")


def whitened(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    return whiten(df, **options)


def test_whitening_equals_eigenvectors(spark):
    c = vectors(400, 12, 1)
    odd = [(900, None), (901, []), (902, [1.0] * 11 + [None]), (903, [float("nan")] * 12),
           (904, [float("inf")] + [0.0] * 11), (905, [1.0, 2.0])]
    rows = [(i, v.tolist()) for i, v in enumerate(c)] + [(None, c[5].tolist()), (3, c[6].tolist())]
    got = whitened(spark, rows + odd).toPandas()
    x = np.floor(1024 * np.array([v for _, v in rows], np.float64)) + 100_000
    n = len(x)
    assert len(got) == 8 * n and (got.n == n).all()
    value, vector = np.linalg.eigh(np.cov(x.T, bias=True))
    value, vector = value[::-1][:8], vector[:, ::-1][:, :8]
    want = (x - x.mean(axis=0)) @ vector / np.sqrt(value)
    by_component = [got[got.component == k + 1] for k in range(8)]
    for k, part in enumerate(by_component):
        of_row = part[part.vec_id == 17].whitened.iloc[0]
        sign = np.sign(of_row * want[17, k])
        np.testing.assert_allclose(np.sort(part.whitened), np.sort(sign * want[:, k]), atol=1e-9)
        np.testing.assert_allclose(part.explained, value[k] / np.cov(x.T, bias=True).trace())
    deviation = ((n * x.astype(int) - x.astype(int).sum(axis=0)) ** 2).sum(axis=1)
    assert sorted(by_component[0].deviation) == sorted(deviation.tolist())
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-9


def test_whitening_of_equal_variances(spark):
    """All four roots are one: any orthonormal components do."""
    rows = [(2 * i + s, [float(s * 2 - 1) * (j == i) for j in range(4)]) for i in range(4) for s in (0, 1)]
    got = whitened(spark, rows).toPandas()
    assert set(got.component) == {1, 2, 3, 4} and got.identity_error.iloc[0] < 1e-12
    np.testing.assert_allclose(got.explained, 0.25)


def test_whitening_without_variance_or_rows(spark):
    assert whitened(spark, []).count() == 0
    assert whitened(spark, [(1, None), (2, [float("nan")])]).count() == 0
    assert whitened(spark, [(1, [1.0, 2.0])]).count() == 0
    assert whitened(spark, [(i, [1.0, 2.0]) for i in range(5)]).count() == 0
    line = whitened(spark, [(i, [float(i), 2.0 * i, 1.0]) for i in range(9)]).toPandas()
    assert set(line.component) == {1} and abs(line.explained.iloc[0] - 1) < 1e-12


def test_whitening_of_huge_entries(spark):
    rows = [(i, [3e38 * (-1) ** i, float(i), 1e12 * (i % 3)]) for i in range(6)]
    got = whitened(spark, rows).toPandas()
    assert len(got) == 18 and got.deviation.isna().all()
    assert got.whitened.abs().max() < 10


def test_whitening_does_not_look_at_other_columns(spark):
    rows = [(i, v.tolist()) for i, v in enumerate(vectors(30, 3, 2))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    more = df.withColumns({c: F.lit(1) for c in (*CLASHING, "vector", "d", "count", "cell")})
    assert sorted(whiten(more).collect()) == sorted(whiten(df).collect())


def test_products_are_exact_at_any_size():
    pick = random.Random(3)
    for top in (1, 1000, 1 << 22, 1 << 40, 1 << 62):
        y = np.array([[pick.randint(-top, top) for _ in range(3)] for _ in range(50)], np.int64)
        exact = y.astype(object)
        assert (products(y) == exact.T.dot(exact)).all()


def test_polynomial_and_roots_are_exact(spark):
    # Roots 9, 4, 4, 0 in a basis that makes Hessenberg pivots vanish now and then.
    h = np.array([[1, 1, 1, 1], [1, -1, 1, -1], [1, 1, -1, -1], [1, -1, -1, 1]])
    matrix = (h @ np.diag([9, 4, 4, 0]) @ h.T).astype(object)
    polynomial = characteristic_polynomial(spark, matrix)
    want = np.array([1], object)
    for value in (36, 16, 16, 0):
        want = np.convolve(want, np.array([1, -value], object))
    assert polynomial == want.tolist()
    assert [roots_above(polynomial, a) for a in (-1, 0, 15, 16, 35, 36)] == [4, 3, 3, 1, 1, 0]
    values = [root(polynomial, k) for k in (1, 2, 3, 4)]
    assert [round(float(v), 9) for v in values[:3]] == [36, 16, 16] and values[3] is None
    pair = null_vectors(matrix, values[1], 2)
    np.testing.assert_allclose(pair @ pair.T, np.eye(2), atol=1e-14)
    np.testing.assert_allclose(matrix.astype(float) @ pair.T, 16 * pair.T, atol=1e-12)


def test_close_roots_are_told_apart(spark):
    """Roots that agree in 15 digits, beyond what doubles can part."""
    big = 10**15
    matrix = np.array([[2 * big, 0, 0], [0, 2 * big + 1, 1], [0, 1, 2 * big + 1]], object)
    polynomial = characteristic_polynomial(spark, matrix)
    values = [root(polynomial, k) for k in (1, 2, 3)]
    assert [round(v) for v in values] == [2 * big + 2, 2 * big, 2 * big]
    assert abs(values[0] - (2 * big + 2)) < Fraction(1, 1 << 60)
    vector = null_vectors(matrix, values[0], 1)[0]
    np.testing.assert_allclose(vector, [0, math.sqrt(0.5), math.sqrt(0.5)], atol=1e-15)


def test_primes():
    plain = [p for p in range(1000, 1200) if all(p % q for q in range(2, 35))]
    assert whitening.primes_in(1000, 1200) == plain
