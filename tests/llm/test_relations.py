"""Connected components, and the pieces that decide which pairs of sets are compared."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from eventloom.llm.components import components
from eventloom.llm.jaccard_join import (
    _candidates,
    _may_reach,
    _Relations,
    _Signatures,
    least_common,
    set_classes,
    signature,
)
from tests.llm import brute


def test_components_against_relabelling(spark):
    pick = random.Random(4)
    links = [(k, k + 1) for k in range(100, 160)]  # a chain
    links += [(1, k) for k in range(2, 40)]  # a star, twice and in both directions
    links += [(k, 1) for k in range(2, 40)]
    links += [(pick.randrange(200, 400), pick.randrange(200, 400)) for _ in range(90)]
    links += [(7000, 7000)]  # a loop links nothing
    label = {n: n for pair in links for n in pair}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    linked = {n for a, b in links if a != b for n in (a, b)}
    found = components(spark.createDataFrame(links, "a long, b long"))
    assert {r.node: r.label for r in found.collect()} == {n: label[n] for n in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_signatures_never_tell_apart_more_than_sets_do():
    rng = np.random.default_rng(9)
    pool = rng.integers(0, 2**63, 6000).astype(np.uint64)
    sets = []
    for size in (3, 120, 130, 140, 900, 1100, 5000):
        first = pool[:size]
        sets += [first, np.r_[first[size // 20 :], pool[-(size // 30 + 1) :]]]
    made = _Signatures([signature(np.unique(s)) for s in sets])
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            apart = made.cells_apart(np.array([i]), np.array([j]))[0]
            assert apart <= len(np.setxor1d(a, b))
            assert (apart == 0) or i != j


def test_position_bound_keeps_every_similar_pair():
    """Sets of n and m with a common first element at places i and j, all possible ones."""
    for n in range(1, 12):
        for m in range(1, 12):
            for i in range(n):
                for j in range(m):
                    most = 1 + min(n - i - 1, m - j - 1) + min(i, j)
                    for percent in (80, 90):
                        possible = 100 * most >= percent * (n + m - most)
                        one = [np.array([v]) for v in (n, m, i, j)]
                        assert not possible or _may_reach(*one, percent)[0]
                        need = least_common(np.array([n + m]), percent)[0]
                        assert 100 * need >= percent * (n + m - need)
                        assert 100 * (need - 1) < percent * (n + m - need + 1)


@pytest.mark.parametrize("percent", [80, 90])
def test_long_lists_lose_no_similar_pair(percent):
    """Over 64 sets in one list; blocks of one place hold sizes far apart.

    A set of n at place i is the numbers from -i to n - i - 1, the list is that of 0.
    """
    pick = random.Random(percent)
    members = {(70, 0), (100, 0), (105, 5), (145, 5)}
    while len(members) < 90:
        place = pick.randrange(8)
        low, high = ((100, 110), (145, 150)) if place % 2 else ((60, 70), (95, 104))
        members.add((pick.choice((pick.randint(*low), pick.randint(*high))), place))
    members = sorted(members)
    sets = [np.arange(5000 - i, 5000 + n - i).astype(np.uint64) for n, i in members]
    want = {
        (a, b)
        for a in range(len(sets))
        for b in range(a + 1, len(sets))
        if 100 * len(np.intersect1d(sets[a], sets[b]))
        >= percent * len(np.union1d(sets[a], sets[b]))
    }
    same = [0] * len(sets)
    rows = pa.table(
        {
            "token": same, "set": range(len(sets)), "n": [n for n, _ in members],
            "place": [i for _, i in members], "label": range(len(sets)), "part": same,
            "left": same, "right": same, "signature": [signature(s) for s in sets],
        }
    )
    found = _candidates(percent, skip=False)(rows)
    pairs = set(zip(found["a"].to_pylist(), found["b"].to_pylist(), strict=True))
    reviewed = (members.index((100, 0)), members.index((105, 5)))
    assert tuple(sorted(reviewed)) in want
    assert want and want <= pairs


def test_relations():
    known = _Relations()
    assert known.relate(5, 3) and known.relate(9, 5) and not known.relate(3, 9)
    assert known.roots(np.array([9, 4, 5])).tolist() == [3, 4, 3]


def test_skipping_does_not_change_the_classes(spark):
    """Many sets around the threshold: neighbours are similar or just not."""
    words = [f"w{k}" for k in range(120)]
    texts = []
    for k in range(40):
        own = words[:]
        for at in range(k % 7):
            own[(11 * k + 17 * at) % 120] = f"x{k}{at}"
        texts.append((k, " ".join(own[: 120 - k % 5])))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    want = brute.classes(texts)
    for skip in (True, False):
        rows = set_classes(docs, skip_related=skip, block_bytes=4000, bucket_bytes=4000).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want
    assert 1 < len({c for _, c in want.values()}) < 40


def test_links_of_a_hub_meet_in_parts(spark):
    """The plan joins links with minima by node and part; a hub's parts are small."""
    from pyspark.sql import functions as F

    from eventloom.llm.components import PARTS, _with_least

    links = spark.createDataFrame([(1, k) for k in range(2, 3002)], "u long, v long")
    found = _with_least(links)
    assert {tuple(r) for r in found.select("u", "m").distinct().collect()} == {(1, 1)}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "part" in next(line for line in plan.splitlines() if "Join Inner" in line)
    part = F.pmod(F.xxhash64("v"), F.lit(PARTS))
    largest = links.groupBy("u", part).count().agg(F.max("count")).first()[0]
    assert largest < 2 * 3000 / PARTS


def _classes(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return sorted(
        ((r.doc_id, r.component_id) for r in set_classes(docs, block_bytes=4000).collect()),
        key=lambda r: tuple((x is None, x or 0) for x in r),
    )


def test_one_id_with_several_texts_and_null_ids(spark):
    """Links follow the texts; an id shared by two texts or missing loses none."""
    first, second, third = (
        " ".join(f"{name}{k}" for k in range(80)) for name in ("a", "b", "c")
    )
    near = lambda text: text + " more"
    rows = [
        (1, first), (1, second), (5, near(first)), (6, near(second)),
        (7, third), (None, near(third)), (None, "alone here"), (None, None), (8, ""),
    ]
    assert _classes(spark, rows) == [
        (1, 1), (1, 1), (5, 1), (6, 1), (7, 7), (8, 8), (None, 7), (None, None), (None, None)
    ]
