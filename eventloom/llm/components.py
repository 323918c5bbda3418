"""Connected components of links, by alternating large-star and small-star steps.

Each step is a minimum per node that all of the node's links need. The links of a node are
dealt out into ``PARTS`` parts by their other end: minima are taken per node and part, then per
node, and go back to the parts first and to the links of a part after that. So a hub's links
never meet in one task; the largest group is a part of them. Links shrink towards stars around
the smallest node of each component. Steps are written to the shared folder, and each step
deletes what the one before wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import written
from eventloom.sources.scratch import delete_scratch

PARTS = 64


def with_least(rows: DataFrame, key: str, value: str, other: str, name: str) -> DataFrame:
    """``rows`` with the least ``value`` of each ``key``, its rows dealt out by ``other``."""
    dealt = rows.withColumn("part", F.pmod(F.xxhash64(other), F.lit(PARTS)))
    per_part = dealt.groupBy(key, "part").agg(F.min(value).alias("low"))
    least = per_part.groupBy(key).agg(F.min("low").alias(name))
    parts = per_part.select(key, "part").join(least, key)
    return dealt.join(parts, [key, "part"]).drop("part")


def _with_least(links: DataFrame) -> DataFrame:
    """(u, v, m) of all links; m is the least node that u is linked with, or u itself."""
    found = with_least(links, "u", "v", "v", "low")
    return found.select("u", "v", F.least("low", "u").alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of a node are linked to its least neighbour instead."""
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    moved = _with_least(both).where("v > u")
    # Repeated links stay: the small star takes minima over them, then drops repeats.
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    moved = _with_least(down)
    ends = F.explode(F.array("v", "u")).alias("u")
    return moved.select(ends, F.col("m").alias("v")).where("u <> v").distinct()


def components(links: DataFrame, most_rounds: int = 50) -> DataFrame:
    """(node, label) of every linked node; the label is the least node it is linked with.

    ``links`` has two columns of node ids. Loops and NULLs are ignored; repeated links and
    both directions are fine. Without links there are no rows.
    """
    a, b = links.columns[:2]
    links = written(
        links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v"),
        "links",
    )
    before = None
    for _ in range(most_rounds):
        last, links = links, written(_small_star(_large_star(links)), "links")
        delete_scratch(last)
        # The stars stop changing when the sum over links does: each step only lowers ends.
        state = links.agg(
            F.count(F.lit(1)), F.sum(F.col("u").cast("decimal(38,0)")),
            F.sum(F.col("v").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("u", "v")),
        ).first()
        if state == before:
            stars = links.select(F.col("u").alias("node"), F.col("v").alias("label"))
            return stars.union(links.select("v", F.col("v").alias("label")).distinct())
        before = state
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
