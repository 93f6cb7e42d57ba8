"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.sources.scratch import Scratch


def _with_least(pairs: DataFrame, space: Scratch) -> DataFrame:
    """Pairs (u, v) with the least neighbour of u as m.

    The least ones are stored, so that the pairs of a hub are a skewed join side that can be split.
    """
    least = space.write(pairs.groupBy("u").agg(F.min("v").alias("m")), "least")
    return pairs.join(least, "u")


def components(edges: DataFrame, space: Scratch) -> DataFrame:
    """(node, root) for every node of the edges (a, b) that is not the least of its component.

    The root is the least node that can be reached. Loops and repeated edges change nothing; no
    edges give no rows. Each round is written to the shared folder, which ends its lineage; the
    driver sees a count and a checksum per round.
    """
    stars = space.write(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    seen = None
    while True:
        state = stars.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == seen or not state[0]:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = state
        both = stars.selectExpr("a as u", "b as v").union(stars.selectExpr("b as u", "a as v"))
        large = (
            _with_least(both, space)
            .where("v > u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
            .distinct()
        )
        large = space.write(large, "large")
        kept = _with_least(large, space)
        small = kept.where("v <> m").selectExpr("v as a", "m as b")
        small = small.union(kept.selectExpr("u as a", "m as b")).distinct()
        stars = space.write(small, "stars")
