"""Connected components of a link table.

Links stay in Spark.  ``forest_roots`` follows parent pointers by doubling;
``connected_components`` alternates large-star and small-star: a round is a minimum per node
and a join of the links with their node's minimum.  No node's neighbours are gathered
in one place, so a hub with any number of links is only a skewed join, which Spark
splits.  ``merge_roots`` adds links to known components by working on the components
alone.  Rounds are written to the shared folder and end when nothing changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.tables import shared_table


def forest_roots(parents: DataFrame) -> DataFrame:
    """(node, up) with one row per node and up < node -> (node, root)."""
    cur = shared_table(parents.select("node", F.col("up").alias("root")), "forest")
    while True:
        above = cur.select(F.col("node").alias("n"), F.col("root").alias("r"))
        cur = shared_table(cur.join(above, F.col("root") == F.col("n"), "left")
                           .select("node", F.coalesce("r", "root").alias("root"), F.col("r").isNotNull().alias("moved")), "forest")
        if cur.where("moved").isEmpty():
            return cur.select("node", "root")
        cur = cur.select("node", "root")


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """(a, b) links between long ids -> (node, root): every linked node and the
    smallest node that it reaches."""
    cur = shared_table(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    state = _state(cur)
    while state[0]:
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        near = large.join(least, "u")
        small = near.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v") \
            .unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        cur = shared_table(small, "links")
        now = _state(cur)
        if now == state:
            break
        state = now
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root")) \
        .unionByName(cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def merge_roots(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Roots after more links (a, b): components are joined, nodes without a root so far
    are their own."""
    x = links.join(roots.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a", "left") \
        .join(roots.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b", "left")
    joined = connected_components(x.select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")))
    moved = joined.select(F.col("node").alias("root"), F.col("root").alias("to"))
    old = roots.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return shared_table(old.unionByName(joined.join(roots, "node", "left_anti").select("node", "root")), "roots")
