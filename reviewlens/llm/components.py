"""Connected components of links between 64-bit ids, without gathering links or components anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _roots(parents: DataFrame) -> DataFrame:
    """(node, root) from (node, root) with root < node, which is a forest: paths are halved until they end."""
    while True:
        above = parents.select(F.col("node").alias("root"), F.col("root").alias("higher"))
        parents = stored(
            parents.join(above, "root", "left").select(
                "node", F.coalesce("higher", "root").alias("root"), F.col("higher").isNotNull().alias("moved")
            ),
            "roots",
        )
        if parents.where("moved").isEmpty():
            return parents.select("node", "root")
        parents = parents.select("node", "root")


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest id of the component of every node in ``links`` (a, b); stored.

    Every node hooks to its smallest neighbour below it, the forest is flattened, and links are carried
    over to the roots, until no link leads out of a component.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = stored(links.distinct(), "links")
    found = None
    while not links.isEmpty():
        forest = _roots(links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")))
        a, b = (forest.select(F.col("node").alias(x), F.col("root").alias(f"root_{x}")) for x in "ab")
        moved = links.join(a, "a").join(b, "b", "left").select(
            F.col("root_a").alias("x"), F.coalesce("root_b", "b").alias("y")
        )
        links = stored(
            moved.where("x <> y").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(), "links"
        )
        if found is None:
            found = forest
        else:
            higher = forest.select(F.col("node").alias("root"), F.col("root").alias("higher"))
            carried = found.join(higher, "root", "left").select("node", F.coalesce("higher", "root").alias("root"))
            fresh = forest.join(found.select("node"), "node", "left_anti")
            found = stored(carried.unionByName(fresh), "components")
    if found is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = found.select(F.col("root").alias("node"), "root").distinct()
    return stored(found.unionByName(roots.join(found.select("node"), "node", "left_anti")), "labels")


def joined_components(found: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root) of ``components`` with more ``links`` (a, b) among its nodes or others; links work between roots only."""
    a, b = (found.select(F.col("node").alias(x), F.col("root").alias(f"root_{x}")) for x in "ab")
    led = links.join(a, "a", "left").join(b, "b", "left")
    merged = components(led.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")))
    higher = merged.select(F.col("node").alias("root"), F.col("root").alias("higher"))
    carried = found.join(higher, "root", "left").select("node", F.coalesce("higher", "root").alias("root"))
    return carried.unionByName(merged.join(found.select("node"), "node", "left_anti"))
