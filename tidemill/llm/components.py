"""Connected components of a set of links, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import stage


def contract(links: DataFrame) -> DataFrame:
    """node and component (the smallest node reached) for every node of links `a`, `b`.

    In each step every node points to its neighbour of lowest hash. Of two that point to
    each other the lower one is a root, and no longer circle can occur, as hashes fall
    along every second pointer. Pointers are followed twice, and links are rewritten to
    what they point to. Every node with a link points somewhere, so at least half of
    them vanish in a step; a star vanishes in one. Hash order keeps the chains short
    whatever the ids. A node with very many links is summed up in the tasks first.
    Links reach no driver.
    """
    edges = stage(links.filter("a <> b").select("a", "b").distinct(), "links")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    labels = stage(nodes.withColumn("label", F.col("node")), "labels")
    step = 0
    while not edges.isEmpty():
        step += 1
        ranked = lambda c: F.struct(F.xxhash64(F.lit(step), c).alias("h"), F.col(c).alias("n"))
        both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
        lowest = both.groupBy("a").agg(F.min(ranked("b")).alias("low"))
        hooks = stage(lowest.select(F.col("a").alias("n"), F.col("low.n").alias("up")), "hooks")
        over = hooks.select(F.col("n").alias("m"), F.col("up").alias("upper"))
        root = (F.col("upper") == F.col("n")) & (ranked("n") < ranked("up"))
        up = hooks.join(over, F.col("up") == F.col("m"))
        up = stage(up.select("n", F.when(root, F.col("n")).otherwise(F.col("up")).alias("up")), "up")
        for _ in range(2):
            over = up.select(F.col("n").alias("m"), F.col("up").alias("upper"))
            up = up.join(over, F.col("up") == F.col("m")).select("n", F.col("upper").alias("up"))
        up = stage(up, "up")
        at = lambda name: up.select(F.col("n").alias(f"{name}n"), F.col("up").alias(name))
        edges = stage(
            edges.join(at("x"), F.col("a") == F.col("xn"))
            .join(at("y"), F.col("b") == F.col("yn"))
            .filter("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .distinct(),
            "links",
        )
        labels = stage(
            labels.join(at("z"), F.col("label") == F.col("zn"), "left").select(
                "node", F.coalesce("z", "label").alias("label")
            ),
            "labels",
        )
    smallest = labels.groupBy("label").agg(F.min("node").alias("component"))
    return stage(labels.join(smallest, "label").select("node", "component"), "components")


def extend(components: DataFrame | None, links: DataFrame) -> DataFrame:
    """`components` as they are with more links, which are contracted among components."""
    if components is None:
        return contract(links)
    for side in ("a", "b"):
        own = components.select(F.col("node").alias("of"), F.col("component").alias("own"))
        links = links.join(own, F.col(side) == F.col("of"), "left").withColumn(side, F.coalesce("own", side)).drop("of", "own")
    merged = contract(links)
    moved = merged.select(F.col("node").alias("of"), F.col("component").alias("to"))
    known = components.join(moved, F.col("component") == F.col("of"), "left")
    known = known.select("node", F.coalesce("to", "component").alias("component"))
    return stage(known.unionByName(merged.join(components, "node", "left_anti")), "components")
