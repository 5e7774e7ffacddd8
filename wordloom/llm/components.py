"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wordloom.workspace import materialize


def _are_stars(edges: DataFrame) -> bool:
    """Whether, in different links ``a > b``, no ``a`` has two links or is a ``b`` as well."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    tied = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return tied.where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).agg(F.count("*")).first()[0] == 0


def connected_components(links: DataFrame) -> DataFrame:
    """Smallest reachable node of every node in ``links(a, b)``: columns ``node``, ``root``.

    Alternates two star operations until only stars are left: every node is tied to the smallest of
    its neighbours, first for its larger and then for its smaller neighbours. The number of rounds
    grows with the logarithm of the longest path, and links that are stars already need none. Minima
    are taken map-side first, so the hub of a star is one row per task, and joins leave hot hubs to
    adaptive splitting. Every round is a written table; only one count of it comes to the driver.
    Links of a node to itself and repeated links change nothing; an empty table gives an empty one.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = materialize(edges.where("a <> b").distinct(), "links")
    while not _are_stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.where("a <> b")
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        tied = large.join(low, "a")
        small = tied.select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b")
        small = small.unionByName(low.select("a", F.col("low").alias("b"))).distinct()
        edges = materialize(small, "links")
    roots = edges.select(F.col("b").alias("node")).distinct().join(
        edges.select(F.col("a").alias("node")), "node", "left_anti"
    )
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root"))
    )


def joined_components(roots: DataFrame, links: DataFrame) -> DataFrame:
    """The components ``node, root`` after more ``links(a, b)`` between nodes of them or new ones.

    Only the roots that the links touch are looked at again, whatever the sizes of their components.
    """
    old = roots.select("node", F.col("root").alias("old"))
    ends = links
    for end in ("a", "b"):
        ends = ends.join(old.withColumnRenamed("node", end), end, "left")
        ends = ends.withColumn(end, F.coalesce("old", end)).drop("old")
    moved = materialize(connected_components(ends), "moved_roots")
    renamed = moved.select(F.col("node").alias("root"), F.col("root").alias("new"))
    kept = roots.join(renamed, "root", "left").select("node", F.coalesce("new", "root").alias("root"))
    return kept.unionByName(moved.join(roots.select("node"), "node", "left_anti").select("node", "root"))
