"""Connected components by hooking, pointer doubling and contraction, with joins and partial aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curaloom.storage import written


def _to_roots(parent: DataFrame, n: int) -> DataFrame:
    while True:
        grand = parent.select(F.col("node").alias("up"), F.col("up").alias("upper"))
        parent = written(parent.join(grand, "up", "left").select("node", F.coalesce("upper", "up").alias("up"), F.col("upper").isNotNull().alias("moved")), "roots", n)
        if parent.where("moved").isEmpty():
            return parent.select("node", F.col("up").alias("root"))
        parent = parent.select("node", "up")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) with the smallest reachable node as root, for every node of edges (a, b) that isn't a root."""
    edges = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b")
    labels, n, labelled = None, edges.count(), 0
    while True:
        parent = written(edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("up")), "parents", n)
        if parent.isEmpty():
            return labels if labels is not None else parent.select("node", F.col("up").alias("root"))
        roots = _to_roots(parent, n)
        labelled += n
        if labels is not None:
            upper = roots.select(F.col("node").alias("root"), F.col("root").alias("upper"))
            roots_so_far = labels.join(upper, "root", "left").select("node", F.coalesce("upper", "root").alias("root"))
            labels = written(roots_so_far.unionByName(roots), "labels", labelled)
        else:
            labels = roots
        a = roots.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        b = roots.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        moved = edges.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("ra", "a").alias("x"), F.coalesce("rb", "b").alias("y"))
        edges = written(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).where("a < b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).select("a", "b"), "edges", n)
        n = edges.count()
