"""Connected components of a link table by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracknet.plans.iterate import cut, rows


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node that the links ``(a, b)`` join with another
    one; ``root`` is the smallest node that can be reached. Repeated links and
    links of a node with itself change nothing; without links there are no rows.

    In a round every node points to the smallest among itself and its
    neighbours. Pointers are followed by doubling until all point to a node
    that points to itself; then each link is replaced by one between the nodes
    its ends point to, and links within one node and repeated ones go. At most
    half of the nodes that have links keep any, so a class of many links is
    read once and only the few between its parts are read again. At the end
    the rounds' pointers are put together from the last to the first. Every
    step is written to the shared checkpoint folder."""
    edges, left = cut(_proper(links.select("a", "b")), n=rows())
    if not left["n"]:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    pointers = []
    while left["n"]:
        point = lambda x: F.struct(F.col(x).alias("node"), F.col("a").alias("root"))
        at = edges.select(F.explode(F.array(point("a"), point("b"))).alias("p")).groupBy("p.node").agg(F.min("p.root").alias("root"))
        pointers.append(_follow(cut(at)))
        edges, left = cut(_between(edges, pointers[-1]), n=rows())
    found = pointers.pop()
    while pointers:
        found = cut(_then(pointers.pop(), found))
    return found


def join_classes(found: DataFrame, links: DataFrame) -> DataFrame:
    """``(node, root)`` of :func:`components` after more links ``(a, b)``: only
    what these unite is worked out, with the classes as nodes."""
    more = components(_between(links, found))
    alone = more.join(found.select("node"), "node", "left_anti")
    return cut(_then(found, more).unionByName(alone))


def _proper(edges: DataFrame) -> DataFrame:
    return edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _then(found: DataFrame, later: DataFrame) -> DataFrame:
    """``found`` with its roots replaced by the roots that ``later`` gives them, if any."""
    later = later.select(F.col("node").alias("_at"), F.col("root").alias("_root"))
    return found.join(later, F.col("root") == F.col("_at"), "left").select("node", F.coalesce("_root", "root").alias("root"))


def _follow(found: DataFrame) -> DataFrame:
    moved = {"n": 1}
    while moved["n"]:
        later = found.select(F.col("node").alias("_at"), F.col("root").alias("_root"))
        step = found.join(later, F.col("root") == F.col("_at")).select("node", F.col("_root").alias("root"), (F.col("_root") != F.col("root")).alias("moved"))
        found, moved = cut(step, n=F.count_if("moved"))
        found = found.select("node", "root")
    return found


def _between(edges: DataFrame, found: DataFrame) -> DataFrame:
    """The links between different roots."""
    root = lambda x: found.select(F.col("node").alias(f"_{x}"), F.col("root").alias(f"_root_{x}"))
    ends = edges.join(root("a"), F.col("a") == F.col("_a"), "left").join(root("b"), F.col("b") == F.col("_b"), "left")
    return _proper(ends.select(F.coalesce("_root_a", "a").alias("a"), F.coalesce("_root_b", "b").alias("b")))
