"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import shared_folder

#: Nodes that a task's contraction holds before it passes them on.
HELD_NODES = 500_000


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace a task's links by links to the smallest node of each of its
    groups, a bounded number of nodes at a time."""
    parent: dict = {}
    schema = None

    def find(x):
        root = x
        while parent[root] != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    def drained():
        rows = [(find(x), x) for x in parent if find(x) != x]
        parent.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array([a for a, _ in rows], schema.field(0).type),
             pa.array([b for _, b in rows], schema.field(1).type)], schema=schema)

    for batch in batches:
        schema = batch.schema
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                        strict=True):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            ra, rb = find(a), find(b)
            if ra != rb:
                parent[max(ra, rb)] = min(ra, rb)
        if len(parent) >= HELD_NODES:
            yield drained()
    if parent:
        yield drained()


def _star(links: DataFrame, both: bool) -> DataFrame:
    """Link each node's neighbours to the smallest of them and itself: those
    larger than the node (``both``), or those smaller and the node itself.

    The smallest neighbours are a table of their own, so that Spark can split
    the join where a node has very many links."""
    if both:
        links = links.select("a", "b").union(links.select(F.col("b"), F.col("a"))
                                             .toDF("a", "b"))
        low = links.groupBy("a").agg(F.min("b").alias("m")).checkpoint()
        joined = links.join(low, "a")
        out = joined.where(F.col("b") > F.col("a")).select(
            F.least("m", "a").alias("a"), "b")
    else:
        # a < b: the smaller neighbours of b, and b itself.
        low = links.groupBy("b").agg(F.min("a").alias("m")).checkpoint()
        out = (links.join(low, "b").where(F.col("a") != F.col("m"))
               .select(F.col("m").alias("a"), F.col("a").alias("b"))
               .union(low.select(F.col("m").alias("a"), "b")))
    return out.distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of the links ``a, b``.

    The component is its smallest node. Nodes may be of any ordered type;
    links in either direction, repeated or from a node to itself are allowed.
    Work per round is proportional to the links and every round shortens the
    paths; nothing is gathered but one row of counts per round.
    """
    shared_folder(links.sparkSession)
    schema = f"a {links.schema['a'].dataType.simpleString()}, " \
             f"b {links.schema['b'].dataType.simpleString()}"
    now = (links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
           .where(F.col("a") != F.col("b"))
           .mapInArrow(_contract, schema).distinct().checkpoint())
    while True:
        after = _star(_star(now, True), False).checkpoint()
        changed = after.join(now, ["a", "b"], "left_anti").limit(1).count() or \
            now.join(after, ["a", "b"], "left_anti").limit(1).count()
        now = after
        if not changed:
            break
    return now.select(F.col("b").alias("node"), F.col("a").alias("component")).union(
        now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
