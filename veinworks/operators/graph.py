"""Connected components of an undirected edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from veinworks.session import durable


EDGES_PER_FILE = 100_000
HUBS = 1024  # a node is a hub with more than this part of all rows, so there are fewer hubs than this


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node of each component.

    ``nodes`` has ``node``, ``edges`` has ``a`` and ``b``. Alternating star
    contraction, at every size: each round is written to the checkpoint folder,
    and the rounds end when the edges no longer change.
    """
    links = _contract(durable(pairs_of(edges).distinct()))
    return nodes.join(links, "node", "left").select("node", F.coalesce("root", "node").alias("component"))


def pairs_of(edges: DataFrame) -> DataFrame:
    """Edges without loops, the larger end first."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def _contract(edges: DataFrame) -> DataFrame:
    """Stars: every node ends up linked to the smallest node it can reach."""
    last, n_edges = None, edges.count()
    while True:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lows = both.groupBy("a").agg(F.min("b").alias("_min"), F.count(F.lit(1)).alias("_n")).withColumn("_min", F.least("a", "_min"))
        # Larger neighbours move to the smallest neighbour of their node.
        large = _with_minimum(both, lows, n_edges).where("b > a").select(F.col("b").alias("a"), F.col("_min").alias("b")).distinct()
        # Smaller neighbours (and the node) move to the smallest of them.
        mins = large.groupBy("a").agg(F.min("b").alias("_min"), F.count(F.lit(1)).alias("_n"))
        small = _with_minimum(large, mins, n_edges)
        moved = small.where("b <> _min").select(F.col("b").alias("a"), F.col("_min").alias("b"))
        found = moved.unionByName(mins.select("a", F.col("_min").alias("b"))).where("a <> b").distinct()
        # A round makes no more edges than it reads: few edges need few files.
        edges = durable(found.coalesce(max(1, n_edges // EDGES_PER_FILE)) if last else found)
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == last:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        last, n_edges = mark, mark[0]


def _with_minimum(rows: DataFrame, minimums: DataFrame, n_edges: int) -> DataFrame:
    """``rows`` (a, b), at most two per edge, with the ``_min`` of their node ``a``.

    The rows of a hub, such as the centre of a star, stay spread: hubs are sent
    to all tasks, fewer than ``HUBS`` rows by their definition.
    """
    hub = F.col("_n") > max(1, 2 * n_edges // HUBS)
    hubs = minimums.where(hub).select("a", F.col("_min").alias("_hub_min"))
    rest = minimums.where(~hub).select("a", "_min", F.lit(0).alias("_salt"))
    salt = F.when(F.col("_hub_min").isNull(), 0).otherwise(1 + F.pmod(F.xxhash64("b"), F.lit(HUBS)).cast("int"))
    marked = rows.join(F.broadcast(hubs), "a", "left").withColumn("_salt", salt)
    return marked.join(rest, ["a", "_salt"], "left").select("a", "b", F.coalesce("_hub_min", "_min").alias("_min"))

