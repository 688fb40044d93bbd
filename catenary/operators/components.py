"""Connected components by random contraction.

In each round every vertex hooks to that one of itself and its neighbours which comes first in a fresh hash order; edges are
relabelled to the chosen vertices, loops and repeats are dropped, and the rounds go on until no edge is left. A constant share of the
vertices is expected to vanish in a round whatever the shape, so their number is logarithmic without any bound set on it, and the work of
all rounds together is a small multiple of the first. The chosen vertices are then expanded backwards.

Each round writes two tables to the shared folder, so a lost executor costs a few tasks; their rows are counted as they are written. No
vertex's neighbours are gathered: the choice is a partial aggregation, and relabelling goes through ``lookup``, which keeps the edges
of a hub where they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Cut
from .lookup import ROWS, lookup


def _both_ends(edges: DataFrame, table: DataFrame, a: str, b: str, key: str, value: str, rows: int, hot_rows: int) -> DataFrame:
    """a, b: what the table (key, value) says of both ends of each edge. Beyond ``hot_rows`` the first end is written before the
    second is looked up, since hot keys are counted in it."""
    one = lookup(edges.select(F.col(a).alias(key), F.col(b).alias("__b")), table, key, rows, hot_rows=hot_rows).select(F.col(value).alias("a"), F.col("__b").alias(key))
    held = Cut(one, "ends") if rows > hot_rows else None
    return lookup(held.df if held else one, table, key, rows, hot_rows=hot_rows).select("a", F.col(value).alias("b"))


def contract(edges: DataFrame, hot_rows: int = ROWS, seed: int = 0) -> DataFrame:
    """v, root: for each vertex of ``edges`` (columns a and b, bigint) the one vertex that stands for its component."""
    at = Cut(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    rounds: list[Cut] = []
    while at.rows > 0:
        order = F.lit(len(rounds) * 1000003 + seed)
        both = at.df.union(at.df.select("b", "a"))
        chosen = both.groupBy(F.col("a").alias("v")).agg(F.min_by("b", F.xxhash64("b", order)).alias("n"))
        chosen = Cut(chosen.select("v", F.when(F.xxhash64("n", order) < F.xxhash64("v", order), F.col("n")).otherwise(F.col("v")).alias("root")), "chosen")
        rounds.append(chosen)
        new = _both_ends(at.df, chosen.df, "a", "b", "v", "root", at.rows, hot_rows)
        new = Cut(new.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
        at.drop()
        at = new
    at.drop()
    if not rounds:
        return edges.select(F.col("a").alias("v"), F.col("a").alias("root")).limit(0)
    found = rounds.pop()
    while rounds:
        step = rounds.pop()
        later = found.df.select(F.col("v").alias("root"), F.col("root").alias("last"))
        wide = Cut(lookup(step.df, later, "root", step.rows, "left", hot_rows).select("v", F.coalesce("last", "root").alias("root")), "roots")
        found.drop()
        step.drop()
        found = wide
    return found.df


def components(edges: DataFrame, a: str = "a", b: str = "b", hot_rows: int = ROWS) -> DataFrame:
    """node and root (the smallest node of its component) of every node that an edge names. A null end names none; its other end is a
    node."""
    links = Cut(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a IS NOT NULL OR b IS NOT NULL").distinct(), "links")
    nodes = Cut(links.df.select(F.explode(F.array("a", "b")).alias("node")).where("node IS NOT NULL").distinct().withColumn("v", F.monotonically_increasing_id()), "nodes")
    pairs = links.df.where("a <> b")
    roots = contract(_both_ends(pairs, nodes.df, "a", "b", "node", "v", links.rows, hot_rows), hot_rows)
    named = Cut(nodes.df.join(roots, "v", "left").select("node", F.coalesce("root", "v").alias("root")), "named")
    smallest = named.df.groupBy("root").agg(F.min("node").alias("__least"))
    return lookup(named.df, smallest, "root", named.rows, hot_rows=hot_rows).select("node", F.col("__least").alias("root"))
