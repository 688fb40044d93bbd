"""The atom graph of accepted correspondences.

Units are lines from 0 to 1. Correspondences are pairs of spans; they cut the units, cuts carry over from span to span until
nothing new is cut, and pieces that are carried onto each other are one atom. Positions are exact fractions, written ``n/d`` in
lowest terms; their arithmetic is an Arrow-batched Python step, everything around it is joins.

Tables: ``edges`` (left, left_start, left_end, right, right_start, right_end). A cycle of edges with different scales can cut for
ever, so rounds and cuts are limited; past a limit ``LimitExceeded`` is raised and there is no partial result.
"""

from __future__ import annotations

from fractions import Fraction

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import Cut
from .components import components
from .numbering import numbered

#: Cuts of a graph and rounds of carrying them over, at most.
MAX_CUTS, MAX_ROUNDS = 1_000_000, 200


class LimitExceeded(RuntimeError):
    """The graph is larger than its limits."""


def fraction(numerator, denominator):
    """The column n/d in lowest terms."""
    return _reduced(numerator.cast("string"), denominator.cast("string"))


@F.pandas_udf(T.StringType())
def _reduced(n: pd.Series, d: pd.Series) -> pd.Series:
    return pd.Series([None if a is None or b is None else _text(Fraction(int(a), int(b))) for a, b in zip(n, d)], dtype=object)


def _text(x: Fraction) -> str:
    return f"{x.numerator}/{x.denominator}"


@F.pandas_udf(T.StringType())
def _carried(at: pd.Series, a0: pd.Series, a1: pd.Series, b0: pd.Series, b1: pd.Series) -> pd.Series:
    """The place in the span b0..b1 that corresponds to a place in a0..a1; null outside."""
    out = []
    for p, x, y, u, v in zip(at, a0, a1, b0, b1):
        p, x, y = Fraction(p), Fraction(x), Fraction(y)
        if p < x or p > y:
            out.append(None)
        else:
            u, v = Fraction(u), Fraction(v)
            out.append(_text(u + (p - x) * (v - u) / (y - x)))
    return pd.Series(out, dtype=object)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _in_order(places: pd.Series) -> pd.Series:
    return pd.Series([sorted(x, key=Fraction) for x in places])


def _both_ways(edges: DataFrame) -> DataFrame:
    one = edges.select(F.col("left").alias("unit"), F.col("left_start").alias("a0"), F.col("left_end").alias("a1"), F.col("right").alias("to"), F.col("right_start").alias("b0"), F.col("right_end").alias("b1"))
    two = edges.select(F.col("right").alias("unit"), F.col("right_start").alias("a0"), F.col("right_end").alias("a1"), F.col("left").alias("to"), F.col("left_start").alias("b0"), F.col("left_end").alias("b1"))
    return one.unionByName(two)


def cuts(edges: DataFrame, more: DataFrame | None = None, max_cuts: int = MAX_CUTS, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """unit, place: all cuts of all units, both ends included, carried over the edges until none is new.

    ``more``: (unit, place) of units and cuts that count besides, such as those of implications, over which nothing is carried.
    """
    ways = Cut(_both_ways(edges).distinct(), "ways").df
    own = ways.select("unit", F.explode(F.array(F.lit("0/1"), F.lit("1/1"), "a0", "a1")).alias("place"))
    if more is not None:
        own = own.unionByName(more.select("unit", F.explode(F.array(F.lit("0/1"), F.lit("1/1"), "place")).alias("place")))
    known = Cut(own.distinct(), "cuts")
    fresh = known
    for _ in range(max_rounds):
        carried = fresh.df.join(ways, "unit").select(F.col("to").alias("unit"), _carried("place", "a0", "a1", "b0", "b1").alias("place")).where("place IS NOT NULL").distinct()
        new = Cut(carried.join(known.df, ["unit", "place"], "left_anti"), "cuts")
        if not new.df.head(1):
            return known.df
        known = Cut(known.df.unionByName(new.df), "cuts")
        if known.df.count() > max_cuts:
            raise LimitExceeded(f"more than {max_cuts} cuts")
        fresh = new
    raise LimitExceeded(f"cuts did not settle in {max_rounds} rounds")


def fragments(found: DataFrame) -> DataFrame:
    """unit, piece (from 0), start, end between neighbouring cuts."""
    ordered = found.groupBy("unit").agg(F.collect_set("place").alias("p")).select("unit", _in_order("p").alias("p"))
    pieces = F.transform(F.sequence(F.lit(1), F.size("p") - 1), lambda i: F.struct(F.element_at("p", i).alias("start"), F.element_at("p", i + 1).alias("end")))
    return ordered.where(F.size("p") > 1).select("unit", F.posexplode(pieces).alias("piece", "x")).select("unit", "piece", "x.start", "x.end")


def atoms(edges: DataFrame, more: DataFrame | None = None, max_cuts: int = MAX_CUTS) -> DataFrame:
    """unit, piece, start, end, atom: pieces that edges carry onto each other have one atom; atoms are numbered densely in order of
    their first piece by unit and place."""
    pieces = Cut(fragments(cuts(edges, more, max_cuts)).withColumn("id", F.concat_ws("#", "unit", F.format_string("%09d", "piece"))), "pieces").df
    carried = pieces.select(F.col("unit"), "start", "end", "id").join(edges.select(F.col("left").alias("unit"), F.col("left_start").alias("a0"), F.col("left_end").alias("a1"), F.col("right").alias("to"), F.col("right_start").alias("b0"), F.col("right_end").alias("b1")), "unit")
    span = carried.select("id", "to", _carried("start", "a0", "a1", "b0", "b1").alias("s"), _carried("end", "a0", "a1", "b0", "b1").alias("e")).where("s IS NOT NULL AND e IS NOT NULL")
    other = pieces.select(F.col("unit").alias("to"), F.col("start").alias("s"), F.col("end").alias("e"), F.col("id").alias("other"))
    joined = components(span.join(other, ["to", "s", "e"]).select(F.col("id").alias("a"), F.col("other").alias("b")))
    rooted = pieces.join(joined, pieces["id"] == joined["node"], "left").select("unit", "piece", "start", "end", F.coalesce("root", "id").alias("root"))
    first = numbered(rooted.groupBy("root").agg(F.min(F.struct("unit", "piece")).alias("first")).select("root", "first.*"), ("unit", "piece"), "atom")
    return rooted.join(first.select("root", "atom"), "root").select("unit", "piece", "start", "end", F.col("atom").cast("int").alias("atom"))


def conflicts(found: DataFrame) -> DataFrame:
    """Units that own one atom twice."""
    return found.groupBy("unit", "atom").agg(F.count("*").alias("times")).where("times > 1")


def _atom_set(found: DataFrame, keys: list[str]) -> DataFrame:
    return found.groupBy(*keys).agg(F.array_sort(F.collect_set("atom")).alias("atoms"))


def group_rules(found: DataFrame, groups: DataFrame) -> DataFrame:
    """Unordered coverage as rules: ``groups`` (claim_id, side 0 or 1, unit) to the distinct pairs of atom sets, smaller first."""
    sides = _atom_set(groups.join(found.select("unit", "atom"), "unit"), ["claim_id", "side"])
    both = sides.where("side = 0").select("claim_id", F.col("atoms").alias("x")).join(sides.where("side = 1").select("claim_id", F.col("atoms").alias("y")), "claim_id")
    return both.select(F.least("x", "y").alias("antecedent"), F.greatest("x", "y").alias("consequent")).distinct()


@F.pandas_udf(T.BooleanType())
def _within(start: pd.Series, end: pd.Series, a0: pd.Series, a1: pd.Series) -> pd.Series:
    return pd.Series([Fraction(s) >= Fraction(x) and Fraction(e) <= Fraction(y) for s, e, x, y in zip(start, end, a0, a1)], dtype=bool)


def implication_rules(found: DataFrame, implications: DataFrame) -> DataFrame:
    """Implications as rules from the atoms of the left span to those of the right one; no atoms are merged by them."""
    rows = implications.withColumn("__id", F.monotonically_increasing_id())
    rows = Cut(rows, "implications").df
    side = lambda p, n: _atom_set(found.join(rows.select("__id", F.col(p).alias("unit"), F.col(f"{p}_start").alias("a0"), F.col(f"{p}_end").alias("a1")), "unit").where(_within("start", "end", "a0", "a1")), ["__id"]).withColumnRenamed("atoms", n)
    return side("left", "antecedent").join(side("right", "consequent"), "__id").select("antecedent", "consequent").distinct()


def correspondences(statements: DataFrame, segments: DataFrame) -> DataFrame:
    """The edges that ordered alignments give. ``segments``: claim_id, left, left_extent, left_offset, right, right_extent,
    right_offset, shared; ``statements``: claim_id, operator. Adds the operator, so that implications can be told from edges."""
    at = lambda offset, extent: fraction(offset, F.col(extent))
    return segments.join(statements.select("claim_id", "operator"), "claim_id").select(
        "claim_id", "operator", "left", at(F.col("left_offset"), "left_extent").alias("left_start"), at(F.col("left_offset") + F.col("shared"), "left_extent").alias("left_end"),
        "right", at(F.col("right_offset"), "right_extent").alias("right_start"), at(F.col("right_offset") + F.col("shared"), "right_extent").alias("right_end"),
    )
