"""Aligning ordered members: by extent, by position, by unique evidence; runs of neighbours and how they are written.

Positions are exact: extents are summed as decimals, a share of a member is a pair of integers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.content import normalize_title, strict_date

WIDE = "decimal(38,0)"


def cumulated(members: DataFrame, keys: tuple[str, ...] = ("claim_id", "side"), order: str = "ordinal", extent: str = "extent") -> DataFrame:
    """Members with the extent before them (start) and up to their end (end). A side has at most as many members as its claim's
    limit, so its window is bounded."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return members.withColumn("end", F.sum(F.col(extent).cast(WIDE)).over(w).cast(WIDE)).withColumn("start", (F.col("end") - F.col(extent)).cast(WIDE))


def align_extents(left: DataFrame, right: DataFrame, keys: tuple[str, ...] = ("claim_id",), order: str = "ordinal", extent: str = "extent") -> DataFrame:
    """The stretches that left and right members share when both sides are laid along one line: keys, left and right ordinals,
    the offsets in both members, and the shared extent.

    The members' ends cut the line; each piece between neighbouring cuts belongs to the member of each side whose end comes next.
    So both sides are merged by one sort over their ends, and no member is paired with one that it does not touch.
    """
    a = cumulated(left, keys, order, extent).where(F.col("end") > F.col("start")).select(*keys, "end", F.struct(F.col(order).alias("ordinal"), "start").alias("l"), F.lit(None).alias("r"))
    b = cumulated(right, keys, order, extent).where(F.col("end") > F.col("start")).select(*keys, "end", F.lit(None).alias("l"), F.struct(F.col(order).alias("ordinal"), "start").alias("r"))
    cuts = a.unionByName(b).groupBy(*keys, "end").agg(F.max("l").alias("l"), F.max("r").alias("r"))
    onward = Window.partitionBy(*keys).orderBy(F.desc("end")).rowsBetween(Window.unboundedPreceding, 0)
    along = Window.partitionBy(*keys).orderBy(F.desc("end"))
    rows = cuts.select(*keys, "end", F.coalesce(F.lead("end").over(along), F.lit(0).cast(WIDE)).alias("from"), F.last("l", ignorenulls=True).over(onward).alias("l"), F.last("r", ignorenulls=True).over(onward).alias("r"))
    return rows.where("l IS NOT NULL AND r IS NOT NULL").select(
        *keys, F.col("l.ordinal").alias("left_ordinal"), F.col("r.ordinal").alias("right_ordinal"), (F.col("from") - F.col("l.start")).cast(WIDE).alias("left_offset"), (F.col("from") - F.col("r.start")).cast(WIDE).alias("right_offset"), (F.col("end") - F.col("from")).cast(WIDE).alias("shared")
    )


def tails(left: DataFrame, right: DataFrame, keys: tuple[str, ...] = ("claim_id",), order: str = "ordinal", extent: str = "extent") -> DataFrame:
    """What of each side lies beyond the shorter one: keys, side, ordinal, from (covered part of the member) and extent."""
    totals = lambda d, n: d.groupBy(*keys).agg(F.sum(F.col(extent).cast(WIDE)).cast(WIDE).alias(n))
    shared = totals(left, "__l").join(totals(right, "__r"), list(keys)).select(*keys, F.least("__l", "__r").alias("__shared"))
    out = None
    for side, rows in (("left", left), ("right", right)):
        placed = cumulated(rows, keys, order, extent).join(shared, list(keys))
        rest = placed.where(F.col("end") > F.col("__shared")).select(*keys, F.lit(side).alias("side"), order, F.greatest(F.lit(0).cast(WIDE), F.col("__shared") - F.col("start")).cast(WIDE).alias("covered"), F.col(extent).cast(WIDE).alias("extent"))
        out = rest if out is None else out.unionByName(rest)
    return out


def zip_members(left: DataFrame, right: DataFrame, keys: tuple[str, ...] = ("claim_id",), order: str = "ordinal") -> DataFrame:
    """Members of both sides at the same place."""
    rank = lambda d, p: d.select(*keys, F.row_number().over(Window.partitionBy(*keys).orderBy(order)).alias("place"), *[F.col(c).alias(f"{p}_{c}") for c in d.columns if c not in keys])
    return rank(left, "left").join(rank(right, "right"), [*keys, "place"])


def islands(rows: DataFrame, keys: tuple[str, ...], order: str, breaks: Column, name: str = "island") -> DataFrame:
    """Numbers the runs of each key: ``breaks`` says (with lag) whether a row does not go on from the one before."""
    w = Window.partitionBy(*keys).orderBy(order)
    return rows.withColumn("__break", F.when(F.coalesce(breaks, F.lit(True)), 1).otherwise(0)).withColumn(name, F.sum("__break").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__break")


def match_unique(left: DataFrame, right: DataFrame, keys: tuple[str, ...], signature: tuple[str, ...]) -> DataFrame:
    """left and right references that belong together: the explicit link where there is one, even if it leads nowhere; else the
    signature, where it is unique on both sides. Targets met twice are dropped. Columns: keys, reference, linked_reference."""
    named = lambda d: d.where(" AND ".join(f"{c} IS NOT NULL" for c in signature))
    unique = lambda d, n: named(d).groupBy(*keys, *signature).agg(F.min("reference").alias(n), F.count("*").alias("__n")).where("__n = 1").drop("__n")
    known = right.select(*keys, F.col("reference").alias("linked_reference"))
    explicit = left.where("linked_reference IS NOT NULL").join(known, [*keys, "linked_reference"], "left_semi").select(*keys, F.col("reference").alias("left_reference"), F.col("linked_reference").alias("right_reference"))
    pairs = unique(left, "left_reference").join(unique(right, "right_reference"), [*keys, *signature]).select(*keys, "left_reference", "right_reference")
    linked = left.where("linked_reference IS NOT NULL").select(*keys, F.col("reference").alias("left_reference"))
    both = explicit.unionByName(pairs.join(linked, [*keys, "left_reference"], "left_anti"))
    once = both.groupBy(*keys, "right_reference").agg(F.count("*").alias("__n"), F.min("left_reference").alias("left_reference")).where("__n = 1")
    return once.select(*keys, "left_reference", "right_reference")


def order_violations(episodes: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Coordinates or references that an order has twice."""
    twice = lambda *c: episodes.groupBy(*keys, *c).agg(F.count("*").alias("n")).where("n > 1").drop("n")
    at = twice("season", "episode").select(*keys, F.concat_ws("x", "season", "episode").alias("what"), F.lit("ambiguous coordinates").alias("message"))
    return at.unionByName(twice("reference").select(*keys, F.col("reference").alias("what"), F.lit("repeated episode").alias("message")))


def episode_runs(left: DataFrame, right: DataFrame, keys: tuple[str, ...] = ("parent",)) -> DataFrame:
    """Runs of matched episodes of two orders: keys, run, and both sides' reference, season and episode.

    Orders have reference, season, episode, title, air_date, linked_reference. A run goes on while both sides go to the next
    episode of their order and that is the next number of the season, or in a later season.
    """
    w = Window.partitionBy(*keys).orderBy("season", "episode")
    placed = lambda d: d.withColumn("__title", normalize_title("title")).withColumn("__date", strict_date(F.col("air_date"))).withColumn("__at", F.row_number().over(w))
    a, b = placed(left), placed(right)
    pairs = match_unique(a, b, keys, ("__title", "__date"))
    side = lambda d, p: d.select(*keys, F.col("reference").alias(f"{p}_reference"), F.col("season").alias(f"{p}_season"), F.col("episode").alias(f"{p}_episode"), F.col("__at").alias(f"{p}_at"))
    rows = pairs.join(side(a, "left"), [*keys, "left_reference"]).join(side(b, "right"), [*keys, "right_reference"])
    along = Window.partitionBy(*keys).orderBy("left_at")
    before = lambda c: F.lag(c).over(along)
    goes_on = lambda p: (F.col(f"{p}_at") == before(f"{p}_at") + 1) & F.when(F.col(f"{p}_season") == before(f"{p}_season"), F.col(f"{p}_episode") == before(f"{p}_episode") + 1).otherwise(F.col(f"{p}_season") > before(f"{p}_season"))
    return islands(rows, keys, "left_at", ~(goes_on("left") & goes_on("right")), "run")


def spans(runs: DataFrame, keys: tuple[str, ...], side: str) -> DataFrame:
    """Runs as few spans: consecutive episodes of a season, then consecutive seasons with equal episodes. Columns: keys, span,
    season_start, season_end, episode_start, episode_end."""
    w = Window.partitionBy(*keys).orderBy("at")
    rows = runs.select(*keys, F.col(f"{side}_at").alias("at"), F.col(f"{side}_season").alias("s"), F.col(f"{side}_episode").alias("e"))
    first = islands(rows, keys, "at", ~((F.col("s") == F.lag("s").over(w)) & (F.col("e") == F.lag("e").over(w) + 1)), "part")
    parts = first.groupBy(*keys, "part").agg(F.first("s").alias("s"), F.min("e").alias("e0"), F.max("e").alias("e1"))
    v = Window.partitionBy(*keys).orderBy("part")
    merged = islands(parts, keys, "part", ~((F.col("s") == F.lag("s").over(v) + 1) & (F.col("e0") == F.lag("e0").over(v)) & (F.col("e1") == F.lag("e1").over(v))), "span")
    return merged.groupBy(*keys, "span").agg(F.min("s").alias("season_start"), F.max("s").alias("season_end"), F.min("e0").alias("episode_start"), F.max("e1").alias("episode_end"))


def run_expressions(runs: DataFrame, keys: tuple[str, ...], side: str, reference: Column, context: Column | None = None) -> DataFrame:
    """keys and the expression that selects a run's episodes in the order ``reference``; contexts stand before the numbers."""
    between = lambda a, b: F.when(F.col(a) == F.col(b), F.col(a).cast("string")).otherwise(F.concat(F.col(a).cast("string"), F.lit(".."), F.col(b).cast("string")))
    said = F.concat(F.lit("season="), between("season_start", "season_end"), F.lit(",episode="), between("episode_start", "episode_end"))
    said = said if context is None else F.concat_ws(",", context, said)
    rows = spans(runs, keys, side).select(*keys, "span", F.concat(reference, F.lit(" :: "), said).alias("x"))
    parts = rows.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("span", "x"))), lambda p: p["x"]).alias("parts"))
    return parts.select(*keys, F.when(F.size("parts") == 1, F.element_at("parts", 1)).otherwise(F.concat(F.lit("["), F.array_join("parts", ","), F.lit("]"))).alias("expression"))


def aligned_statements(left: DataFrame, right: DataFrame, parent: str = "parent") -> DataFrame:
    """parent, run and the statement that each run of matched episodes gives. A column ``context`` of an order, such as order=aired,
    stands before the numbers."""
    runs = episode_runs(left, right, (parent,))
    sides = []
    for s, d in (("left", left), ("right", right)):
        context = F.min("context") if "context" in d.columns else F.lit(None).cast("string")
        rows = runs.join(d.groupBy(parent).agg(F.min("order_ref").alias("__o"), context.alias("__c")), parent)
        sides.append(run_expressions(rows, (parent, "run", "__o", "__c"), s, F.col("__o"), F.col("__c")).select(parent, "run", F.col("expression").alias(s)))
    return sides[0].join(sides[1], [parent, "run"]).select(parent, "run", F.concat("left", F.lit(" <=> "), "right").alias("statement"))
