"""Resolving selectors against catalogs and judging statements.

Catalog tables: ``units`` (entity, reference, level, attributes map<string,string>, coordinate), ``dimensions`` (entity, dimension,
value, position). Questions come as tables too, so that any number of claims is resolved in one plan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

MAX_EXTENT = "18446744073709551615"


def ranked_domain(values: DataFrame, keys: tuple[str, ...] = ("entity", "dimension"), value: str = "value") -> DataFrame:
    """The distinct values of each dimension in order: numbers by size, then other texts by bytes. Adds position from 1."""
    number = F.col(value).try_cast("decimal(38,0)")
    digits = F.when(F.col(value).rlike("^[0-9]+$"), number)
    w = Window.partitionBy(*keys).orderBy(digits.asc_nulls_last(), F.col(value))
    return values.select(*keys, value).distinct().withColumn("position", F.row_number().over(w))


def select_units(units: DataFrame, domain: DataFrame, predicates: DataFrame) -> DataFrame:
    """The units that satisfy all predicates of a question, in the order the question asks for.

    ``predicates``: question, entity, level, dimension, kind (scalar, set, range, wildcard), items array<string>, low, high. A
    reversed range gives its units in reverse. Adds ordinal from 1. Scalars, sets and bounds that the domain lacks select nothing.
    """
    place = lambda n: domain.select("entity", "dimension", F.col("value").alias(n), F.col("position").alias(f"{n}_at"))
    asked = predicates.withColumn("__dimensions", F.count("*").over(Window.partitionBy("question")))
    asked = asked.join(place("low"), ["entity", "dimension", "low"], "left").join(place("high"), ["entity", "dimension", "high"], "left")
    flat = units.select("entity", "level", "reference", F.explode("attributes").alias("dimension", "value")).join(domain, ["entity", "dimension", "value"])
    lo, hi = F.coalesce("low_at", F.when(F.col("low").isNull(), F.lit(0))), F.coalesce("high_at", F.when(F.col("high").isNull(), F.lit(2**31 - 1)))
    fits = (
        F.when(F.col("kind").isin("scalar", "set"), F.array_contains("items", F.col("value")))
        .when(F.col("kind") == "range", F.col("position").between(F.least(lo, hi), F.greatest(lo, hi)))
        .otherwise(F.lit(True))
    )
    rows = flat.join(asked, ["entity", "level", "dimension"]).where(fits).withColumn("__rank", F.when((F.col("kind") == "range") & (lo > hi), -F.col("position")).otherwise(F.col("position")))
    found = rows.groupBy("question", "entity", "reference").agg(F.count("*").alias("n"), F.first("__dimensions").alias("__dimensions"), F.array_sort(F.collect_list(F.struct("dimension", F.col("__rank").alias("rank")))).alias("ranks"))
    order = Window.partitionBy("question").orderBy(F.transform("ranks", lambda r: r["rank"]), "reference")
    return found.where("n = __dimensions").select("question", "entity", "reference", F.row_number().over(order).alias("ordinal"))


def ordered_units(units: DataFrame, ranks: dict[str, str], keys: tuple[str, ...] = ("entity",)) -> DataFrame:
    """Units numbered by the ranks of their attributes (a missing one first), then level, then reference. ``ranks``: column of the
    rank by level, from the outermost on."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in ranks.values()], "level", "reference")
    return units.withColumn("ordinal", F.row_number().over(w))


def resolution_violations(members: DataFrame) -> DataFrame:
    """claim_id, kind and message of sides that cannot stand. ``members``: claim_id, side, ordinal, reference, extent, coordinate."""
    side = ["claim_id", "side"]
    checks = [
        members.groupBy(*side, "reference").agg(F.count("*").alias("n")).where("n > 1").select("claim_id", F.lit("Invalid").alias("kind"), F.concat(F.lit("unit repeats: "), "reference").alias("message")),
        members.where("coordinate IS NOT NULL").groupBy(*side, "coordinate").agg(F.count("*").alias("n")).where("n > 1").select("claim_id", F.lit("Invalid").alias("kind"), F.concat(F.lit("coordinate repeats: "), "coordinate").alias("message")),
        members.where(~F.col("reference").contains("://")).select("claim_id", F.lit("Invalid").alias("kind"), F.concat(F.lit("no reference: "), "reference").alias("message")),
        members.groupBy(*side).agg(F.sum(F.col("extent").cast("decimal(38,0)")).alias("total")).where(F.col("total") > F.lit(MAX_EXTENT).cast("decimal(38,0)")).select("claim_id", F.lit("Invalid").alias("kind"), F.lit("extent too large").alias("message")),
    ]
    return reduce(DataFrame.unionByName, checks).distinct()


def evaluate(sides: DataFrame) -> DataFrame:
    """claim_id, verdict (valid or why not), positional, unmapped_left, unmapped_right.

    ``sides``: claim_id, operator, side (0 left, 1 right), members (count), ordered, dynamic, total, extents array, coordinates
    array (empty if not recursive). Positional: both sides ordered, or both single.
    """
    pick = lambda n: sides.where(F.col("side") == n).select("claim_id", "operator", *[F.col(c).alias(f"{c}_{n}") for c in ("members", "ordered", "dynamic", "total", "extents", "coordinates")])
    both = pick(0).join(pick(1).drop("operator"), "claim_id")
    positional = (F.col("ordered_0") & F.col("ordered_1")) | ((F.col("members_0") == 1) & (F.col("members_1") == 1))
    closed = ~F.col("dynamic_0") & ~F.col("dynamic_1")
    unequal = F.col("total_0") != F.col("total_1")
    verdict = (
        F.when((F.col("members_0") == 0) | (F.col("members_1") == 0), "Unresolved: no units")
        .when((F.col("operator") == "<=>") & (F.col("members_0") != F.col("members_1")), "Invalid: counts differ")
        .when((F.col("operator") == "<=>") & ~positional, "Invalid: no common order")
        .when((F.col("operator") == "<=>") & (F.col("extents_0") != F.col("extents_1")), "Invalid: extents differ")
        .when((F.col("operator") == "<=>") & (F.col("coordinates_0") != F.col("coordinates_1")), "Invalid: coordinates differ")
        .when((F.col("operator") == "=>") & ~positional, "Invalid: no common order")
        .when((F.col("operator") != "<=>") & unequal & (closed | ~positional), "Invalid: totals differ")
        .otherwise("valid")
    )
    shared = F.least("total_0", "total_1")
    return both.select("claim_id", verdict.alias("verdict"), positional.alias("positional"), (F.col("total_0") - shared).alias("unmapped_left"), (F.col("total_1") - shared).alias("unmapped_right"))
