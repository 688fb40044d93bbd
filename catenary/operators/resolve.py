"""Resolving expressions against catalogs and compiling statements to correspondences.

``selections``: claim_id, side, leaf (place of the selection in its side), path array<int>, reference, extent, recursive, dynamic,
predicates array<struct<dimension, kind, items, low, high>>. Catalog tables are those of ``catalog``: units, entities, domain. All
statements are resolved in one plan; what cannot be resolved is a row of errors (claim_id, kind, message), kind ``Unresolved`` or
``Invalid``, and takes nothing of other statements with it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.claims import parsed
from ..session import Cut
from .align import align_extents, tails, zip_members
from .graph import correspondences
from .semantics import evaluate, resolution_violations

#: Members of a statement, and bytes of a name, at most.
MOST_MEMBERS, MOST_BYTES = 100_000, 4096
SELECTION = ["claim_id", "side", "leaf"]


def selections(statements: DataFrame, text: str = "statement") -> DataFrame:
    """The selections of statements (canonical texts, which give their ids), one row for each; texts that are none give no row."""
    rows = statements.select(parsed()(F.col(text)).alias("p")).where("p.ok").select("p.claim_id", "p.operator", F.posexplode("p.selections").alias("n", "s"))
    return rows.select("claim_id", "operator", "s.side", F.col("n").alias("leaf"), "s.path", "s.reference", "s.extent", "s.recursive", "s.dynamic", "s.predicates").distinct()


def _error(rows: DataFrame, kind: str, message: Column) -> DataFrame:
    return rows.select("claim_id", F.lit(kind).alias("kind"), message.alias("message"))


def resolve(asked: DataFrame, units: DataFrame, entities: DataFrame, domain: DataFrame) -> tuple[DataFrame, DataFrame]:
    """members (claim_id, side, leaf, place, reference, extent, coordinate, ordered, dynamic) and errors.

    The level is the last one that the selector names and that has units, else the last; contexts that are not named have their
    default. A predicate chooses among the values that occur with the other scalars and sets; a bound or value that does not occur is
    unresolved, a reversed range gives its units in reverse. Units are in order of their levels' values, then level and reference.
    """
    keys = [*SELECTION, "reference"]
    known = asked.join(entities.withColumnRenamed("entity", "reference"), "reference", "left")
    absent = _error(known.where("levels IS NULL"), "Unresolved", F.concat("reference", F.lit(" is absent")))
    known = known.where("levels IS NOT NULL")
    plain = known.where(~F.col("recursive") & (F.size("predicates") == 0))
    bare = plain.select(*SELECTION, F.lit(0).alias("place"), F.col("reference").alias("unit"), "extent", F.lit(None).cast("string").alias("coordinate"), F.lit(True).alias("ordered"), "dynamic")
    some = known.where(F.col("recursive") | (F.size("predicates") > 0))
    names = F.transform("predicates", lambda p: p["dimension"])
    is_context = lambda d: F.map_contains_key("contexts", d)
    odd = some.withColumn("odd", F.filter(names, lambda d: ~F.array_contains("levels", d) & ~is_context(d)))
    multiple = F.exists("predicates", lambda p: is_context(p["dimension"]) & (p["kind"] != "scalar"))
    errors = [
        absent,
        _error(some.where(F.col("recursive") & ~F.col("complete")), "Unresolved", F.concat(F.lit("the hierarchy is incomplete: "), "reference")),
        _error(odd.where(F.size("odd") > 0), "Invalid", F.concat(F.lit("no such dimension: "), F.get("odd", F.lit(0)))),
        _error(some.where(multiple), "Invalid", F.lit("a context takes one value")),
        _error(some.where(~F.col("recursive") & (F.size("levels") == 0)), "Invalid", F.lit("the entity has no units")),
    ]
    good = odd.where((F.size("odd") == 0) & ~multiple & (~F.col("recursive") | F.col("complete")) & (F.size("levels") > 0)).drop("odd")
    levels_with_units = units.groupBy("entity").agg(F.collect_set("level").alias("filled")).withColumnRenamed("entity", "reference")  # as many as there are levels
    good = good.join(levels_with_units, "reference", "left")
    named = F.filter("levels", lambda d: F.array_contains(names, d) & F.coalesce(F.array_contains("filled", d), F.lit(False)))
    good = good.withColumn("level", F.when(~F.col("recursive"), F.coalesce(F.when(F.size(named) > 0, F.get(named, F.size(named) - 1)), F.get("levels", F.size("levels") - 1))))
    chosen = F.map_from_entries(F.transform(F.filter("predicates", lambda p: is_context(p["dimension"])), lambda p: F.struct(p["dimension"], F.get(p["items"], F.lit(0)))))
    good = good.withColumn("context", F.map_concat(F.map_filter("contexts", lambda k, _: ~F.array_contains(names, k)), chosen)).drop("contexts", "filled", "complete", "operator", "path")
    good = Cut(good, "asked").df
    # contexts must have the value that is asked for
    asks = good.select("claim_id", "reference", F.explode("context").alias("dimension", "value")).join(domain.select(F.col("entity").alias("reference"), "dimension", "value"), ["reference", "dimension", "value"], "left_anti")
    authored = good.select("claim_id", "reference", F.explode(names).alias("dimension"))
    errors.append(_error(asks.join(authored, ["claim_id", "reference", "dimension"], "left_semi"), "Unresolved", F.concat_ws("=", "dimension", "value")))

    fits = (F.col("level").isNull() | (F.col("u.level") == F.col("level"))) & F.forall(F.map_keys("context"), lambda k: F.coalesce(F.col("u.attributes")[k], F.lit("")) == F.col("context")[k])
    own = units.select(F.col("entity").alias("reference"), F.struct("reference", "level", "attributes", "coordinate").alias("u"))
    candidates = good.join(own, "reference").where(fits)
    # one row for each level of each candidate, with the predicate on it if there is one
    per_level = candidates.select(*keys, "u", F.posexplode("levels").alias("depth", "dimension"), "predicates").withColumn("p", F.get(F.filter("predicates", lambda p: p["dimension"] == F.col("dimension")), F.lit(0))).drop("predicates")
    per_level = per_level.withColumn("value", F.col("u.attributes")[F.col("dimension")]).join(domain.select(F.col("entity").alias("reference"), "dimension", "value", "position"), ["reference", "dimension", "value"], "left")
    direct = F.coalesce(F.col("p.kind").isin("scalar", "set"), F.lit(False))
    hit = F.coalesce(F.array_contains("p.items", F.col("value")), F.lit(False))
    unit = Window.partitionBy(*keys, "u.reference", "u.level", "u.coordinate")  # as many rows as there are levels
    per_level = per_level.withColumn("misses", F.count_if(direct & ~hit).over(unit)).withColumn("present", (F.col("misses") - F.when(direct & ~hit, 1).otherwise(0) == 0) & F.col("value").isNotNull())
    per_level = Cut(per_level, "levels").df
    at = lambda c: F.max(F.when(F.col("present") & (F.col("value") == F.col(c)), F.col("position")))
    bounds = per_level.where("p IS NOT NULL").groupBy(*keys, "dimension").agg(
        F.first("p").alias("p"), F.count_distinct(F.when(F.col("present") & hit, F.col("value"))).alias("found"), at("p.low").alias("lo"), at("p.high").alias("hi"),
        F.min(F.when(F.col("present"), F.col("position"))).alias("least"), F.max(F.when(F.col("present"), F.col("position"))).alias("most"),
    )
    lacking = (
        (F.col("p.kind").isin("scalar", "set") & (F.col("found") < F.size(F.array_distinct("p.items"))))
        | ((F.col("p.kind") == "range") & ((F.col("p.low").isNotNull() & F.col("lo").isNull()) | (F.col("p.high").isNotNull() & F.col("hi").isNull()) | F.col("least").isNull()))
    )
    errors.append(_error(bounds.where(lacking), "Unresolved", F.concat("dimension", F.lit(" has no such value"))))
    spans = bounds.select(*keys, "dimension", F.coalesce("lo", "least").alias("lo"), F.coalesce("hi", "most").alias("hi"), lacking.alias("lacking"))
    rows = per_level.join(spans, [*keys, "dimension"], "left")
    passes = F.when(F.col("p").isNull(), True).when(F.col("value").isNull() | F.col("lacking"), False).when(direct, hit).when(F.col("p.kind") == "range", F.col("position").between(F.least("lo", "hi"), F.greatest("lo", "hi"))).otherwise(True)
    rank = F.when(F.col("p.kind") == "set", F.array_position("p.items", F.col("value"))).when((F.col("p.kind") == "range") & (F.col("lo") > F.col("hi")), -F.col("position")).otherwise(F.col("position"))
    kept = rows.groupBy(*keys, "u.reference", "u.level", "u.coordinate").agg(F.bool_and(passes).alias("ok"), F.count_if(F.col("depth") == 0).alias("times"), F.array_sort(F.collect_list(F.struct("depth", F.coalesce(rank, F.lit(-(1 << 40))).alias("rank")))).alias("ranks"))
    kept = kept.where("ok").toDF(*keys, "unit", "level", "coordinate", "ok", "times", "ranks")
    order = Window.partitionBy(*SELECTION).orderBy(F.transform("ranks", lambda r: r["rank"]), "level", "unit")  # bounded by MOST_MEMBERS, checked when compiled
    placed = Cut(kept.withColumn("place", F.row_number().over(order) - 1).select(*SELECTION, "place", "unit", "coordinate", "times"), "placed").df
    unordered = F.exists("predicates", lambda p: (p["kind"] == "set") & (F.size(p["items"]) > 1))
    found = placed.join(good.select(*SELECTION, "extent", "recursive", "dynamic", (~unordered).alias("ordered")), SELECTION)
    errors.append(_error(found.groupBy(*SELECTION, F.col("coordinate").alias("c")).agg(F.sum("times").alias("n")).where("n > 1"), "Invalid", F.lit("ambiguous coordinates")))
    errors.append(_error(good.join(placed.select(*SELECTION).distinct(), SELECTION, "left_anti"), "Unresolved", F.concat("reference", F.lit(" selects no units"))))
    members = found.select(*SELECTION, "place", "unit", "extent", F.when(F.col("recursive"), F.col("coordinate")).alias("coordinate"), "ordered", "dynamic").unionByName(bare)
    return members.withColumnRenamed("unit", "reference"), reduce(DataFrame.unionByName, errors).distinct()


def expressions(asked: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The members of whole sides: claim_id, side, ordinal (from 0), reference, extent, coordinate; and the sides: claim_id, operator,
    side, members, ordered, dynamic, total, extents, coordinates.

    A composite is ordered if each child is ordered or single. Where any of its children is recursive, coordinates begin with the
    child's number, and a member of a child that is not has its place there instead (@0, @1, ...).
    """
    side = ["claim_id", "side"]
    leaves = asked.select(*SELECTION, "path", "recursive")
    prefixes = leaves.select(*side, "leaf", "recursive", F.explode(F.transform(F.sequence(F.lit(0), F.size("path")), lambda n: F.slice("path", F.lit(1), n))).alias("prefix"))
    marks = prefixes.groupBy(*side, "prefix").agg(F.bool_or("recursive").alias("deep"))
    first = prefixes.join(marks, [*side, "prefix"]).groupBy(*SELECTION).agg(F.min(F.when(~F.col("deep"), F.size("prefix"))).alias("flat"))
    rows = members.join(leaves, SELECTION).join(first, SELECTION)
    rows = rows.withColumn("prefix", F.when(F.col("flat").isNotNull(), F.slice("path", F.lit(1), F.col("flat"))).otherwise(F.col("path")))
    at = F.row_number().over(Window.partitionBy(*side, "prefix").orderBy("leaf", "place")) - 1
    steps = F.array_join(F.transform("prefix", lambda i: i.cast("string")), "/")
    coordinate = F.when(F.col("flat") == 0, None).when(F.col("flat").isNull(), F.when(F.size("path") == 0, F.col("coordinate")).otherwise(F.concat_ws("/", steps, "coordinate"))).otherwise(F.concat(steps, F.lit("/@"), at.cast("string")))
    whole = rows.withColumn("coordinate", coordinate).withColumn("ordinal", F.row_number().over(Window.partitionBy(*side).orderBy("leaf", "place")) - 1)
    whole = whole.select(*side, "ordinal", "reference", F.col("extent").cast("decimal(38,0)").alias("extent"), "coordinate", "leaf", "ordered", "dynamic")
    of_leaf = whole.groupBy(*side, "leaf").agg((F.bool_and("ordered") | (F.count("*") == 1)).alias("leaf_ordered"), F.bool_and("ordered").alias("own"), F.max("dynamic").alias("dynamic"))
    of_side = of_leaf.groupBy(*side).agg(F.when(F.count("*") == 1, F.bool_and("own")).otherwise(F.bool_and("leaf_ordered")).alias("ordered"), F.bool_or("dynamic").alias("dynamic"))
    in_order = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("ordinal", c))), lambda x: x[c])
    sums = whole.groupBy(*side).agg(F.count("*").alias("members"), F.sum("extent").cast("decimal(38,0)").alias("total"), in_order("extent").alias("extents"), in_order("coordinate").alias("coordinates"))
    sums = sums.withColumn("coordinates", F.filter("coordinates", lambda c: c.isNotNull()))
    operators = asked.select("claim_id", "operator").distinct()
    return whole.select(*side, "ordinal", "reference", "extent", "coordinate"), sums.join(of_side, side).join(operators, "claim_id")


def compiled(asked: DataFrame, units: DataFrame, entities: DataFrame, domain: DataFrame, captured: tuple[str, ...] | None = None, most: int = MOST_MEMBERS) -> dict[str, DataFrame]:
    """What statements say, as tables: ``verdicts`` (claim_id, verdict: valid, or the first error), ``edges`` (of exact, ordered
    coverage and implication), ``groups`` (unordered coverage: claim_id, side, unit), ``tails`` (what is left over of each side).

    With ``captured`` (sources whose revisions are known) a statement that names another source is ``InvalidCapture``; one with more
    than ``most`` members or a longer name than ``MOST_BYTES`` is ``LimitExceeded``; neither gives anything else.
    """
    members, errors = (Cut(d, "resolved").df for d in resolve(asked, units, entities, domain))
    counts = members.groupBy("claim_id").agg(F.count("*").alias("n"), F.max(F.octet_length("reference")).alias("bytes"))
    beyond = _error(counts.where((F.col("n") > most) | (F.col("bytes") > MOST_BYTES)), "LimitExceeded", F.lit("too many members or too long a name"))
    foreign = asked.where(F.lit(False)) if captured is None else asked.where(~F.substring_index("reference", "://", 1).isin(*captured))
    early = _error(foreign, "InvalidCapture", F.lit("a source's revision is missing")).unionByName(beyond).unionByName(errors).distinct()
    whole, sides = expressions(asked, members.join(early.select("claim_id").distinct(), "claim_id", "left_anti"))
    whole, sides = Cut(whole, "whole").df, Cut(sides, "sides").df
    late = resolution_violations(whole)
    judged = evaluate(sides.join(late.select("claim_id").distinct(), "claim_id", "left_anti"))
    said = F.concat("kind", F.lit(": "), "message")
    refused = early.unionByName(late).groupBy("claim_id").agg(F.min(said).alias("verdict"))
    verdicts = judged.select("claim_id", "verdict").unionByName(refused)
    valid = judged.where("verdict = 'valid'").select("claim_id", "positional")
    good = Cut(whole.join(valid, "claim_id").join(sides.select("claim_id", "operator").distinct(), "claim_id"), "valid").df
    left, right = (good.where((F.col("side") == n) & F.col("positional")).select("claim_id", "ordinal", "extent", F.col("reference").alias("unit"), "operator") for n in (0, 1))
    name = lambda d, p: d.select("claim_id", F.col("ordinal").alias(f"{p}_ordinal"), F.col("unit").alias(p), F.col("extent").alias(f"{p}_extent"))
    exact = zip_members(*(d.where("operator = '<=>'").select("claim_id", "ordinal", "unit") for d in (left, right))).select("claim_id", F.col("left_unit").alias("left"), F.col("right_unit").alias("right"))
    whole_unit = [F.lit(x).alias(n) for n, x in (("left_start", "0/1"), ("left_end", "1/1"), ("right_start", "0/1"), ("right_end", "1/1"))]
    edges = exact.select("claim_id", F.lit("<=>").alias("operator"), "left", "right", *whole_unit)
    shared = align_extents(*(d.where("operator <> '<=>'").select("claim_id", "ordinal", "extent") for d in (left, right)))
    segments = shared.join(name(left, "left"), ["claim_id", "left_ordinal"]).join(name(right, "right"), ["claim_id", "right_ordinal"])
    operators = good.select("claim_id", "operator").distinct()
    edges = edges.unionByName(correspondences(operators, segments).select(*edges.columns))
    groups = good.where("operator = '<~>' AND NOT positional").select("claim_id", "side", F.col("reference").alias("unit"))
    rest = tails(*(good.where(F.col("side") == n).select("claim_id", "ordinal", "extent") for n in (0, 1)))
    return {"verdicts": verdicts, "edges": edges, "groups": groups, "tails": rest, "members": whole}
