"""Candidate claims with their evidence: explicit identifiers, shared identifiers, equal titles and years."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.claims import bare_claim, claim_id

#: Records in a title block from which it says too little to compare in.
HOT = 256


def explicit_supports(facts: DataFrame) -> DataFrame:
    """A claim between each record and what each of its identifiers names, ingested or not."""
    named = facts.select("uri", "source", "key", "revision", F.explode("identifiers").alias("i"))
    claim = bare_claim(F.col("uri"), F.col("i.target"))
    evidence = F.array(F.struct("source", "key", "revision", F.col("i.field").alias("field"), F.col("i.target").alias("value")))
    return named.where("uri <> i.target").select(claim.alias("statement"), F.lit("explicit-identifier").alias("method"), evidence.alias("inputs"))


def hot_scopes(blocks: DataFrame, most: int = HOT) -> DataFrame:
    """Title scopes with more than ``most`` records: diagnostics, and not compared in."""
    return blocks.where(F.col("scope").startswith("title:")).groupBy("scope").agg(F.count("*").alias("members")).where(F.col("members") > most)


def block_pairs(blocks: DataFrame, facts: DataFrame, most: int = HOT) -> DataFrame:
    """Pairs of records of two sources in a common scope and of equal kind (a unit goes with any).

    Scopes of titles with more than ``most`` records say too little: they are counted by key and left out before anything is
    paired, and ``hot_scopes`` reports them. Scopes of identifiers are all paired; one with more than ``most`` records, which would
    give pairs without end, gives each record's pair with the first record (by uri) of each other source that it may go with, so
    that all of them stay linked and the pairs grow with the records.
    """
    side = facts.select("uri", "source", "key", "revision", "kind")
    counted = blocks.groupBy("scope").agg(F.count("*").alias("members")).where(F.col("members") > most).select("scope", F.lit(True).alias("__large"))
    rows = blocks.join(counted, "scope", "left").where(F.col("__large").isNull() | F.col("scope").startswith("id:")).join(side, "uri")
    named = lambda d, p: d.select("scope", *[F.col(c).alias(f"{p}_{c}") for c in side.columns])
    alike = (F.col("a_kind") == F.col("b_kind")) | (F.col("a_kind") == "unit") | (F.col("b_kind") == "unit")
    small, large = rows.where("__large IS NULL"), rows.where("__large")
    pairs = named(small, "a").join(named(small, "b"), "scope").where((F.col("b_uri") > F.col("a_uri")) & (F.col("a_source") != F.col("b_source")) & alike)
    first = large.groupBy("scope", "source", "kind").agg(F.min(F.struct("uri", "source", "key", "revision", "kind")).alias("f")).select("scope", "f.*")  # few for each scope
    to_first = named(large, "a").join(named(first, "b"), "scope").where((F.col("a_source") != F.col("b_source")) & alike)
    ends = lambda x, y: [F.when(F.col("a_uri") < F.col("b_uri"), F.col(f"{x}_{c}")).otherwise(F.col(f"{y}_{c}")).alias(f"{p}_{c}") for p, x, y in ((x, x, y),) for c in side.columns]
    ordered = to_first.select("scope", *ends("a", "b"), *ends("b", "a")).distinct()
    return pairs.unionByName(ordered)


def pair_supports(blocks: DataFrame, facts: DataFrame, most: int = HOT) -> DataFrame:
    """Evidence of pairs: ``shared-identifier`` from id scopes, ``title-year`` from title scopes."""
    pairs = block_pairs(blocks, facts, most)
    by_id = F.col("scope").startswith("id:")
    one = lambda p: F.struct(F.col(f"{p}_source").alias("source"), F.col(f"{p}_key").alias("key"), F.col(f"{p}_revision").alias("revision"), F.when(by_id, "identifier").otherwise("title").alias("field"), F.regexp_replace("scope", "^(id|title):", "").alias("value"))
    return pairs.select(bare_claim(F.col("a_uri"), F.col("b_uri")).alias("statement"), F.when(by_id, "shared-identifier").otherwise("title-year").alias("method"), F.array(one("a"), one("b")).alias("inputs"))


def with_ids(rows: DataFrame, engine: str = "1") -> DataFrame:
    """Supports (claim_id, statement, method, inputs) once each, with id: a hash of all they say."""
    said = F.to_json(F.struct(F.lit(engine).alias("engine"), "claim_id", "method", "inputs"))
    return rows.withColumn("id", F.sha2(said, 256)).dropDuplicates(["id"])


def identified(rows: DataFrame, engine: str = "1") -> DataFrame:
    """Supports of bare statements (statement, method, inputs), with claim_id and id."""
    return with_ids(rows.withColumn("claim_id", claim_id(F.col("statement"))), engine)


def supports(facts: DataFrame, blocks: DataFrame, engine: str = "1", most: int = HOT) -> DataFrame:
    """Every support once: id, claim_id, statement, method, inputs."""
    return identified(explicit_supports(facts).unionByName(pair_supports(blocks, facts, most)), engine)


def candidates(found: DataFrame, decisions: DataFrame | None = None) -> DataFrame:
    """Claims with the number of their supports, in all and by method, and the decision in force."""
    counted = found.groupBy("claim_id", "statement").agg(
        F.count("*").alias("supports"), F.count_if(F.col("method") == "explicit-identifier").alias("explicit"), F.count_if(F.col("method") == "shared-identifier").alias("shared"), F.count_if(F.col("method") == "title-year").alias("titled")
    )
    return counted if decisions is None else counted.join(decisions, "claim_id", "left")


def current_supports(found: DataFrame, current: DataFrame) -> DataFrame:
    """Supports all of whose inputs are the current, undeleted versions of their records."""
    live = current.where(~F.col("deleted")).select("source", "key", "revision")
    stale = found.select("id", F.explode("inputs").alias("i")).select("id", "i.source", "i.key", "i.revision").join(live, ["source", "key", "revision"], "left_anti").select("id").distinct()
    return found.join(stale, "id", "left_anti")


def with_input(found: DataFrame, field: str, value: str | None = None) -> DataFrame:
    """Supports one of whose inputs says ``value``, or anything, in ``field``."""
    return found.where(F.exists("inputs", lambda i: (i["field"] == field) & (F.lit(value is None) | (i["value"] == value))))


def evidence_json(found: DataFrame) -> DataFrame:
    """claim_id and its supports as JSON, in order of their ids; a claim has a bounded number of inputs per pair of records."""
    entry = F.struct("id", "method", "inputs")
    return found.groupBy("claim_id").agg(F.to_json(F.array_sort(F.collect_list(entry))).alias("evidence"))


def status(**tables: DataFrame) -> DataFrame:
    """name and number of rows of each table."""
    parts = [t.agg(F.count("*").alias("rows")).select(F.lit(n).alias("name"), "rows") for n, t in sorted(tables.items())]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def newest(rows: DataFrame, keys: tuple[str, ...], order: list[Column], keep: int) -> DataFrame:
    """The first ``keep`` rows of each key in an order. A group limit is pushed before the shuffle, so a hot key sends at most
    ``keep`` rows from each partition."""
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("__n") <= keep).drop("__n")
