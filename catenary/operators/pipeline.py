"""Keeping evidence up to date as records change, and what reviews change: incremental forms of linking and of decisions.

State is a set of tables: ``facts``, ``blocks``, ``supports`` (of ``facts`` and ``link``), ``projected`` (source, key, revision, engine).
A step recomputes what changed records touch and keeps all else: the result equals a computation from scratch.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.claims import parsed
from ..session import Cut
from . import link as L
from .align import aligned_statements, episode_runs, order_violations
from .facts import TMDB, TVDB, blocks, project

#: Revision of the linking rules; results of another engine are computed anew.
ENGINE = "1"


def dirty_records(live: DataFrame, projected: DataFrame, engine: str = ENGINE) -> DataFrame:
    """source and key of records that are new, gone, at another revision or projected by another engine."""
    old = projected.select("source", "key", F.col("revision").alias("old"), F.col("engine").alias("by"))
    both = live.select("source", "key", "revision").join(old, ["source", "key"], "full_outer")
    return both.where(~F.col("revision").eqNullSafe(F.col("old")) | (F.col("by") != engine)).select("source", "key")


def touched(found: DataFrame, records: DataFrame) -> DataFrame:
    """ids of supports with an input of one of the records (source, key)."""
    inputs = found.select("id", F.explode("inputs").alias("i")).select("id", "i.source", "i.key")
    return inputs.join(records, ["source", "key"], "left_semi").select("id").distinct()


def scope_of(found: DataFrame) -> Column:
    """The scope that a support of a pair comes from; null for others."""
    said = F.get("inputs", F.lit(0))["value"]
    return F.when(F.col("method") == "shared-identifier", F.concat(F.lit("id:"), said)).when(F.col("method") == "title-year", F.concat(F.lit("title:"), said))


def started(live: DataFrame, engine: str = ENGINE, most: int = L.HOT) -> dict[str, DataFrame]:
    """The state computed from scratch."""
    facts = Cut(project(live), "facts").df
    scopes = Cut(blocks(facts), "blocks").df
    return {"facts": facts, "blocks": scopes, "supports": L.supports(facts, scopes, engine, most), "projected": live.select("source", "key", "revision", F.lit(engine).alias("engine"))}


def reprojected(state: dict[str, DataFrame], live: DataFrame, engine: str = ENGINE, most: int = L.HOT) -> dict[str, DataFrame]:
    """The state after records changed, and ``withdrawn``: the supports that were given up.

    Facts of changed records are projected anew. Supports with a changed record among their inputs are withdrawn, and so are those of
    pairs in the scopes that a changed record is or was in, whose pairs are then made anew; so a title block that became too large
    loses its pairs, and one that shrank gets them.
    """
    dirty = Cut(dirty_records(live, state["projected"], engine), "dirty").df
    fresh = Cut(project(live.join(dirty, ["source", "key"], "left_semi")), "fresh").df
    stale = state["facts"].join(dirty, ["source", "key"], "left_semi").select("uri")
    facts = state["facts"].join(dirty, ["source", "key"], "left_anti").unionByName(fresh)
    fresh_blocks = blocks(fresh)
    scopes = Cut(state["blocks"].join(stale, "uri", "left_semi").select("scope").union(fresh_blocks.select("scope")).distinct(), "scopes").df
    all_blocks = Cut(state["blocks"].join(stale, "uri", "left_anti").unionByName(fresh_blocks), "blocks").df
    old = state["supports"].withColumn("scope", scope_of(state["supports"]))
    gone = Cut(touched(state["supports"], dirty).union(old.join(scopes, "scope", "left_semi").select("id")).distinct(), "gone").df
    made = L.explicit_supports(fresh).unionByName(L.pair_supports(all_blocks.join(scopes, "scope", "left_semi"), facts, most))
    kept = state["supports"].join(gone, "id", "left_anti")
    found = kept.unionByName(L.identified(made, engine).select(*kept.columns)).dropDuplicates(["id"])
    projected = live.select("source", "key", "revision", F.lit(engine).alias("engine"))
    return {"facts": facts, "blocks": all_blocks, "supports": found, "projected": projected, "withdrawn": state["supports"].join(gone, "id", "left_semi").join(found.select("id"), "id", "left_anti")}


def bumped(candidates: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """Candidates (claim_id, statement, revision) with a revision more for each support that came or went; new claims are added with
    theirs, and claims whose supports all went stay."""
    gone = before.join(after.select("id"), "id", "left_anti").select("claim_id", "statement")
    come = after.join(before.select("id"), "id", "left_anti").select("claim_id", "statement")
    steps = gone.unionByName(come).groupBy("claim_id", "statement").agg(F.count("*").alias("steps"))
    both = candidates.select("claim_id", F.col("statement").alias("known"), "revision").join(steps, "claim_id", "full_outer")
    return both.select("claim_id", F.coalesce("known", "statement").alias("statement"), (F.coalesce("revision", F.lit(0)) + F.coalesce("steps", F.lit(0))).alias("revision"))


def pending_consumers(consumers: DataFrame, sources: DataFrame) -> DataFrame:
    """source of consumers that have not read all: still at their first scan, within a page, or behind the source's revision."""
    both = consumers.join(sources.select("source", F.col("revision").alias("head")), "source")
    return both.where(F.col("bootstrap") | F.col("after_key").isNotNull() | (F.col("revision") < F.col("head"))).select("source")


def in_prefix(column: Column, prefix: str) -> Column:
    """Texts that begin with a prefix, as a range of bytes that a scan can use."""
    return (column >= prefix) & (column < prefix[:-1] + chr(ord(prefix[-1]) + 1))


def touched_claims(decisions: DataFrame, claim_endpoints: DataFrame, uris: DataFrame) -> DataFrame:
    """claim_id and version of accepted claims with one of the uris (uri) among their endpoints (claim_id, uri)."""
    claims = claim_endpoints.join(uris.select("uri").distinct(), "uri", "left_semi").select("claim_id").distinct()
    return decisions.where("action = 'accepted'").join(claims, "claim_id", "left_semi").select("claim_id", "version")


def queued_scopes(claims: DataFrame, policy_claims: DataFrame) -> DataFrame:
    """scope of the work that changed records give: hierarchies under touched claims, and claims whose policy is to be judged anew."""
    name = lambda d, prefix: d.select(F.concat(F.lit(prefix), "claim_id").alias("scope"))
    return name(claims, "parent:").union(name(policy_claims, "policy:")).distinct()


def invalidated(found: DataFrame, dependencies: DataFrame, versions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Supports that stand without the decisions of these versions, and those that fall: ``dependencies`` (support_id, version)."""
    fallen = dependencies.join(versions.select("version").distinct(), "version", "left_semi").select(F.col("support_id").alias("id")).distinct()
    return found.join(fallen, "id", "left_anti"), found.join(fallen, "id", "left_semi")


def hierarchy_supports(accepted: DataFrame, orders: DataFrame, revisions: DataFrame | None = None, engine: str = ENGINE) -> tuple[DataFrame, DataFrame]:
    """Supports that the default orders of accepted pairs of a show and a series give, with ``depends`` (the version of the decision
    they rest on), and diagnostics (claim_id, message) of pairs whose orders cannot be aligned; these give no supports.

    ``accepted``: claim_id, version, statement; ``orders`` as ``default_orders`` gives them; ``revisions``: source, key, revision of the
    records, for the inputs. Statements other than an exact one between a bare show and a bare series are passed over.
    """
    two = F.split("statement", " <=> ")
    exact = accepted.where(F.col("statement").contains(" <=> ") & ~F.col("statement").contains(" :: ") & ~F.col("statement").contains("[")).select("claim_id", F.get(two, F.lit(0)).alias("a"), F.get(two, F.lit(1)).alias("b"))
    pairs = exact.select("claim_id", *[F.when(F.col("a").startswith(f"{TMDB}://tv/"), x).otherwise(y).alias(n) for n, x, y in (("left", F.col("a"), F.col("b")), ("right", F.col("b"), F.col("a")))])
    pairs = pairs.where(F.col("left").startswith(f"{TMDB}://tv/") & F.col("right").startswith(f"{TVDB}://series/"))
    side = lambda n: Cut(pairs.select("claim_id", F.col(n).alias("order_ref")).join(orders, "order_ref").withColumnRenamed("claim_id", "parent"), f"{n}-orders").df
    left, right = side("left"), side("right")
    faults = reduce(DataFrame.unionByName, [order_violations(d, ("parent",)).select(F.col("parent").alias("claim_id"), F.concat_ws(": ", "message", "what").alias("message")) for d in (left, right)])
    missing = reduce(DataFrame.unionByName, [pairs.select("claim_id").join(d.select(F.col("parent").alias("claim_id")).distinct(), "claim_id", "left_anti").select("claim_id", F.lit(f"the {n} order is absent").alias("message")) for n, d in (("left", left), ("right", right))])
    diagnostics = Cut(faults.unionByName(missing).distinct(), "diagnostics").df
    ill = diagnostics.select(F.col("claim_id").alias("parent")).distinct()
    left, right = left.join(ill, "parent", "left_anti"), right.join(ill, "parent", "left_anti")
    said = aligned_statements(left, right).select("parent", "run", parsed()(F.col("statement")).alias("p")).where("p.ok").select("parent", "run", F.col("p.canonical").alias("statement"), F.col("p.claim_id").alias("claim"))
    runs = episode_runs(left, right)
    if "observations" in orders.columns:
        seen = reduce(DataFrame.unionByName, [runs.select("parent", "run", F.col(f"{n}_reference").alias("reference")).join(d.select("parent", "reference", F.explode("observations").alias("o")), ["parent", "reference"]).select("parent", "run", "o.*") for n, d in (("left", left), ("right", right))])
        seen = seen.distinct().join(revisions, ["source", "key"], "left") if revisions is not None else seen.distinct().withColumn("revision", F.lit(None).cast("bigint"))
        # a run has at most as many episodes as an order
        inputs = seen.groupBy("parent", "run").agg(F.array_sort(F.collect_set(F.struct("source", "key", "revision", "field", "value"))).alias("inputs"))
        said = said.join(inputs, ["parent", "run"], "left")
    else:
        said = said.withColumn("inputs", F.array().cast("array<struct<source:string,key:string,revision:bigint,field:string,value:string>>"))
    versions = accepted.select(F.col("claim_id").alias("parent"), "version")
    rows = said.join(versions, "parent").select("statement", F.concat(F.lit("default-order-structure:"), F.col("version").cast("string")).alias("method"), "inputs", F.col("claim").alias("claim_id"), F.col("version").alias("depends"))
    return L.with_ids(rows, engine), diagnostics


def saved_decisions(events: DataFrame, requests: DataFrame) -> dict[str, DataFrame]:
    """What accepted, rejected and retracted reviews (claim_id, record, action, note, replaces) leave: ``events`` with the new ones,
    whose versions go on from the last one in order of claim; ``decisions`` in force; ``pending`` (claim_id, generation) to be
    published. A claim that is replaced is rejected at once, before the one that replaces it."""
    asked = requests.select("claim_id", "record", "action", "note", F.lit(1).alias("turn"))
    replaced = requests.where("replaces IS NOT NULL").select(F.col("replaces").alias("claim_id"), "note").join(events.groupBy("claim_id").agg(F.max_by("record", "version").alias("record")), "claim_id").select("claim_id", "record", F.lit("rejected").alias("action"), "note", F.lit(0).alias("turn"))
    last = events.agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]
    rows = asked.unionByName(replaced)
    number = F.row_number().over(Window.orderBy("turn", "claim_id", "action"))  # one page of reviews
    new = rows.withColumn("version", (F.lit(last) + number).cast("bigint")).drop("turn")
    everything = events.unionByName(new.select(*events.columns))
    decided = everything.groupBy("claim_id").agg(F.max_by(F.struct("version", "record", "action"), "version").alias("d")).select("claim_id", "d.*")
    pending = new.groupBy("claim_id").agg(F.max("version").alias("generation"))
    return {"events": everything, "decisions": decided, "pending": pending}


def pending_decisions(pending: DataFrame, decisions: DataFrame) -> DataFrame:
    """What waits to be published: claim_id, generation, record, action; a retracted claim is a file to be deleted."""
    return pending.join(decisions, "claim_id").select("claim_id", "generation", "record", "action", F.when(F.col("action") == "retracted", "delete").otherwise("write").alias("file"))


def acknowledged(pending: DataFrame, published: DataFrame) -> DataFrame:
    """What still waits after a publication (claim_id, generation): claims decided again since then keep their place."""
    return pending.join(published.select("claim_id", "generation"), ["claim_id", "generation"], "left_anti")


def set_policy(current: DataFrame, document: str) -> DataFrame:
    """document and generation of the policy; the generation goes up only if the document differs."""
    same = F.col("document").eqNullSafe(F.lit(document))
    return current.select(F.lit(document).alias("document"), (F.col("generation") + F.when(same, 0).otherwise(1)).alias("generation"))
