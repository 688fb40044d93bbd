"""The versioned record store: latest versions, change pages, commits, membership and absence, retention.

Tables are append-only: ``versions`` (source, key, revision, payload, hash, deleted, metadata, recorded_at). Every operator takes
DataFrames and gives one; what the store must refuse comes as rows of a violations table.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.content import content_hash, domain_of

#: Rows of a page or batch, at most.
PAGE = 1000
#: Revisions that are filled together when nulls take what was in force before.
FILL_RANGE = 4096
#: Fields of a record's metadata that say how it was found, not what it is (fixed values).
BOOKKEEPING = ("materialized_at", "run_started_at", "run_id", "operation", "mode", "source", "domain", "acquisition_version", "content_changed_at")


class CursorExpired(ValueError):
    """The change cursor lies before the oldest revision that is kept."""


def latest(versions: DataFrame, keys: tuple[str, ...] = ("source", "key"), order: tuple[str, ...] = ("revision",)) -> DataFrame:
    """The newest row for each key. An aggregation with a partial step, so no key's versions are gathered."""
    rest = [c for c in versions.columns if c not in (*keys, *order)]
    top = versions.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("__top"))
    return top.select(*keys, *[F.col("__top")[c].alias(c) for c in (*order, *rest)])


def heads(versions: DataFrame) -> DataFrame:
    """source and its highest revision."""
    return versions.groupBy("source").agg(F.max("revision").alias("revision"))


def valid_key(key: Column) -> Column:
    """A key domain:native with both parts, and not reserved."""
    return key.rlike("^[^:@][^:]*:.+$")


def batch_violations(batch: DataFrame, most: int = PAGE) -> DataFrame:
    """key and message of what makes a batch unfit: a bad key, metadata that is no object, a key twice, too many rows."""
    checks = [
        batch.where(~valid_key(F.col("key")) | F.col("key").isNull()).select("key", F.lit("key must be domain:native").alias("message")),
        batch.where(F.col("metadata").isNotNull() & (F.size(F.coalesce(F.json_object_keys("metadata"), F.array())) <= 0) & ~F.trim("metadata").rlike(r"^\{\s*\}$")).select("key", F.lit("metadata must be an object").alias("message")),
        batch.groupBy("key").count().where("count > 1").select("key", F.lit("key occurs twice").alias("message")),
        batch.agg(F.count("*").alias("n")).where(F.col("n") > most).select(F.lit(None).cast("string").alias("key"), F.lit("too many rows").alias("message")),
    ]
    return reduce(DataFrame.unionByName, checks)


def changes_page(versions: DataFrame, source: str, after: tuple[int, str | None], through: int, limit: int = PAGE, domains: tuple[str, ...] = (), floor: int = 0) -> DataFrame:
    """The versions after the cursor (revision, key or None) up to ``through``, in order of revision and key.

    A cursor before the floor is refused, as what followed it may be gone; (floor, None) is the oldest good one.
    """
    revision, key = after
    if revision < floor or (revision == floor and key is not None and floor > 0):
        raise CursorExpired(f"cursor at revision {revision}, kept from {floor}")
    rows = versions.where((F.col("source") == source) & (F.col("revision") <= through))
    past = F.col("revision") > revision
    if key is not None:
        past = past | ((F.col("revision") == revision) & (F.col("key") > key))
    if domains:
        rows = rows.where(domain_of(F.col("key")).isin(*domains))
    return rows.where(past).orderBy("revision", "key").limit(limit)


def next_cursor(page: DataFrame, through: int, limit: int = PAGE) -> DataFrame:
    """revision, key and complete: a short page ends the feed, and its cursor is then (through, null)."""
    last = page.agg(F.max(F.struct("revision", "key")).alias("last"), (F.count("*") < limit).alias("complete"))
    return last.select(F.when(F.col("complete"), F.lit(through)).otherwise(F.col("last.revision")).cast("bigint").alias("revision"), F.when(~F.col("complete"), F.col("last.key")).alias("key"), "complete")


def inspect_page(current: DataFrame, source: str, after: str | None, limit: int = PAGE, deleted: bool = False) -> DataFrame:
    """Current records by key, from ``after`` on."""
    rows = current.where(F.col("source") == source)
    rows = rows if deleted else rows.where(~F.col("deleted"))
    return (rows if after is None else rows.where(F.col("key") > after)).orderBy("key").limit(limit)


def page_with_next(rows: DataFrame, key: str, limit: int) -> DataFrame:
    """A page of ``limit`` rows in order of ``key``, each with ``next``: the key to go on after, null on the last page."""
    ahead = rows.orderBy(key).limit(limit + 1)
    w = Window.orderBy(key)  # over one page only
    numbered = ahead.withColumn("__n", F.row_number().over(w)).withColumn("__more", F.count("*").over(Window.partitionBy()) > limit)
    return numbered.withColumn("next", F.when(F.col("__more"), F.max(F.when(F.col("__n") == limit, F.col(key))).over(Window.partitionBy()))).where(F.col("__n") <= limit).drop("__n", "__more")


def by_keys(current: DataFrame, wanted: DataFrame) -> DataFrame:
    """Current records whose key is in ``wanted``."""
    return current.join(wanted.select("source", "key").distinct(), ["source", "key"], "left_semi")


def scope(current: DataFrame, source: str, key: str, most: int = PAGE) -> DataFrame:
    """A record and those whose metadata names it as parent; with more than ``most`` rows none, and ``excess`` says so."""
    rows = current.where((F.col("source") == source) & ~F.col("deleted") & ((F.col("key") == key) | (F.get_json_object("metadata", "$.parent") == key)))
    counted = rows.withColumn("scope_rows", F.count("*").over(Window.partitionBy("source")))
    return counted.where(F.col("scope_rows") <= most).drop("scope_rows")


def commit(versions: DataFrame, batch: DataFrame, revision: int) -> DataFrame:
    """The version rows that a batch adds at a revision: what it leaves null of payload, hash and deleted stays as it was."""
    before = latest(versions).select("source", "key", *[F.col(c).alias(f"__{c}") for c in ("payload", "hash", "deleted")])
    return batch.join(before, ["source", "key"], "left").select(
        "source", "key", F.lit(revision).cast("bigint").alias("revision"),
        *[F.coalesce(c, f"__{c}").alias(c) for c in ("payload", "hash", "deleted")], F.coalesce("metadata", F.lit("{}")).alias("metadata"),
    )


def in_force(versions: DataFrame) -> DataFrame:
    """Every version with payload, hash and deleted as they were in force at it: nulls are filled from before.

    A key's versions need their order here; ranges of revisions are filled by themselves first, so that a key with very many
    versions is spread over the ranges, and only what each range ends with is carried on.
    """
    fields = [c for c in ("payload", "hash", "deleted") if c in versions.columns]
    rows = versions.withColumn("__bucket", F.floor(F.col("revision") / FILL_RANGE))
    w = Window.partitionBy("source", "key", "__bucket").orderBy("revision").rowsBetween(Window.unboundedPreceding, 0)
    filled = rows.select("*", *[F.last(c, ignorenulls=True).over(w).alias(f"__{c}") for c in fields])
    ends = rows.groupBy("source", "key", "__bucket").agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("revision"))).alias(f"__end_{c}") for c in fields])
    before = Window.partitionBy("source", "key").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("source", "key", "__bucket", *[F.last(f"__end_{c}", ignorenulls=True).over(before).alias(f"__before_{c}") for c in fields])
    joined = filled.join(carried, ["source", "key", "__bucket"], "left")
    return joined.select(*[F.coalesce(f"__{c}", f"__before_{c}").alias(c) if c in fields else F.col(c) for c in versions.columns])


def observed_changes(current: DataFrame, observed: DataFrame, run: dict | None = None) -> DataFrame:
    """What a run's observations add to the store (source, key, payload, hash, deleted, metadata): new keys, another hash, a record
    that is back or gone, or the same content described otherwise. Metadata is compared without what only says how it was found.
    With ``run`` (now, started, run_id, mode) the metadata is what ``observation_metadata`` makes of it. Of several observations
    of a key the one with the highest ``position`` counts, where there is such a column."""
    old = current.select("source", "key", F.col("hash").alias("old_hash"), F.col("deleted").alias("old_deleted"), F.col("metadata").alias("old_metadata"))
    found = latest(observed, order=("position",)) if "position" in observed.columns else observed
    same = F.col("hash").eqNullSafe(F.col("old_hash")) & F.col("deleted").eqNullSafe(F.col("old_deleted"))
    described = descriptor(F.col("metadata")).eqNullSafe(descriptor(F.col("old_metadata")))
    rows = found.join(old, ["source", "key"], "left").where(~(same & described))
    metadata = F.col("metadata") if run is None else observation_metadata(F.col("source"), F.col("key"), F.col("metadata"), F.col("old_metadata"), ~same, run)
    return rows.select("source", "key", F.when(~same, F.col("payload")).alias("payload"), F.when(~same, F.col("hash")).alias("hash"), F.when(~same, F.col("deleted")).alias("deleted"), metadata.alias("metadata"))


def _fields(metadata: Column) -> Column:
    return F.from_json(F.coalesce(metadata, F.lit("{}")), "map<string,variant>")


def descriptor(metadata: Column) -> Column:
    """What metadata says of the record itself, as JSON members in order of their names (maps cannot be compared)."""
    kept = F.map_filter(_fields(metadata), lambda k, v: ~k.isin(*BOOKKEEPING))
    return F.transform(F.array_sort(F.map_keys(kept)), lambda k: F.to_json(F.create_map(k, kept[k])))


def observation_metadata(source: Column, key: Column, supplied: Column, old: Column, changed: Column, run: dict) -> Column:
    """The metadata that is stored of an observation: the old one where neither content nor description changed; else what the
    source supplied, with the run's marks. The time of the last change of content is kept where the content did not change."""
    said = lambda v: F.parse_json(F.lit(json.dumps(v)))
    text = lambda c: F.parse_json(F.to_json(F.create_map(F.lit("x"), c)))
    word = lambda c: F.variant_get(text(c), "$.x", "variant")
    before = F.variant_get(F.try_parse_json(F.coalesce(old, F.lit("{}"))), "$.content_changed_at", "variant")
    marks = F.create_map(
        F.lit("domain"), word(domain_of(key)), F.lit("source"), word(source), F.lit("materialized_at"), said(run["now"]), F.lit("run_started_at"), said(run["started"]), F.lit("run_id"), said(run["run_id"]),
        F.lit("mode"), said(run["mode"]), F.lit("acquisition_version"), said(1), F.lit("content_changed_at"), F.when(changed, said(run["now"])).otherwise(F.coalesce(before, F.parse_json(F.lit("null")))),
    )
    new = F.to_json(F.map_concat(F.map_filter(_fields(supplied), lambda k, v: ~k.isin(*BOOKKEEPING)), marks))
    kept = ~changed & descriptor(supplied).eqNullSafe(descriptor(old))
    return F.when(kept, old).otherwise(new)


def absent_members(current: DataFrame, members: DataFrame, discovered: DataFrame) -> DataFrame:
    """Stored children of the parents in ``members`` (source, parent, key) that are neither members any more nor discovered."""
    parents = members.select("source", "parent").distinct()
    children = current.where(~F.col("deleted")).select("source", "key", F.get_json_object("metadata", "$.parent").alias("parent"))
    return children.join(parents, ["source", "parent"], "left_semi").join(members, ["source", "parent", "key"], "left_anti").join(discovered.select("source", "key").distinct(), ["source", "key"], "left_anti")


def absent_records(current: DataFrame, run_id: str, source: str, domains: tuple[str, ...]) -> DataFrame:
    """Live records of a source's domains that a complete full run did not see."""
    return current.where((F.col("source") == source) & ~F.col("deleted") & F.col("domain").isin(*domains) & ~F.col("seen_run").eqNullSafe(F.lit(run_id)))


def unseen_records(current: DataFrame, last_runs: DataFrame, domains: tuple[str, ...]) -> DataFrame:
    """Live records of these domains that the last complete full run of their source (source, run_id) did not see; sources without
    such a run have none."""
    rows = current.where(~F.col("deleted") & F.col("domain").isin(*domains)).join(last_runs.select("source", F.col("run_id").alias("__run")), "source")
    return rows.where(~F.col("seen_run").eqNullSafe(F.col("__run"))).drop("__run")


def damaged(records: DataFrame) -> DataFrame:
    """Records whose hash is not that of their payload."""
    return records.where(F.col("payload").isNotNull() & ~content_hash("payload").eqNullSafe(F.col("hash")))


def first_if_equal(rows: DataFrame, keys: tuple[str, ...], body: Column, order: str) -> DataFrame:
    """For each key its first row if all its rows have equal bodies; keys with different bodies are dropped. The partial step keeps
    a key with very many rows small."""
    rest = [c for c in rows.columns if c not in keys]
    marked = rows.withColumn("__body", body)
    top = marked.groupBy(*keys).agg(F.min(F.struct(order, *[c for c in rest if c != order])).alias("__first"), F.min("__body").alias("__low"), F.max("__body").alias("__high"), F.count("__body").alias("__n"), F.count("*").alias("__all"))
    return top.where((F.col("__low") == F.col("__high")) & (F.col("__n") == F.col("__all")) | (F.col("__n") == 0)).select(*keys, *[F.col("__first")[c].alias(c) for c in rest])


def removable(versions: DataFrame, current: DataFrame, consumed: DataFrame, before: Column, references: list[DataFrame]) -> DataFrame:
    """Versions that nothing needs: below every consumer's revision, recorded before a time, not current, and in none of the
    tables of references (source, key, revision)."""
    keys = ["source", "key", "revision"]
    low = consumed.groupBy("source").agg(F.min("revision").alias("__consumed"))
    rows = versions.join(low, "source").where((F.col("revision") < F.col("__consumed")) & (F.col("recorded_at") < before)).drop("__consumed")
    for table in [current, *references]:
        rows = rows.join(table.select(*keys).distinct(), keys, "left_anti")
    return rows


def raised_floors(sources: DataFrame, removed: DataFrame) -> DataFrame:
    """The sources with their history floors raised to the highest revision removed."""
    top = removed.groupBy("source").agg(F.max("revision").alias("__top"))
    return sources.join(top, "source", "left").withColumn("history_floor", F.greatest("history_floor", F.coalesce("__top", F.lit(0)))).drop("__top")


def run_mode(watermark: Column, pending: Column, full: Column, restart: Column) -> Column:
    """How the next run goes: an unfinished run is taken up unless a restart is asked for (``refused`` where it is incremental and
    a full one is asked for); else full if that is asked for or no run has ended well yet; else incremental."""
    fresh = F.when(F.coalesce(full, F.lit(False)) | watermark.isNull(), "full").otherwise("incremental")
    resumed = F.when(F.coalesce(full, F.lit(False)) & (pending != "full"), "refused").otherwise(pending)
    return F.when(~F.coalesce(restart, F.lit(False)) & pending.isNotNull(), resumed).otherwise(fresh)


def scope_violations(current: DataFrame, most: int = PAGE) -> DataFrame:
    """source, parent and rows of scopes (a record and those that name it as parent) that are too large to be resolved in."""
    live = current.where(~F.col("deleted"))
    rows = live.select("source", F.col("key").alias("parent")).unionByName(live.select("source", F.get_json_object("metadata", "$.parent").alias("parent")).where("parent IS NOT NULL"))
    return rows.groupBy("source", "parent").agg(F.count("*").alias("rows")).where(F.col("rows") > most)


def changed_versions(versions: DataFrame, keys: tuple[str, ...], order: tuple[str, ...], content: str) -> DataFrame:
    """The versions whose content differs from that of the version before, the first ones included."""
    before = F.lag(content).over(Window.partitionBy(*keys).orderBy(*order))
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) == 1
    return versions.withColumn("__before", before).withColumn("__first", first).where(F.col("__first") | ~F.col(content).eqNullSafe(F.col("__before"))).drop("__before", "__first")


def bootstrap_page(current: DataFrame, versions: DataFrame, source: str, after: str | None, limit: int = PAGE) -> DataFrame:
    """The current versions of a source by key from ``after`` on: where a new consumer begins before it follows the changes."""
    keys = current.where(F.col("source") == source).select("source", "key", "revision")
    keys = keys if after is None else keys.where(F.col("key") > after)
    return keys.orderBy("key").limit(limit).join(versions, ["source", "key", "revision"]).orderBy("key")


def consumer_page(versions: DataFrame, current: DataFrame, source: str, state: dict, head: int, floor: int = 0, limit: int = PAGE) -> tuple[DataFrame, dict]:
    """The next page of a consumer and its state after it: ``bootstrap``, ``revision``, ``after_key``.

    A new consumer (state None or empty) notes the head, reads the current records by key, and then follows the changes from that
    head on, so what changed meanwhile comes again as a change; who takes in revisions twice compares them. Its page is over when it
    is short. A consumer whose revision lies before the floor has lost changes, which is an error.
    """
    state = state or {"bootstrap": True, "revision": head, "after_key": None}
    if state["bootstrap"]:
        page = bootstrap_page(current, versions, source, state["after_key"], limit)
    else:
        page = changes_page(versions, source, (state["revision"], state["after_key"]), head, limit, floor=floor)
    last = page.agg(F.count("*").alias("n"), F.max(F.struct("revision", "key")).alias("v"), F.max("key").alias("k")).first()
    if state["bootstrap"]:
        return page, state | ({"after_key": last["k"]} if last["n"] == limit else {"bootstrap": False, "after_key": None})
    return page, state | ({"revision": last["v"]["revision"], "after_key": last["v"]["key"]} if last["n"] == limit else {"revision": head, "after_key": None})


def upserted(current: DataFrame, rows: DataFrame, keys: tuple[str, ...] = ("source", "key"), order: str = "revision") -> DataFrame:
    """The current table after rows were put in: of each key the row with the highest ``order``."""
    return latest(current.unionByName(rows.select(*current.columns)), keys, (order,))


def committed(versions: DataFrame, current: DataFrame, batch: DataFrame, revision: int, run_id: str) -> tuple[DataFrame, DataFrame]:
    """The version rows that a batch adds, and the current table after it: new rows upserted, all of the batch's keys marked as
    seen by the run. Write both, and the checkpoint, in one revision of a Ledger."""
    added = commit(versions, batch, revision)
    state = added.select("source", "key", "revision", "hash", "deleted", "metadata", F.lit(run_id).alias("seen_run"))
    return added, upserted(current, state)


def run_counters(discovered: DataFrame, fetched: DataFrame, changed: DataFrame) -> DataFrame:
    """source and how many records a run discovered, fetched and found changed."""
    parts = [d.select("source", *[F.lit(int(n == name)).alias(n) for n in ("discovered", "fetched", "changed")]) for name, d in (("discovered", discovered), ("fetched", fetched), ("changed", changed))]
    return reduce(DataFrame.unionByName, parts).groupBy("source").agg(*[F.sum(n).alias(n) for n in ("discovered", "fetched", "changed")])


def selection_status(runs: DataFrame) -> DataFrame:
    """For each source: its last good full run and last good run, the run that is unfinished if any, and how many failed since."""
    good = F.col("status") == "complete"
    last = runs.groupBy("source").agg(
        F.max(F.when(good & (F.col("mode") == "full"), F.struct("started_at", "run_id"))).alias("f"), F.max(F.when(good, F.struct("started_at", "run_id"))).alias("g"), F.max(F.struct("started_at", "run_id", "status")).alias("l"),
    )
    failed = runs.join(last.select("source", F.col("g.started_at").alias("since")), "source").where(~good & (F.col("since").isNull() | (F.col("started_at") > F.col("since")))).groupBy("source").agg(F.count("*").alias("failed_since"))
    return last.join(failed, "source", "left").select("source", F.col("f.run_id").alias("last_full"), F.col("g.run_id").alias("last_good"), F.when(F.col("l.status") != "complete", F.col("l.run_id")).alias("unfinished"), F.coalesce("failed_since", F.lit(0)).alias("failed_since"))
