"""Queries of the record store: latest versions, pages, changes, membership, absence, retention."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.content import content_hash, domain_of
from ..functions.text import clean, sha256_of
from ..operators import records as R
from ..sources.tables import table

#: A time in the middle of the test feed, before which versions may be removed.
CUTOFF = "2024-06-01 00:00:00"


def versions(spark: SparkSession, folder: str) -> DataFrame:
    """Each version once, its key tidy. The deliveries of one version agree but for spelling."""
    rows = table(spark, folder, "record_versions").select("source", clean("key").alias("key"), F.col("revision").cast("bigint").alias("revision"), "hash", "deleted", "recorded_at")
    return rows.groupBy("source", "key", "revision").agg(F.max("hash").alias("hash"), F.max("deleted").alias("deleted"), F.min("recorded_at").alias("recorded_at"))


_V = r"""v AS (SELECT source, lower(regexp_replace(key, '^\s+|\s+$', '', 'g')) AS key, revision, max(hash) AS hash, max(deleted) AS deleted, min(recorded_at) AS recorded_at
  FROM record_versions GROUP BY ALL)"""
_STORED = r"""w AS (SELECT source, lower(regexp_replace(key, '^\s+|\s+$', '', 'g')) AS key, revision, max(hash) AS hash, max(deleted) AS deleted, max(metadata) AS metadata FROM record_versions GROUP BY ALL),
stored AS (SELECT source, key, max_by(hash, CASE WHEN hash IS NOT NULL THEN revision END) AS hash, max_by(deleted, CASE WHEN deleted IS NOT NULL THEN revision END) AS deleted, arg_max(coalesce(metadata, '{}'), revision) AS metadata FROM w GROUP BY ALL)"""
_NAMES = ", ".join(f"'{n}'" for n in R.BOOKKEEPING)
#: The members of a description in order of their names.
_described = lambda m: f"list_sort(list_transform(list_filter(json_keys(coalesce({m}, '{{}}')), lambda k: k NOT IN ({_NAMES})), lambda k: k || json_extract({m}, '$.\"' || k || '\"')))"
_SQL_LATEST = "latest AS (SELECT source, key, max(revision) AS revision FROM v GROUP BY ALL)"


def rec_latest(s, d):
    return R.latest(versions(s, d)).select("source", "key", "revision", "deleted")


def rec_heads(s, d):
    return R.heads(table(s, d, "record_versions"))


def rec_content_hash(s, d):
    return table(s, d, "events").select("event_id", content_hash("props").alias("hash"))


def rec_integrity(s, d):
    rows = table(s, d, "record_versions").where("payload IS NOT NULL")
    bad = R.damaged(rows).groupBy("source").agg(F.count("*").alias("damaged"))
    return rows.groupBy("source").agg(F.count("*").alias("versions")).join(bad, "source", "left").select("source", "versions", F.coalesce("damaged", F.lit(0)).alias("damaged"))


def rec_changes_page(s, d):
    return R.changes_page(versions(s, d), "org.themoviedb", (100, "movie:5"), 400).select("source", "key", "revision")


def rec_changes_domain(s, d):
    return R.changes_page(versions(s, d), "com.thetvdb", (50, None), 200, domains=("series", "season")).select("source", "key", "revision")


def rec_next_cursor(s, d):
    return R.next_cursor(R.changes_page(versions(s, d), "co.anilist", (10, None), 100), 100)


def rec_inspect_page(s, d):
    return R.inspect_page(R.latest(R.in_force(versions(s, d))), "org.themoviedb", "movie:2").select("source", "key", "revision")


def rec_in_force(s, d):
    return R.in_force(versions(s, d)).select("source", "key", "revision", "hash", "deleted")


def rec_changed_only(s, d):
    rows = table(s, d, "events").select("user_id", "event_id", "ts", F.sha2("props", 256).alias("hash"))
    return R.changed_versions(rows, ("user_id",), ("ts", "event_id"), "hash").select("user_id", "event_id", "hash")


def stored(s: SparkSession, d: str) -> DataFrame:
    """The current table: of each record hash and deletion in force and the newest metadata."""
    rows = table(s, d, "record_versions").select("source", clean("key").alias("key"), F.col("revision").cast("bigint").alias("revision"), "hash", "deleted", "metadata")
    once = rows.groupBy("source", "key", "revision").agg(*[F.max(c).alias(c) for c in ("hash", "deleted", "metadata")])
    return R.latest(R.in_force(once))


def rec_observed_changes(s, d):
    """What the rows that runs saw would add to the store: with a hash where the content differs, without where only the description does."""
    rows = table(s, d, "records").select("source", clean("key").alias("key"), F.col("revision").alias("position"), F.lit(None).cast("string").alias("payload"), sha256_of("hash").alias("hash"), "deleted", "metadata")
    seen = rows.groupBy("source", "key").agg(F.max(F.struct("position", "deleted", "hash", "metadata", "payload")).alias("x")).select("source", "key", "x.*")
    run = {"now": 1735689600, "started": 1735686000, "run_id": "next", "mode": "full"}
    found = R.observed_changes(stored(s, d), seen, run)
    return found.select("source", "key", "hash", "deleted", F.get_json_object("metadata", "$.run_id").alias("run_id"), F.get_json_object("metadata", "$.parent").alias("parent"), F.get_json_object("metadata", "$.content_changed_at").alias("content_changed_at"))


def rec_run_mode(s, d):
    """How each run would go if the one before it (by time, of its source) had been left as it is."""
    runs = table(s, d, "sync_runs")
    before = Window.partitionBy("source").orderBy("started_at", "run_id")
    rows = runs.select("run_id", F.max(F.when(F.col("status") == "complete", F.unix_timestamp(F.col("started_at").cast("timestamp")))).over(before.rowsBetween(Window.unboundedPreceding, -1)).alias("watermark"), F.lag(F.when(F.col("status") != "complete", F.col("mode"))).over(before).alias("pending"), (F.col("mode") == "full").alias("full"), (F.length("run_id") % 2 == 0).alias("restart"))
    return rows.select("run_id", R.run_mode(F.col("watermark"), F.col("pending"), F.col("full"), F.col("restart")).alias("mode"))


def rec_selection_status(s, d):
    return R.selection_status(table(s, d, "sync_runs"))


def rec_scope(s, d):
    """Scopes with more than three records."""
    return R.scope_violations(stored(s, d), 3)


def rec_bootstrap(s, d):
    return R.bootstrap_page(R.latest(versions(s, d)), versions(s, d), "org.themoviedb", "movie:3", 800).select("source", "key", "revision", "hash")


def rec_committed(s, d):
    """The current table of half of the revisions, after the versions of the other half came as one batch with their newest contents."""
    v = table(s, d, "record_versions").select("source", clean("key").alias("key"), F.col("revision").cast("bigint").alias("revision"), "payload", "hash", "deleted", "metadata")
    once = v.groupBy("source", "key", "revision").agg(*[F.max(c).alias(c) for c in ("payload", "hash", "deleted", "metadata")])
    half = (v.agg(F.max("revision")).first()[0] or 0) // 2
    old, new = R.in_force(once.where(F.col("revision") <= half)), once.where(F.col("revision") > half)
    top = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("revision"))).alias(c)
    batch = new.groupBy("source", "key").agg(*[top(c) for c in ("payload", "hash", "deleted", "metadata")])
    current = R.latest(old).select("source", "key", "revision", "hash", "deleted", "metadata", F.lit("before").alias("seen_run"))
    added, state = R.committed(old, current, batch, 2 * half + 1, "batch")
    return state.select("source", "key", "revision", "hash", "deleted", "seen_run")


def rec_counters(s, d):
    rows = table(s, d, "records")
    return R.run_counters(rows, rows.where("hash IS NOT NULL"), R.observed_changes(stored(s, d), rows.select("source", clean("key").alias("key"), F.lit(None).cast("string").alias("payload"), sha256_of("hash").alias("hash"), "deleted", "metadata")))


def rec_membership_diff(s, d):
    lines = table(s, d, "lineitem")
    part, order = F.concat(F.lit("part:"), F.col("l_partkey").cast("string")), F.concat(F.lit("order:"), F.col("l_orderkey").cast("string"))
    current = lines.select(F.lit("shop").alias("source"), part.alias("key"), F.lit(False).alias("deleted"), F.to_json(F.struct(order.alias("parent"))).alias("metadata"))
    members = lines.where("l_returnflag = 'R'").select(F.lit("shop").alias("source"), order.alias("parent"), part.alias("key"))
    nothing = current.select("source", "key").limit(0)
    return R.absent_members(current, members, nothing).select("parent", "key").distinct()


def rec_absent(s, d):
    """Films and series of one catalog that its last complete full run did not see."""
    runs = table(s, d, "sync_runs").where("mode = 'full' AND status = 'complete'").groupBy("source").agg(F.max_by("run_id", F.struct("started_at", "run_id")).alias("run_id"))
    rows = table(s, d, "records").select("source", clean("key").alias("key"), domain_of(clean("key")).alias("domain"), "deleted", "seen_run")
    return R.unseen_records(rows.where("source = 'com.thetvdb'"), runs, ("movie", "series")).select("key", "seen_run").distinct()


def rec_retention(s, d):
    v = versions(s, d)
    refs = table(s, d, "records").select("source", clean("key").alias("key"), "revision")
    return R.removable(v, R.latest(v), table(s, d, "sources"), F.lit(CUTOFF).cast("timestamp_ntz"), [refs]).select("source", "key", "revision")


def rec_floors(s, d):
    return R.raised_floors(table(s, d, "sources"), rec_retention(s, d))


def rec_first_if_equal(s, d):
    body = F.concat_ws("/", "l_partkey", "l_suppkey", "l_returnflag")
    return R.first_if_equal(table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag"), ("l_orderkey", "l_linenumber"), body, "l_partkey").select("l_orderkey", "l_linenumber", "l_partkey")


def rec_violations(s, d):
    return R.batch_violations(table(s, d, "record_versions").select("key", "metadata")).groupBy("message").agg(F.count("*").alias("n"))


def rec_by_keys(s, d):
    wanted = table(s, d, "records").where("deleted").select("source", clean("key").alias("key"))
    return R.by_keys(R.latest(versions(s, d)), wanted).select("source", "key", "revision")


def doc_pages(s, d):
    return R.page_with_next(table(s, d, "documents").where("doc_id > 100").select("doc_id", "source"), "doc_id", 500)


QUERIES = {f.__name__: f for f in (rec_latest, rec_heads, rec_content_hash, rec_integrity, rec_changes_page, rec_changes_domain, rec_next_cursor, rec_inspect_page, rec_in_force, rec_changed_only, rec_observed_changes, rec_run_mode, rec_selection_status, rec_scope, rec_bootstrap, rec_committed, rec_counters, rec_membership_diff, rec_absent, rec_retention, rec_floors, rec_first_if_equal, rec_violations, rec_by_keys, doc_pages)}
SQL = {
    "rec_latest": f"WITH {_V}, {_SQL_LATEST} SELECT v.source, v.key, v.revision, v.deleted FROM v JOIN latest USING (source, key, revision)",
    "rec_heads": "SELECT source, max(revision) AS revision FROM record_versions GROUP BY source",
    "rec_content_hash": "SELECT event_id, sha256(replace(props, ' ', '')) AS hash FROM events",
    "rec_changes_page": f"WITH {_V} SELECT source, key, revision FROM v WHERE source = 'org.themoviedb' AND revision <= 400 AND (revision > 100 OR (revision = 100 AND key > 'movie:5')) ORDER BY revision, key LIMIT 1000",
    "rec_changes_domain": f"WITH {_V} SELECT source, key, revision FROM v WHERE source = 'com.thetvdb' AND revision > 50 AND revision <= 200 AND split_part(key, ':', 1) IN ('series', 'season') ORDER BY revision, key LIMIT 1000",
    "rec_next_cursor": f"WITH {_V}, page AS (SELECT revision, key FROM v WHERE source = 'co.anilist' AND revision > 10 AND revision <= 100 ORDER BY revision, key LIMIT 1000) SELECT CASE WHEN count(*) < 1000 THEN 100 ELSE max(revision) END AS revision, CASE WHEN count(*) >= 1000 THEN max_by(key, (revision, key)) END AS key, count(*) < 1000 AS complete FROM page",
    "rec_inspect_page": f"WITH {_V}, f AS (SELECT source, key, revision, last_value(deleted IGNORE NULLS) OVER (PARTITION BY source, key ORDER BY revision ROWS UNBOUNDED PRECEDING) AS deleted, row_number() OVER (PARTITION BY source, key ORDER BY revision DESC) AS n FROM v) SELECT source, key, revision FROM f WHERE n = 1 AND source = 'org.themoviedb' AND NOT deleted AND key > 'movie:2' ORDER BY key LIMIT 1000",
    "rec_in_force": f"WITH {_V} SELECT source, key, revision, last_value(hash IGNORE NULLS) OVER w AS hash, last_value(deleted IGNORE NULLS) OVER w AS deleted FROM v WINDOW w AS (PARTITION BY source, key ORDER BY revision ROWS UNBOUNDED PRECEDING)",
    "rec_changed_only": "SELECT user_id, event_id, hash FROM (SELECT user_id, event_id, sha256(props) AS hash, lag(sha256(props)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events) WHERE hash IS DISTINCT FROM before",
    "rec_observed_changes": f"""WITH {_STORED}, seen AS (SELECT source, lower(regexp_replace(key, '^\\s+|\\s+$', '', 'g')) AS key, max((revision, deleted, regexp_extract(lower(trim(hash)), '([0-9a-f]{{64}})$', 1), metadata)) AS x FROM records GROUP BY ALL),
both_ AS (SELECT s.source, s.key, x[3] AS hash, x[2] AS deleted, x[4] AS m, f.metadata AS old, x[3] IS DISTINCT FROM f.hash OR x[2] IS DISTINCT FROM f.deleted AS changed FROM seen s LEFT JOIN stored f USING (source, key))
SELECT source, key, CASE WHEN changed THEN hash END AS hash, CASE WHEN changed THEN deleted END AS deleted, 'next' AS run_id, m->>'$.parent' AS parent, CASE WHEN changed THEN '1735689600' END AS content_changed_at
FROM both_ WHERE changed OR {_described('m')} IS DISTINCT FROM {_described('old')}""",
    "rec_run_mode": """WITH r AS (SELECT run_id, mode, max(CASE WHEN status = 'complete' THEN started_at END) OVER (PARTITION BY source ORDER BY started_at, run_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS w,
  lag(CASE WHEN status <> 'complete' THEN mode END) OVER (PARTITION BY source ORDER BY started_at, run_id) AS p, length(run_id) % 2 = 0 AS restart FROM sync_runs)
SELECT run_id, CASE WHEN p IS NOT NULL AND NOT restart THEN CASE WHEN mode = 'full' AND p <> 'full' THEN 'refused' ELSE p END WHEN mode = 'full' OR w IS NULL THEN 'full' ELSE 'incremental' END AS mode FROM r""",
    "rec_selection_status": """WITH g AS (SELECT source, max((started_at, run_id)) FILTER (status = 'complete' AND mode = 'full') AS f, max((started_at, run_id)) FILTER (status = 'complete') AS c, max((started_at, run_id, status)) AS l FROM sync_runs GROUP BY source)
SELECT source, f[2] AS last_full, c[2] AS last_good, CASE WHEN l[3] <> 'complete' THEN l[2] END AS unfinished, (SELECT count(*) FROM sync_runs r WHERE r.source = g.source AND r.status <> 'complete' AND (g.c IS NULL OR r.started_at > g.c[1])) AS failed_since FROM g""",
    "rec_scope": f"WITH {_STORED} SELECT source, parent, count(*) AS rows FROM (SELECT source, key AS parent FROM stored WHERE NOT deleted UNION ALL SELECT source, metadata->>'$.parent' FROM stored WHERE NOT deleted) WHERE parent IS NOT NULL GROUP BY ALL HAVING count(*) > 3",
    "rec_bootstrap": f"WITH {_V}, {_SQL_LATEST} SELECT v.source, v.key, v.revision, v.hash FROM v JOIN latest USING (source, key, revision) WHERE v.source = 'org.themoviedb' AND v.key > 'movie:3' ORDER BY v.key LIMIT 800",
    "rec_committed": f"""WITH {_V}, h AS (SELECT max(revision) // 2 AS half FROM record_versions),
g AS (SELECT source, key, max_by(hash, CASE WHEN hash IS NOT NULL THEN revision END) AS hash, max_by(deleted, CASE WHEN deleted IS NOT NULL THEN revision END) AS deleted, max(revision) AS revision, max(revision) > (SELECT half FROM h) AS late FROM v GROUP BY ALL)
SELECT source, key, CASE WHEN late THEN 2 * (SELECT half FROM h) + 1 ELSE revision END AS revision, hash, deleted, CASE WHEN late THEN 'batch' ELSE 'before' END AS seen_run FROM g""",
    "rec_counters": f"""WITH {_STORED}, r AS (SELECT source, lower(regexp_replace(key, '^\\s+|\\s+$', '', 'g')) AS key, regexp_extract(lower(trim(hash)), '([0-9a-f]{{64}})$', 1) AS hash, deleted, metadata FROM records)
SELECT r.source, count(*) AS discovered, count(r.hash) AS fetched, count(*) FILTER (r.hash IS DISTINCT FROM f.hash OR r.deleted IS DISTINCT FROM f.deleted OR {_described('r.metadata')} IS DISTINCT FROM {_described('f.metadata')}) AS changed FROM r LEFT JOIN stored f USING (source, key) GROUP BY r.source""",
    "rec_membership_diff": "SELECT DISTINCT 'order:' || l_orderkey AS parent, 'part:' || l_partkey AS key FROM lineitem l WHERE EXISTS (SELECT 1 FROM lineitem m WHERE m.l_orderkey = l.l_orderkey AND m.l_returnflag = 'R') AND NOT EXISTS (SELECT 1 FROM lineitem m WHERE m.l_orderkey = l.l_orderkey AND m.l_partkey = l.l_partkey AND m.l_returnflag = 'R')",
    "rec_absent": "SELECT DISTINCT lower(regexp_replace(key, '^\\s+|\\s+$', '', 'g')) AS key, seen_run FROM records WHERE source = 'com.thetvdb' AND NOT deleted AND split_part(lower(regexp_replace(key, '^\\s+|\\s+$', '', 'g')), ':', 1) IN ('movie', 'series') AND seen_run IS DISTINCT FROM (SELECT run_id FROM sync_runs WHERE source = 'com.thetvdb' AND mode = 'full' AND status = 'complete' ORDER BY started_at DESC LIMIT 1)",
    "rec_retention": f"WITH {_V}, {_SQL_LATEST} SELECT v.source, v.key, v.revision FROM v JOIN sources s ON s.source = v.source AND v.revision < s.revision WHERE recorded_at < TIMESTAMP '{CUTOFF}' AND NOT EXISTS (SELECT 1 FROM latest l WHERE l.source = v.source AND l.key = v.key AND l.revision = v.revision) AND NOT EXISTS (SELECT 1 FROM records r WHERE r.source = v.source AND lower(regexp_replace(r.key, '^\\s+|\\s+$', '', 'g')) = v.key AND r.revision = v.revision)",
    "rec_first_if_equal": "SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(DISTINCT (l_partkey, l_suppkey, l_returnflag)) = 1",
    "rec_violations": r"""SELECT 'key must be domain:native' AS message, count(*) AS n FROM record_versions WHERE NOT regexp_matches(key, '^[^:@][^:]*:.+$') OR key IS NULL HAVING count(*) > 0
UNION ALL SELECT 'key occurs twice', count(*) FROM (SELECT key FROM record_versions GROUP BY key HAVING count(*) > 1) HAVING count(*) > 0
UNION ALL SELECT 'too many rows', 1 FROM (SELECT count(*) AS c FROM record_versions) WHERE c > 1000
UNION ALL SELECT 'metadata must be an object', count(*) FROM record_versions WHERE metadata IS NOT NULL AND json_type(metadata) <> 'OBJECT' HAVING count(*) > 0""",
    "rec_by_keys": f"WITH {_V}, {_SQL_LATEST} SELECT source, key, revision FROM latest WHERE EXISTS (SELECT 1 FROM records r WHERE r.deleted AND r.source = latest.source AND lower(regexp_replace(r.key, '^\\s+|\\s+$', '', 'g')) = latest.key)",
    "doc_pages": "WITH a AS (SELECT doc_id, source FROM documents WHERE doc_id > 100 ORDER BY doc_id LIMIT 501), n AS (SELECT *, row_number() OVER (ORDER BY doc_id) AS i, count(*) OVER () AS c FROM a) SELECT doc_id, source, CASE WHEN c > 500 THEN (SELECT doc_id FROM n WHERE i = 500) END AS next FROM n WHERE i <= 500",
}
SQL["rec_floors"] = f"SELECT s.source, s.revision, greatest(s.history_floor, coalesce(t.top, 0)) AS history_floor FROM sources s LEFT JOIN (SELECT source, max(revision) AS top FROM ({SQL['rec_retention']}) GROUP BY source) t USING (source)"
