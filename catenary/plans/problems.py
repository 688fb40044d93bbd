"""The queries of the general problems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.changes import live_records, live_revisions
from ..operators.nested import nested_objects
from ..operators.snapshots import snapshot_changes
from ..sources.tables import table


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return nested_objects(table(spark, folder, "record_versions"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return snapshot_changes(table(spark, folder, "records"), table(spark, folder, "sync_runs"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return live_revisions(table(spark, folder, "record_versions"))


def p5_state(spark: SparkSession, folder: str) -> DataFrame:
    return live_records(table(spark, folder, "record_versions")).selectExpr("source", "key", "revision", "payload", "payload_at", "hash", "metadata", "metadata_at")


_KEY = r"lower(regexp_replace(key, '^\s+|\s+$', '', 'g'))"
SQL = {
    "p1_found": rf"""
WITH RECURSIVE raw AS (SELECT source, {_KEY} AS key, revision, min(payload) AS p FROM record_versions WHERE payload IS NOT NULL GROUP BY ALL),
plain AS (SELECT source, key, revision, CASE WHEN json_type(p) = 'VARCHAR' THEN p::json->>'$' ELSE p END AS p FROM raw),
tree AS (SELECT source, plain.key AS key, revision, t.id, t.parent, t.type, t.key AS name, t.value->>'$.id' AS native_id,
           row_number() OVER (PARTITION BY source, plain.key, revision, t.parent ORDER BY t.id) - 1 AS place FROM plain, json_tree(plain.p) t),
walk AS (
  SELECT source, key, revision, id, type, '' AS pointer, '' AS parent_pointer, '' AS enclosing, false AS element, native_id FROM tree WHERE parent IS NULL
  UNION ALL
  SELECT c.source, c.key, c.revision, c.id, c.type, w.pointer || x.step, w.enclosing, CASE WHEN x.element THEN w.pointer || x.step ELSE w.enclosing END, x.element, c.native_id
  FROM walk w JOIN tree c ON c.source = w.source AND c.key = w.key AND c.revision = w.revision AND c.parent = w.id,
  LATERAL (SELECT CASE WHEN w.type = 'ARRAY' THEN '/' || c.place ELSE '/' || replace(replace(c.name, '~', '~0'), '/', '~1')
                    || CASE WHEN c.type = 'OBJECT' AND c.name IN ('seasons', 'results', 'groups', 'remoteIds', 'titles') THEN '/0' ELSE '' END END AS step,
                  c.type = 'OBJECT' AND (w.type = 'ARRAY' OR c.name IN ('seasons', 'results', 'groups', 'remoteIds', 'titles')) AS element) x
  WHERE c.type IN ('OBJECT', 'ARRAY'))
SELECT source, key, revision, parent_pointer, pointer, coalesce(native_id, '') AS native_id FROM walk WHERE element
""",
    "p4_found": rf"""
WITH runs AS (
  SELECT source, run_id, row_number() OVER (PARTITION BY source ORDER BY started_at, run_id) AS n, count(*) OVER (PARTITION BY source) AS total
  FROM sync_runs WHERE mode = 'full' AND status = 'complete'),
rows AS (
  SELECT r.source, n, total, {_KEY} AS key, coalesce(deleted, false) AS deleted,
         regexp_extract(lower(trim(hash)), '([0-9a-f]{{64}})$', 1) AS hash,
         row_number() OVER (PARTITION BY r.source, n, {_KEY} ORDER BY r.revision DESC, coalesce(deleted, false) DESC, regexp_extract(lower(trim(hash)), '([0-9a-f]{{64}})$', 1) DESC) AS place
  FROM records r JOIN runs ON runs.source = r.source AND runs.run_id = r.seen_run WHERE key IS NOT NULL),
snap AS (SELECT source, n, total, key, hash FROM rows WHERE place = 1 AND NOT deleted),
pairs AS (
  SELECT b.source, b.n, b.key, CASE WHEN a.key IS NULL THEN 'added' WHEN a.hash <> b.hash THEN 'changed' END AS change
  FROM snap b LEFT JOIN snap a ON a.source = b.source AND a.key = b.key AND a.n = b.n - 1 WHERE b.n > 1
  UNION ALL
  SELECT a.source, a.n + 1, a.key, 'removed'
  FROM snap a LEFT JOIN snap b ON a.source = b.source AND a.key = b.key AND a.n = b.n - 1 WHERE b.key IS NULL AND a.n < a.total)
SELECT pairs.source, run_id, key, change FROM pairs JOIN runs USING (source, n) WHERE change IS NOT NULL
""",
    "p5_found": f"""
WITH v AS (SELECT source, {_KEY} AS key, revision, payload IS NOT NULL AS has, deleted FROM record_versions WHERE revision IS NOT NULL AND key IS NOT NULL),
a AS (SELECT source, key, max(revision) AS revision, max(CASE WHEN has THEN revision END) AS payload_revision FROM v GROUP BY ALL)
SELECT a.source, a.key, a.revision, payload_revision FROM a
WHERE EXISTS (SELECT 1 FROM v WHERE v.source = a.source AND v.key = a.key AND v.revision = payload_revision AND NOT deleted)
  AND NOT EXISTS (SELECT 1 FROM v WHERE v.source = a.source AND v.key = a.key AND v.revision = payload_revision AND deleted)
""",
    "p5_state": f"""
WITH v AS (SELECT source, {_KEY} AS key, revision, payload, hash, deleted, metadata FROM record_versions WHERE revision IS NOT NULL AND key IS NOT NULL),
gone AS (SELECT source, key, max(revision) AS gone_at FROM v WHERE deleted GROUP BY ALL),
after AS (SELECT v.* FROM v LEFT JOIN gone USING (source, key) WHERE gone_at IS NULL OR v.revision > gone_at),
live AS (SELECT source, key, max(revision) AS payload_at FROM after WHERE deleted = false GROUP BY ALL)
SELECT live.source, live.key, (SELECT max(revision) FROM v WHERE v.source = live.source AND v.key = live.key) AS revision, payload_at,
  (SELECT max(payload) FROM after a WHERE a.source = live.source AND a.key = live.key AND a.revision = payload_at) AS payload,
  (SELECT max(hash) FROM after a WHERE a.source = live.source AND a.key = live.key AND a.revision = payload_at) AS hash,
  (SELECT max(metadata) FROM after a WHERE a.source = live.source AND a.key = live.key AND a.metadata IS NOT NULL AND a.revision = (
     SELECT max(revision) FROM after b WHERE b.source = live.source AND b.key = live.key AND b.metadata IS NOT NULL)) AS metadata,
  (SELECT max(revision) FROM after b WHERE b.source = live.source AND b.key = live.key AND b.metadata IS NOT NULL) AS metadata_at
FROM live
""",
}
QUERIES = {"p1_found": p1_found, "p4_found": p4_found, "p5_found": p5_found, "p5_state": p5_state}
