"""Queries of facts, blocks, candidate claims and the claim language."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.claims import bare_claim, claim_id, common_divisor, is_claim_id, is_reference, parsed
from ..functions.content import normalize_title, year_of
from ..operators import facts as P
from ..operators import link as L
from ..operators import pipeline as PL
from ..operators import review as V
from ..operators.changes import live_records
from ..session import Cut
from ..sources.tables import table


def live(s: SparkSession, d: str) -> DataFrame:
    return live_records(table(s, d, "record_versions")).select("source", "key", "revision", "payload")


def facts(s, d):
    return P.project(live(s, d))


def fact_project(s, d):
    return facts(s, d).select("uri", "kind", "year", F.size("titles").alias("titles"), F.size("identifiers").alias("identifiers"))


def fact_titles(s, d):
    return facts(s, d).select("uri", F.explode("titles").alias("t")).select("uri", "t.field", "t.value")


def fact_identifiers(s, d):
    return facts(s, d).select("uri", F.explode("identifiers").alias("i")).select("uri", "i.field", "i.target")


def fact_normalize(s, d):
    return table(s, d, "part").select("p_partkey", normalize_title(F.concat_ws("  -- ", "p_name", "p_brand", "p_type")).alias("title"))


def fact_year_guard(s, d):
    rows = table(s, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("t"), "o_custkey")
    return rows.select("o_orderkey", year_of(F.when(F.col("o_custkey") % 3 == 0, F.concat(F.lit("0000"), "t")).otherwise(F.col("t"))).alias("year"))


def blk_keys(s, d):
    return P.blocks(facts(s, d))


def blk_hot(s, d):
    rows = table(s, d, "part").select(F.concat(F.lit("title:"), "p_name").alias("scope"), F.col("p_partkey").cast("string").alias("uri"))
    return L.hot_scopes(rows, 32)


def part_facts(s, d) -> tuple[DataFrame, DataFrame]:
    """Parts as records of two sources, by the parity of their numbers, blocked by name, type and size."""
    p = table(s, d, "part")
    source = F.when(F.col("p_partkey") % 2 == 0, "even").otherwise("odd")
    rows = p.select(F.concat(source, F.lit("://part/"), F.col("p_partkey").cast("string")).alias("uri"), source.alias("source"), F.col("p_partkey").cast("string").alias("key"), F.lit(1).cast("bigint").alias("revision"), F.lit("part").alias("kind"), F.concat_ws(":", F.lit("title"), "p_name", "p_type", F.col("p_size").cast("string")).alias("scope"))
    return rows, rows.select("scope", "uri")


def link_pairs(s, d):
    rows, blocks = part_facts(s, d)
    return L.block_pairs(blocks, rows).select("a_uri", "b_uri")


def supports(s, d):
    """Facts are used several times and cost a Python step, so they are written once."""
    f = Cut(facts(s, d), "facts").df
    return L.supports(f, P.blocks(f))


def link_supports(s, d):
    return supports(s, d).groupBy("claim_id", "method").agg(F.count("*").alias("supports"), F.sum(F.size("inputs")).alias("inputs"))


def link_candidates(s, d):
    return L.candidates(supports(s, d))


def link_decided(s, d):
    """Candidates with the decision in force, where there is one."""
    found = Cut(supports(s, d), "supports").df
    events = found.select("claim_id").distinct().where(F.substring("claim_id", 4, 1) < "8").select("claim_id", F.lit(1).cast("bigint").alias("version"), F.when(F.substring("claim_id", 4, 1) < "6", "accepted").otherwise("retracted").alias("action"))
    return L.candidates(found, V.decisions(events)).select("claim_id", "supports", "action")


def link_current(s, d):
    """Supports found when half of the revisions were there, as far as all their records are still the same now."""
    v = table(s, d, "record_versions")
    half = (v.agg(F.max("revision")).first()[0] or 0) // 2
    f = Cut(P.project(live_records(v.where(F.col("revision") <= half)).select("source", "key", "revision", "payload")), "facts").df
    current = live_records(v).select("source", "key", "revision", F.lit(False).alias("deleted"))
    return L.current_supports(L.supports(f, P.blocks(f)), current).groupBy("claim_id", "method").agg(F.count("*").alias("supports"))


def _halves(s, d) -> tuple[dict, DataFrame]:
    """The state that the first half of the revisions gives, and the live records now."""
    v = table(s, d, "record_versions")
    half = (v.agg(F.max("revision")).first()[0] or 0) // 2
    state = PL.started(live_records(v.where(F.col("revision") <= half)).select("source", "key", "revision", "payload"))
    return state | {"supports": Cut(state["supports"], "supports").df}, Cut(live(s, d), "live").df


def pip_project(s, d):
    """Supports by claim after the second half of the revisions came as changes: as many as from scratch."""
    state, now = _halves(s, d)
    return PL.reprojected(state, now)["supports"].groupBy("claim_id", "method").agg(F.count("*").alias("supports"))


def pip_candidates(s, d):
    """Claims with the revision of their evidence after both halves, those that lost all supports included."""
    state, now = _halves(s, d)
    after = PL.reprojected(state, now)["supports"]
    first = PL.bumped(s.createDataFrame([], "claim_id string, statement string, revision bigint"), after.limit(0), state["supports"])
    return PL.bumped(first, state["supports"], after).select("claim_id", "statement", (F.col("revision") > 0).alias("seen"))


def pip_dirty(s, d):
    v = table(s, d, "record_versions")
    half = (v.agg(F.max("revision")).first()[0] or 0) // 2
    old = live_records(v.where(F.col("revision") <= half)).select("source", "key", "revision", F.lit(PL.ENGINE).alias("engine"))
    return PL.dirty_records(live(s, d), old)


def link_with_input(s, d):
    return L.with_input(supports(s, d), "/idMal").groupBy("claim_id").agg(F.count("*").alias("supports"))


def link_identifiers(s, d):
    o = table(s, d, "orders")
    return o.select(bare_claim(F.concat(F.lit("orders://o/"), "o_orderkey"), F.concat(F.lit("customer://c/"), "o_custkey")).alias("statement"))


def link_division(s, d):
    """Orders with some part all of whose lines in that order have a low discount: a part is the support, its lines are the inputs."""
    lines = table(s, d, "lineitem").select("l_orderkey", "l_partkey", "l_discount", F.lit("shop").alias("source"), F.concat_ws("/", "l_orderkey", "l_partkey", "l_linenumber", "l_suppkey", "l_quantity", "l_discount").alias("key"), F.lit(1).cast("bigint").alias("revision")).distinct()
    found = lines.groupBy("l_orderkey", F.concat_ws("/", "l_orderkey", "l_partkey").alias("id")).agg(F.collect_set(F.struct("source", "key", "revision")).alias("inputs"))
    current = lines.where("l_discount <= 0.05").select("source", "key", "revision", F.lit(False).alias("deleted"))
    return L.current_supports(found, current).select("l_orderkey").distinct()


def link_status(s, d):
    return L.status(**{n: table(s, d, n) for n in ("record_versions", "records", "episodes", "unit_pairs", "sources")})


def evidence_lists(s, d):
    rows = table(s, d, "lineitem").select(F.col("l_orderkey").alias("claim_id"), F.concat_ws("|", "l_linenumber", "l_partkey", "l_suppkey").alias("id"), F.lit("line").alias("method"), F.array(F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")).alias("inputs")).distinct()
    return L.evidence_json(rows)


def claim_canonical_id(s, d):
    return link_identifiers(s, d).select("statement", claim_id(F.col("statement")).alias("claim_id"))


def claim_directional_id(s, d):
    o = table(s, d, "orders")
    text = bare_claim(F.concat(F.lit("orders://o/"), "o_orderkey"), F.concat(F.lit("customer://c/"), "o_custkey"), "=>")
    return o.select(text.alias("statement")).select("statement", claim_id(F.col("statement")).alias("claim_id"))


def dsl_parse(s, d):
    rows = table(s, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.max("o_orderkey").alias("k"))
    text = F.concat(F.lit("z://o/"), "k", F.lit(" :: line={b,a,b},at=1..3 @"), F.col("n") * 4, F.lit("  <~>   [a://c/"), "o_custkey", F.lit(" @"), F.col("n") * 6, F.lit(",a://d/1 @"), F.col("n") * 2, F.lit("]\n"))
    p = rows.select("o_custkey", parsed()(text).alias("p"))
    return p.select("o_custkey", F.col("p.canonical").alias("canonical"), F.col("p.claim_id").alias("claim_id"), F.size("p.selections").alias("selections"))


def dsl_rejects(s, d):
    """Statements with one fault each, by number: which are refused, row by row."""
    k = F.col("c_custkey")
    good = F.concat(F.lit("a://"), k.cast("string"), F.lit(" <=> b://"), k.cast("string"))
    text = (
        F.when(k % 7 == 0, F.replace(good, F.lit(" <=> "), F.lit("<=>"))).when(k % 7 == 1, F.concat(good, F.lit(" "))).when(k % 7 == 2, F.concat(good, F.lit(" @0")))
        .when(k % 7 == 3, F.concat(good, F.lit(" :: n={}"))).when(k % 7 == 4, F.concat(good, F.lit(" :: n=1..2,m=*"))).when(k % 7 == 5, F.concat(F.lit("# why\n"), good, F.lit("\n"))).otherwise(good)
    )
    return table(s, d, "customer").select("c_custkey", parsed()(text).alias("p")).select("c_custkey", F.col("p.ok").alias("ok"))


def dsl_documents(s, d):
    """Documents of two records each, by the table function in SQL."""
    from .. import sql

    sql.register(s)
    k = F.col("o_orderkey").cast("string")
    text = F.concat(F.lit("# first\n#@by x\na://"), k, F.lit(" @2 <~> b://1 @4\nc://"), k, F.lit("  =>  b://2\n"))
    docs = table(s, d, "orders").select("o_orderkey", text.alias("text"))
    return s.sql("SELECT o_orderkey, r.record, r.canonical, r.claim_id, r.metadata FROM {docs} d, LATERAL parse_document(d.text) r", docs=docs)


def dsl_references(s, d):
    rows = table(s, d, "unit_pairs").select(F.explode(F.array("left_unit", "right_unit")).alias("u")).where("u IS NOT NULL")
    return rows.groupBy(is_reference(F.col("u")).alias("ok")).agg(F.count("*").alias("n"))


def dsl_claim_ids(s, d):
    return table(s, d, "unit_pairs").where("claim_id IS NOT NULL").select("claim_id", is_claim_id(F.col("claim_id")).alias("ok"))


def dsl_extent_gcd(s, d):
    """What the extents of an order's lines have in common."""
    rows = table(s, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.sum("l_quantity").cast("bigint").alias("q")).groupBy("l_orderkey").agg(F.collect_list("q").alias("q"))
    return rows.select("l_orderkey", common_divisor(F.col("q")).alias("divisor"))


QUERIES = {f.__name__: f for f in (fact_project, fact_titles, fact_identifiers, fact_normalize, fact_year_guard, blk_keys, blk_hot, link_pairs, link_supports, link_candidates, link_decided, link_current, pip_project, pip_candidates, pip_dirty, link_with_input, link_identifiers, link_division, link_status, evidence_lists, claim_canonical_id, claim_directional_id, dsl_parse, dsl_rejects, dsl_documents, dsl_references, dsl_claim_ids, dsl_extent_gcd)}

_FACTS = r"""
v AS (SELECT source, lower(regexp_replace(key, '^\s+|\s+$', '', 'g')) AS key, revision, payload, deleted FROM record_versions),
gone AS (SELECT source, key, max(revision) AS r FROM v WHERE deleted GROUP BY ALL),
lived AS (SELECT v.source, v.key, max(v.revision) AS r FROM v LEFT JOIN gone USING (source, key) WHERE v.deleted = false AND (gone.r IS NULL OR v.revision > gone.r) GROUP BY ALL),
head AS (SELECT source, key, max(revision) AS revision FROM v GROUP BY ALL),
raw AS (SELECT lived.source, lived.key, head.revision, max(payload) AS p FROM lived JOIN head USING (source, key) JOIN v ON v.source = lived.source AND v.key = lived.key AND v.revision = lived.r WHERE payload IS NOT NULL GROUP BY ALL),
plain AS (SELECT source, key, revision, CASE WHEN json_type(p) = 'VARCHAR' THEN p::json->>'$' ELSE p END AS p FROM raw),
rec AS (SELECT source, key, revision, split_part(key, ':', 1) AS domain, CASE WHEN p->>'$.status' IS NOT NULL AND json_type(p, '$.data') = 'OBJECT' THEN p->>'$.data' ELSE p END AS p FROM plain),
f AS (SELECT source, key, revision, domain, p, json_type(p, '$.series') = 'OBJECT' IS TRUE AS inside, source || '://' || replace(key, ':', '/') AS uri,
  CASE WHEN source = 'org.themoviedb' AND domain = 'movie' THEN 'movie' WHEN source = 'org.themoviedb' AND domain = 'tv' THEN 'series' WHEN source = 'com.thetvdb' AND domain = 'series' THEN 'series' WHEN source = 'com.thetvdb' AND domain = 'movie' THEN 'movie'
       WHEN source = 'co.anilist' AND p->>'$.format' = 'MOVIE' THEN 'movie' WHEN source = 'co.anilist' AND p->>'$.type' = 'ANIME' THEN 'series' WHEN source = 'co.anilist' THEN 'manga' ELSE 'unit' END AS kind,
  try_cast(substr(CASE WHEN source = 'org.themoviedb' AND domain = 'movie' THEN p->>'$.release_date' WHEN source = 'org.themoviedb' AND domain = 'tv' THEN p->>'$.first_air_date' WHEN source = 'com.thetvdb' AND domain = 'series' THEN coalesce(p->>'$.series.firstAired', p->>'$.firstAired')
       WHEN source = 'com.thetvdb' AND domain = 'movie' THEN p->>'$.year' WHEN source = 'co.anilist' THEN p->>'$.startDate.year' END, 1, 4) AS int) AS year FROM rec),
named AS (
  SELECT uri, '/title' AS field, p->>'$.title' AS t FROM f WHERE source = 'org.themoviedb' AND domain = 'movie' UNION ALL SELECT uri, '/original_title', p->>'$.original_title' FROM f WHERE source = 'org.themoviedb' AND domain = 'movie'
  UNION ALL SELECT uri, '/name', p->>'$.name' FROM f WHERE source = 'org.themoviedb' AND domain = 'tv' UNION ALL SELECT uri, '/original_name', p->>'$.original_name' FROM f WHERE source = 'org.themoviedb' AND domain = 'tv'
  UNION ALL SELECT uri, CASE WHEN inside THEN '/series/name' ELSE '/name' END, CASE WHEN inside THEN p->>'$.series.name' ELSE p->>'$.name' END FROM f WHERE source = 'com.thetvdb' AND domain = 'series' UNION ALL SELECT uri, '/name', p->>'$.name' FROM f WHERE source = 'com.thetvdb' AND domain = 'movie'
  UNION ALL SELECT uri, '/title/' || x, json_extract_string(p, '$.title.' || x) FROM f, (VALUES ('romaji'), ('english'), ('native')) AS l(x) WHERE source = 'co.anilist'),
titles AS (SELECT DISTINCT uri, field, trim(regexp_replace(lower(t), '[^\p{L}\p{N}]+', ' ', 'g')) AS value FROM named WHERE t IS NOT NULL AND trim(regexp_replace(lower(t), '[^\p{L}\p{N}]+', ' ', 'g')) <> ''),
listed AS (SELECT uri, inside, CASE WHEN inside THEN p->'$.series.remoteIds' ELSE p->'$.remoteIds' END AS r FROM f WHERE source = 'com.thetvdb'),
lists AS (SELECT uri, inside, CASE WHEN json_type(r) = 'ARRAY' THEN r::json[] WHEN r IS NULL OR json_type(r) = 'NULL' THEN [] ELSE [r] END AS l FROM listed),
remote AS (SELECT uri, inside, unnest(l) AS r, generate_subscripts(l, 1) - 1 AS n FROM lists),
ids AS (
  SELECT uri, '/external_ids/imdb_id' AS field, 'com.imdb://title/' || (p->>'$.external_ids.imdb_id') AS target FROM f WHERE source = 'org.themoviedb' AND domain IN ('movie', 'tv') AND regexp_matches(p->>'$.external_ids.imdb_id', '^tt[0-9]+$')
  UNION SELECT uri, '/external_ids/tvdb_id', 'com.thetvdb://' || CASE domain WHEN 'tv' THEN 'series' ELSE domain END || '/' || try_cast(p->>'$.external_ids.tvdb_id' AS bigint) FROM f WHERE source = 'org.themoviedb' AND domain IN ('movie', 'tv') AND try_cast(p->>'$.external_ids.tvdb_id' AS bigint) > 0
  UNION SELECT uri, '/idMal', 'net.myanimelist://' || CASE WHEN p->>'$.type' = 'MANGA' THEN 'manga/' ELSE 'anime/' END || try_cast(p->>'$.idMal' AS bigint) FROM f WHERE source = 'co.anilist' AND try_cast(p->>'$.idMal' AS bigint) > 0
  UNION SELECT uri, CASE WHEN inside THEN '/series' ELSE '' END || '/remoteIds/' || n || '/id', 'com.imdb://title/' || (r->>'$.id') FROM remote WHERE lower(r->>'$.sourceName') = 'imdb' AND regexp_matches(r->>'$.id', '^tt[0-9]+$')),
blocks AS (SELECT 'id:' || uri AS scope, uri FROM f UNION SELECT 'id:' || target, uri FROM ids UNION SELECT 'title:' || kind || ':' || year || ':' || value, uri FROM titles JOIN f USING (uri) WHERE year BETWEEN 1 AND 9999 AND kind <> 'unit')"""
_SUPPORTS = _FACTS + """,
hot AS (SELECT scope FROM blocks WHERE scope LIKE 'title:%' GROUP BY scope HAVING count(*) > 256),
pairs AS (SELECT b1.scope, a.uri AS u, b.uri AS w FROM blocks b1 JOIN blocks b2 ON b1.scope = b2.scope AND b2.uri > b1.uri JOIN f a ON a.uri = b1.uri JOIN f b ON b.uri = b2.uri
  WHERE a.source <> b.source AND (a.kind = b.kind OR a.kind = 'unit' OR b.kind = 'unit') AND b1.scope NOT IN (SELECT scope FROM hot)),
supports AS (
  SELECT least(uri, target) || ' <=> ' || greatest(uri, target) AS statement, 'explicit-identifier' AS method, field || target AS x FROM ids WHERE uri <> target
  UNION SELECT u || ' <=> ' || w, CASE WHEN scope LIKE 'id:%' THEN 'shared-identifier' ELSE 'title-year' END, scope FROM pairs),
claims AS (SELECT 'v1:' || sha256('catenary-claim:v1' || chr(0) || statement) AS claim_id, statement, method FROM supports)"""
SQL = {
    "fact_project": f"WITH {_FACTS} SELECT uri, kind, CASE WHEN year BETWEEN 1 AND 9999 THEN year END AS year, (SELECT count(*) FROM titles t WHERE t.uri = f.uri) AS titles, (SELECT count(*) FROM ids i WHERE i.uri = f.uri) AS identifiers FROM f",
    "fact_titles": f"WITH {_FACTS} SELECT uri, field, value FROM titles",
    "fact_identifiers": f"WITH {_FACTS} SELECT uri, field, target FROM ids",
    "fact_normalize": r"SELECT p_partkey, trim(regexp_replace(lower(p_name || ' ' || p_brand || ' ' || p_type), '[^\p{L}\p{N}]+', ' ', 'g')) AS title FROM part",
    "fact_year_guard": "SELECT o_orderkey, CASE WHEN o_custkey % 3 <> 0 THEN CAST(extract(year FROM o_orderdate) AS int) END AS year FROM orders",
    "blk_keys": f"WITH {_FACTS} SELECT scope, uri FROM blocks",
    "blk_hot": "SELECT 'title:' || p_name AS scope, count(*) AS members FROM part GROUP BY p_name HAVING count(*) > 32",
    "link_pairs": "WITH p AS (SELECT *, CASE WHEN p_partkey % 2 = 0 THEN 'even' ELSE 'odd' END || '://part/' || p_partkey AS uri FROM part), h AS (SELECT p_name, p_type, p_size FROM part GROUP BY ALL HAVING count(*) <= 256) SELECT a.uri AS a_uri, b.uri AS b_uri FROM p a JOIN p b USING (p_name, p_type, p_size) JOIN h USING (p_name, p_type, p_size) WHERE b.uri > a.uri AND a.p_partkey % 2 <> b.p_partkey % 2",
    "link_supports": f"WITH {_SUPPORTS} SELECT claim_id, method, count(*) AS supports, count(*) * CASE WHEN method = 'explicit-identifier' THEN 1 ELSE 2 END AS inputs FROM claims GROUP BY claim_id, method",
    "link_candidates": f"WITH {_SUPPORTS} SELECT claim_id, statement, count(*) AS supports, count(*) FILTER (method = 'explicit-identifier') AS explicit, count(*) FILTER (method = 'shared-identifier') AS shared, count(*) FILTER (method = 'title-year') AS titled FROM claims GROUP BY ALL",
    "link_current": f"""WITH {_SUPPORTS.replace('FROM record_versions)', 'FROM record_versions WHERE revision <= (SELECT max(revision) // 2 FROM record_versions))')},
now AS (SELECT source, key, revision FROM (SELECT source, key, max(revision) AS revision, max(revision) FILTER (deleted) AS dead, max(revision) FILTER (NOT deleted) AS born FROM (SELECT source, lower(regexp_replace(key, '^\\s+|\\s+$', '', 'g')) AS key, revision, deleted FROM record_versions) GROUP BY ALL) WHERE born > coalesce(dead, born - 1)),
ok AS (SELECT uri FROM f JOIN now USING (source, key, revision)),
sup AS (SELECT least(uri, target) || ' <=> ' || greatest(uri, target) AS statement, 'explicit-identifier' AS method, uri AS u, uri AS w, field || target AS x FROM ids WHERE uri <> target
  UNION SELECT u || ' <=> ' || w, CASE WHEN scope LIKE 'id:%' THEN 'shared-identifier' ELSE 'title-year' END, u, w, scope FROM pairs)
SELECT 'v1:' || sha256('catenary-claim:v1' || chr(0) || statement) AS claim_id, method, count(*) AS supports FROM sup WHERE u IN (SELECT uri FROM ok) AND w IN (SELECT uri FROM ok) GROUP BY ALL""",
    "link_with_input": f"WITH {_SUPPORTS} SELECT 'v1:' || sha256('catenary-claim:v1' || chr(0) || least(uri, target) || ' <=> ' || greatest(uri, target)) AS claim_id, count(*) AS supports FROM ids WHERE field = '/idMal' GROUP BY ALL",
    "link_identifiers": "SELECT least('orders://o/' || o_orderkey, 'customer://c/' || o_custkey) || ' <=> ' || greatest('orders://o/' || o_orderkey, 'customer://c/' || o_custkey) AS statement FROM orders",
    "link_division": "SELECT DISTINCT l_orderkey FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM lineitem m WHERE m.l_orderkey = l.l_orderkey AND m.l_partkey = l.l_partkey AND m.l_discount > 0.05)",
    "link_status": " UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS rows FROM {n}" for n in ("record_versions", "records", "episodes", "unit_pairs", "sources")),
    "evidence_lists": "SELECT l_orderkey AS claim_id, CAST(to_json(list({'id': id, 'method': 'line', 'inputs': [CAST(l_partkey AS varchar), CAST(l_suppkey AS varchar)]} ORDER BY id)) AS varchar) AS evidence FROM (SELECT DISTINCT l_orderkey, l_partkey, l_suppkey, l_linenumber || '|' || l_partkey || '|' || l_suppkey AS id FROM lineitem) GROUP BY l_orderkey",
    "claim_directional_id": "SELECT 'orders://o/' || o_orderkey || ' => customer://c/' || o_custkey AS statement, 'v1:' || sha256('catenary-claim:v1' || chr(0) || 'orders://o/' || o_orderkey || ' => customer://c/' || o_custkey) AS claim_id FROM orders",
    "dsl_parse": """WITH r AS (SELECT o_custkey, count(*) AS n, max(o_orderkey) AS k FROM orders GROUP BY o_custkey), c AS (SELECT o_custkey, '[a://c/' || o_custkey || ' @3,a://d/1] <~> z://o/' || k || ' :: at=1..3,line={a,b} @2' AS canonical FROM r)
SELECT o_custkey, canonical, 'v1:' || sha256('catenary-claim:v1' || chr(0) || canonical) AS claim_id, 3 AS selections FROM c""",
    "dsl_rejects": "SELECT c_custkey, c_custkey % 7 IN (4, 5, 6) AS ok FROM customer",
    "dsl_documents": """SELECT o_orderkey, 0 AS record, canonical, 'v1:' || sha256('catenary-claim:v1' || chr(0) || canonical) AS claim_id, '# first' || chr(10) || '#@by x' AS metadata FROM (SELECT o_orderkey, 'a://' || o_orderkey || ' <~> b://1 @2' AS canonical FROM orders)
UNION ALL SELECT o_orderkey, 1, canonical, 'v1:' || sha256('catenary-claim:v1' || chr(0) || canonical), '' FROM (SELECT o_orderkey, 'c://' || o_orderkey || ' => b://2' AS canonical FROM orders)""",
    "dsl_references": r"SELECT regexp_full_match(u, '[A-Za-z][A-Za-z0-9._-]*://[^\x00-\x20,<>\[\]\x7F]+') AS ok, count(*) AS n FROM (SELECT left_unit AS u FROM unit_pairs UNION ALL SELECT right_unit FROM unit_pairs) WHERE u IS NOT NULL GROUP BY 1",
    "dsl_claim_ids": r"SELECT claim_id, regexp_full_match(claim_id, 'v1:[0-9a-f]{64}') AS ok FROM unit_pairs WHERE claim_id IS NOT NULL",
    "dsl_extent_gcd": "WITH q AS (SELECT l_orderkey, CAST(sum(l_quantity) AS bigint) AS q FROM lineitem GROUP BY l_orderkey, l_linenumber) SELECT l_orderkey, list_reduce(list(q), lambda a, b: gcd(a, b)) AS divisor FROM q GROUP BY l_orderkey",
}
SQL["link_decided"] = f"WITH {_SUPPORTS} SELECT claim_id, count(*) AS supports, CASE WHEN substr(claim_id, 4, 1) < '6' THEN 'accepted' END AS action FROM claims GROUP BY claim_id"
_HALF = _SUPPORTS.replace("FROM record_versions)", "FROM record_versions WHERE revision <= (SELECT max(revision) // 2 FROM record_versions))")
_LIVE = "(SELECT source, key, revision FROM (SELECT source, key, max(revision) AS revision, max(revision) FILTER (deleted) AS dead, max(revision) FILTER (NOT deleted) AS born FROM (SELECT source, lower(regexp_replace(key, '^\\s+|\\s+$', '', 'g')) AS key, revision, deleted FROM record_versions{}) GROUP BY ALL) WHERE born > coalesce(dead, born - 1))"
SQL["pip_project"] = f"WITH {_SUPPORTS} SELECT claim_id, method, count(*) AS supports FROM claims GROUP BY claim_id, method"
SQL["pip_candidates"] = f"SELECT claim_id, statement, true AS seen FROM (WITH {_SUPPORTS} SELECT claim_id, statement FROM claims) UNION SELECT claim_id, statement, true FROM (WITH {_HALF} SELECT claim_id, statement FROM claims)"
SQL["pip_dirty"] = f"SELECT coalesce(a.source, b.source) AS source, coalesce(a.key, b.key) AS key FROM {_LIVE.format('')} a FULL JOIN {_LIVE.format(' WHERE revision <= (SELECT max(revision) // 2 FROM record_versions)')} b ON a.source = b.source AND a.key = b.key WHERE a.revision IS DISTINCT FROM b.revision"
SQL["claim_canonical_id"] = f"SELECT statement, 'v1:' || sha256('catenary-claim:v1' || chr(0) || statement) AS claim_id FROM ({SQL['link_identifiers']})"
