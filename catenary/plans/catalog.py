"""Queries of catalogs: units, entities, domains, default orders, over the records in force."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import catalog as C
from ..operators import resolve as R
from ..session import Cut
from .linking import _FACTS, live


def records(s: SparkSession, d: str) -> DataFrame:
    """Written once, as every kind of record is read from it by itself."""
    return Cut(C.bodies(live(s, d)), "bodies").df


def _said(entries) -> F.Column:
    return F.array_join(F.array_sort(F.transform(F.map_entries(entries), lambda x: F.concat_ws("=", x["key"], x["value"]))), ",")


def prj_units(s, d):
    return C.units(records(s, d)).select("entity", "reference", "level", "coordinate", _said("attributes").alias("attributes"))


def prj_entities(s, d):
    r = records(s, d)
    return C.entities(r, C.units(r)).select("entity", F.array_join("levels", ",").alias("levels"), _said("contexts").alias("contexts"), "complete")


def prj_domain(s, d):
    r = records(s, d)
    u = C.units(r)
    return C.domains(u, C.entities(r, u))


def prj_orders(s, d):
    return C.default_orders(records(s, d)).drop("observations")


def prj_observations(s, d):
    return C.default_orders(records(s, d)).select("order_ref", "reference", F.explode("observations").alias("o")).select("order_ref", "reference", "o.key", "o.field", "o.value")


def prj_violations(s, d):
    return C.unit_violations(records(s, d))


def _statements(s, d) -> dict[str, DataFrame]:
    """Statements over whole catalogs: a show's episodes from the first on in all its seasons against as many of a series, a series
    as a whole against itself, and media against themselves, backwards, with more or with an unknown dimension; with what they say."""
    r = records(s, d)
    u = Cut(C.units(r), "units").df
    e = Cut(C.entities(r, u), "entities").df
    dom = Cut(C.domains(u, e), "domain").df
    is_ = lambda kind: F.col("entity").rlike(f"^[a-z.]+://{kind}/[0-9]+$")
    x = F.col("entity")
    text = (
        F.when(is_("tv"), F.concat(x, F.lit(" :: episode=1..,season=* <~> x://all")))
        .when(is_("series"), F.concat(x, F.lit(" :: ** => x://all @2")))
        .when(is_("media"), F.concat(x, F.lit(" :: episode=3..1 <=> ["), x, F.lit("/episode/3,"), x, F.lit("/episode/2,"), x, F.lit("/episode/1]")))
        .when(is_("season"), F.concat(x, F.lit(" :: part=1 <~> x://all")))
    )
    texts = e.select(text.alias("statement")).where("statement IS NOT NULL")
    more = s.createDataFrame([("x://all", [], {}, False)], e.schema)
    return {"asked": Cut(R.selections(texts), "selections").df, "units": u, "entities": e.unionByName(more), "domain": dom}


def sem_resolve(s, d):
    t = _statements(s, d)
    members, _ = R.resolve(t["asked"], t["units"], t["entities"], t["domain"])
    return members.select("claim_id", "side", "leaf", F.col("place").cast("bigint").alias("place"), "reference", "coordinate")


def sem_errors(s, d):
    t = _statements(s, d)
    return R.resolve(t["asked"], t["units"], t["entities"], t["domain"])[1].select("claim_id", "kind").distinct()


def cor_verdicts(s, d):
    return R.compiled(**_statements(s, d))["verdicts"].select("claim_id", F.col("verdict").startswith("valid").alias("valid"))


def cor_edges(s, d):
    return R.compiled(**_statements(s, d))["edges"]


def cor_tails(s, d):
    return R.compiled(**_statements(s, d))["tails"].groupBy("claim_id", "side").agg(F.sum(F.col("extent") - F.col("covered")).cast("bigint").alias("rest"))


QUERIES = {f.__name__: f for f in (prj_units, prj_entities, prj_domain, prj_orders, prj_observations, prj_violations, sem_resolve, sem_errors, cor_verdicts, cor_edges, cor_tails)}

_LIST = lambda x: f"CASE json_type({x}) WHEN 'ARRAY' THEN ({x})::json[] WHEN 'OBJECT' THEN [{x}] ELSE [] END"
_HAS = lambda x: f"coalesce(json_type({x}) IN ('ARRAY', 'OBJECT'), false)"
_N = lambda x: f"try_cast({x} AS bigint)"
CATALOG = _FACTS + f""",
r AS (SELECT source, key, domain, regexp_replace(key, '^[^:]*:', '') AS native, uri AS entity, p FROM f),
tv AS (SELECT entity, key, p->'$.seasons' AS s, p->'$.episode_groups.results' AS g FROM r WHERE source = 'org.themoviedb' AND domain = 'tv'),
sl AS (SELECT entity, key, {_LIST('s')} AS l FROM tv),
sx AS (SELECT entity, key, unnest(l) AS s, generate_subscripts(l, 1) - 1 AS place FROM sl),
sr AS (SELECT native, key AS record, p->'$.episodes' AS own FROM r WHERE source = 'org.themoviedb' AND domain = 'season'),
seasons AS (SELECT entity, sx.key, place, s->>'$.id' AS id, {_N("s->>'$.season_number'")} AS number, record, CASE WHEN record IS NOT NULL THEN own ELSE s->'$.episodes' END AS e FROM sx LEFT JOIN sr ON native = s->>'$.id' WHERE json_type(s) = 'OBJECT'),
el AS (SELECT *, {_LIST('e')} AS l FROM seasons),
eps AS (SELECT entity, key, place, id AS season_id, number, record, unnest(l) AS e, generate_subscripts(l, 1) - 1 AS at_ FROM el),
ep AS (SELECT *, e->>'$.id' AS id, {_N("e->>'$.season_number'")} AS own, {_N("e->>'$.episode_number'")} AS n FROM eps WHERE json_type(e) = 'OBJECT'),
gl AS (SELECT entity, unnest({_LIST('g')}) AS g FROM tv),
gr AS (SELECT gl.entity, native AS grp, p->'$.groups' AS groups FROM gl JOIN r ON r.source = 'org.themoviedb' AND r.domain = 'episode_group' AND r.native = g->>'$.id'),
gx AS (SELECT entity, grp, unnest({_LIST('groups')}) AS g FROM gr),
ge AS (SELECT entity, grp, {_N("g->>'$.order'")} + 1 AS g, unnest({_LIST("g->'$.episodes'")}) AS e FROM gx),
alone AS (SELECT entity, unnest({_LIST("p->'$.episodes'")}) AS e FROM r WHERE source = 'org.themoviedb' AND domain = 'season'),
sv AS (SELECT entity, key, json_type(p, '$.series') = 'OBJECT' IS TRUE AS inside, CASE WHEN json_type(p, '$.series') = 'OBJECT' THEN p->'$.series' ELSE p::json END AS b, p->'$.episode_orders' AS o FROM r WHERE source = 'com.thetvdb' AND domain = 'series'),
series AS (SELECT entity, key, o, b->'$.seasons' AS s, (SELECT min_by(t->>'$.type', i) FROM (SELECT unnest(l) AS t, generate_subscripts(l, 1) AS i FROM (SELECT {_LIST("b->'$.seasonTypes'")} AS l)) WHERE t->>'$.id' = b->>'$.defaultSeasonType') AS kind FROM sv),
sn AS (SELECT entity, kind, unnest({_LIST('s')}) AS s FROM series WHERE kind <> ''),
ok_ AS (SELECT entity, key, kind, o, unnest(json_keys(o)) AS k FROM series WHERE kind <> '' AND json_type(o) = 'OBJECT'),
ol AS (SELECT entity, key, kind, k, {_LIST("(o->k)")} AS l FROM ok_),
ox AS (SELECT entity, key, kind, k, unnest(l) AS e, generate_subscripts(l, 1) - 1 AS place FROM ol),
oe AS (SELECT *, e->>'$.id' AS id, {_N("e->>'$.seasonNumber'")} AS season, {_N("CASE WHEN k = 'absolute' THEN e->>'$.absoluteNumber' ELSE e->>'$.number' END")} AS n FROM ox WHERE json_type(e) = 'OBJECT'),
media AS (SELECT entity, unnest([{{'t': 'ANIME', 'l': 'episode', 'n': {_N("p->>'$.episodes'")}}}, {{'t': 'MANGA', 'l': 'chapter', 'n': {_N("p->>'$.chapters'")}}}, {{'t': 'MANGA', 'l': 'volume', 'n': {_N("p->>'$.volumes'")}}}]) AS c, p->>'$.type' AS t FROM r WHERE source = 'co.anilist'),
units AS (
  SELECT entity, 'org.themoviedb://season/' || id AS reference, 'season' AS level, CAST(number AS varchar) AS coordinate, {{'season': CAST(number AS varchar), 'episode': NULL::varchar, 'group': NULL::varchar, 'episode_group': NULL::varchar, 'order': NULL::varchar, 'chapter': NULL::varchar, 'volume': NULL::varchar}} AS a FROM seasons WHERE number >= 0 AND id IS NOT NULL
  UNION ALL SELECT entity, 'org.themoviedb://episode/' || id, 'episode', number || '/' || n, {{'season': CAST(number AS varchar), 'episode': CAST(n AS varchar), 'group': NULL, 'episode_group': NULL, 'order': NULL, 'chapter': NULL, 'volume': NULL}} FROM ep WHERE own = number AND n >= 0 AND id IS NOT NULL AND season_id IS NOT NULL
  UNION ALL SELECT entity, 'org.themoviedb://episode/' || (e->>'$.id'), 'episode', e->>'$.episode_number', {{'season': NULL, 'episode': e->>'$.episode_number', 'group': NULL, 'episode_group': NULL, 'order': NULL, 'chapter': NULL, 'volume': NULL}} FROM alone WHERE e->>'$.id' IS NOT NULL AND {_N("e->>'$.episode_number'")} >= 0
  UNION ALL SELECT entity, 'org.themoviedb://episode/' || (e->>'$.id'), 'episode', g || '/' || ({_N("e->>'$.order'")} + 1), {{'season': NULL, 'episode': CAST({_N("e->>'$.order'")} + 1 AS varchar), 'group': CAST(g AS varchar), 'episode_group': grp, 'order': NULL, 'chapter': NULL, 'volume': NULL}} FROM ge WHERE g IS NOT NULL AND {_N("e->>'$.order'")} >= 0 AND e->>'$.id' IS NOT NULL
  UNION ALL SELECT entity, 'com.thetvdb://season/' || (s->>'$.id'), 'season', CAST({_N("s->>'$.number'")} AS varchar), {{'season': CAST({_N("s->>'$.number'")} AS varchar), 'episode': NULL, 'group': NULL, 'episode_group': NULL, 'order': CASE kind WHEN 'official' THEN 'aired' ELSE kind END, 'chapter': NULL, 'volume': NULL}} FROM sn WHERE s->>'$.id' IS NOT NULL AND {_N("s->>'$.number'")} >= 0
  UNION ALL SELECT entity, 'com.thetvdb://episode/' || id, 'episode', CASE WHEN k = 'absolute' THEN CAST(n AS varchar) ELSE season || '/' || n END, {{'season': CAST(season AS varchar), 'episode': CAST(n AS varchar), 'group': NULL, 'episode_group': NULL, 'order': CASE k WHEN 'official' THEN 'aired' ELSE k END, 'chapter': NULL, 'volume': NULL}} FROM oe WHERE season >= 0 AND n >= 0 AND id IS NOT NULL
  UNION ALL SELECT entity, entity || '/' || level || '/' || i, level, CAST(i AS varchar), {{'season': NULL, 'episode': CASE level WHEN 'episode' THEN CAST(i AS varchar) END, 'group': NULL, 'episode_group': NULL, 'order': NULL, 'chapter': CASE level WHEN 'chapter' THEN CAST(i AS varchar) END, 'volume': CASE level WHEN 'volume' THEN CAST(i AS varchar) END}} FROM (SELECT entity, c['l'] AS level, unnest(range(1, c['n'] + 1)) AS i FROM media WHERE c['t'] = t AND c['n'] > 0)),
bare AS (SELECT entity, bool_or(NOT {_HAS('e')}) AS bare FROM seasons GROUP BY entity),
entities AS (
  SELECT x.entity, coalesce(levels, '') AS levels, coalesce(contexts, '') AS contexts, coalesce(complete, false) AS complete FROM (SELECT entity FROM r UNION SELECT reference FROM units) x LEFT JOIN (
    SELECT tv.entity, CASE WHEN tv.entity IN (SELECT entity FROM gr) THEN 'season,group,episode' ELSE 'season,episode' END AS levels, 'episode_group=' AS contexts, {_HAS('s')} AND NOT coalesce(bare, false) AS complete FROM tv LEFT JOIN bare ON bare.entity = tv.entity
    UNION ALL SELECT entity, 'episode', '', {_HAS("p->'$.episodes'")} FROM r WHERE source = 'org.themoviedb' AND domain = 'season'
    UNION ALL SELECT entity, 'season,episode', 'order=' || CASE kind WHEN 'official' THEN 'aired' ELSE kind END, coalesce(list_contains(json_keys(o), kind), false) AND {_HAS('s')} AND NOT EXISTS (SELECT 1 FROM oe WHERE oe.entity = series.entity AND k = oe.kind AND NOT EXISTS (SELECT 1 FROM sn WHERE sn.entity = series.entity AND {_N("sn.s->>'$.number'")} = oe.season)) FROM series WHERE kind <> ''
    UNION ALL SELECT entity, CASE p->>'$.type' WHEN 'ANIME' THEN 'episode' WHEN 'MANGA' THEN 'chapter,volume' ELSE '' END, '', coalesce(p->>'$.type' = 'ANIME' AND {_N("p->>'$.episodes'")} >= 0, false) FROM r WHERE source = 'co.anilist') y ON x.entity = y.entity),
orders AS (
  SELECT ep.entity AS order_ref, NULL AS context, 'org.themoviedb://episode/' || ep.id AS reference, number AS season, ep.n AS episode, e->>'$.name' AS title, e->>'$.air_date' AS air_date, CASE WHEN tvdb > 0 THEN 'com.thetvdb://episode/' || tvdb END AS linked_reference,
    coalesce(record, ep.key) AS key, CASE WHEN record IS NULL THEN '/seasons/' || place ELSE '' END || '/episodes/' || at_ AS path, e, x.key AS linked_key, tvdb, NULL AS kind
  FROM ep LEFT JOIN (SELECT native, key, {_N("p->>'$.external_ids.tvdb_id'")} AS tvdb FROM r WHERE source = 'org.themoviedb' AND domain = 'episode') x ON x.native = ep.id AND tvdb > 0 WHERE own = number AND n >= 0 AND id IS NOT NULL AND season_id IS NOT NULL
  UNION ALL SELECT entity, 'order=' || CASE kind WHEN 'official' THEN 'aired' ELSE kind END, 'com.thetvdb://episode/' || id, season, n, e->>'$.name', e->>'$.aired', NULL, key, '/episode_orders/' || kind || '/' || place, e, NULL, NULL, kind
  FROM oe WHERE k = kind AND season >= 0 AND n >= 0 AND id IS NOT NULL AND EXISTS (SELECT 1 FROM sn WHERE sn.entity = oe.entity AND {_N("sn.s->>'$.number'")} = oe.season))"""
_ATTRIBUTES = "concat_ws(',', " + ", ".join(f"'{n}=' || a['{n}']" for n in ("chapter", "episode", "episode_group", "group", "order", "season", "volume")) + ")"
_VALUE = "CASE dimension " + " ".join(f"WHEN '{n}' THEN a['{n}']" for n in ("chapter", "episode", "episode_group", "group", "order", "season", "volume")) + " END"
DOMAIN = f"""dom AS (SELECT entity, dimension, value, row_number() OVER (PARTITION BY entity, dimension ORDER BY CASE WHEN NOT context AND regexp_full_match(value, '[0-9]+') THEN try_cast(value AS hugeint) END NULLS LAST, value) AS position FROM (
  SELECT DISTINCT entity, dimension, {_VALUE} AS value, false AS context FROM (SELECT u.entity, a, unnest(string_split(levels, ',')) AS dimension FROM units u JOIN entities USING (entity)) WHERE {_VALUE} IS NOT NULL
  UNION ALL SELECT DISTINCT entity, dimension, coalesce({_VALUE}, ''), true FROM (SELECT u.entity, a, split_part(contexts, '=', 1) AS dimension FROM units u JOIN entities USING (entity) WHERE contexts <> '')))"""
ASKED = f"""st AS (SELECT *, 'v1:' || sha256('catenary-claim:v1' || chr(0) || CASE kind WHEN 'tv' THEN entity || ' :: episode=1..,season=* <~> x://all' WHEN 'series' THEN entity || ' :: ** => x://all @2'
  WHEN 'media' THEN '[' || entity || '/episode/3,' || entity || '/episode/2,' || entity || '/episode/1] <=> ' || entity || ' :: episode=3..1' ELSE entity || ' :: part=1 <~> x://all' END) AS claim_id
  FROM (SELECT *, regexp_extract(entity, '://([a-z]+)/', 1) AS kind FROM entities WHERE regexp_full_match(entity, '[a-z.]+://(tv|series|media|season)/[0-9]+'))),
c AS (SELECT claim_id, kind, entity, contexts, complete, levels, reference, level, coordinate, a['season'] AS season, a['episode'] AS episode, count(*) AS times FROM st JOIN units USING (entity)
  WHERE (kind = 'tv' AND level = 'episode' AND a['episode_group'] IS NULL) OR (kind = 'series' AND complete AND 'order=' || a['order'] = contexts) OR (kind = 'media' AND levels = 'episode') GROUP BY ALL),
pos AS (SELECT c.*, ps.position AS sp, pe.position AS ep, (SELECT position FROM dom d WHERE d.entity = c.entity AND d.dimension = 'episode' AND d.value = '1') AS one FROM c LEFT JOIN dom ps ON ps.entity = c.entity AND ps.dimension = 'season' AND ps.value = c.season LEFT JOIN dom pe ON pe.entity = c.entity AND pe.dimension = 'episode' AND pe.value = c.episode),
sel AS (SELECT claim_id, kind, reference, coordinate, times, CAST(row_number() OVER (PARTITION BY claim_id ORDER BY CASE WHEN kind = 'media' THEN -ep ELSE 0 END, sp NULLS FIRST, ep NULLS FIRST, level, reference) - 1 AS bigint) AS place FROM pos p
  WHERE kind = 'series' OR (kind = 'tv' AND ep >= one AND EXISTS (SELECT 1 FROM c WHERE c.claim_id = p.claim_id AND c.episode = '1')) OR (kind = 'media' AND episode IN ('1', '2', '3') AND EXISTS (SELECT 1 FROM c WHERE c.claim_id = p.claim_id AND c.episode = '3')))"""
SQL = {
    "sem_resolve": f"""WITH {CATALOG}, {DOMAIN}, {ASKED} SELECT claim_id, CASE WHEN kind = 'media' THEN 1 ELSE 0 END AS side, CASE WHEN kind = 'media' THEN 3 ELSE 0 END AS leaf, place, reference, CASE WHEN kind = 'series' THEN coordinate END AS coordinate FROM sel
UNION ALL SELECT claim_id, 1, 1, 0, 'x://all', NULL FROM st WHERE kind <> 'media'
UNION ALL SELECT claim_id, 0, 3 - i, 0, st.entity || '/episode/' || i, NULL FROM st, (VALUES (1), (2), (3)) AS n(i) WHERE kind = 'media' AND st.entity || '/episode/' || i IN (SELECT entity FROM entities)""",
    "cor_verdicts": f"""WITH {CATALOG}, {DOMAIN}, {ASKED}, g AS (SELECT claim_id, count(*) AS n, sum(times) = count(DISTINCT coordinate) AS clear, count(DISTINCT reference) = count(*) AS once FROM sel GROUP BY claim_id)
SELECT claim_id, coalesce(kind <> 'season' AND n > 0 AND clear AND once, false) AS valid FROM st LEFT JOIN g USING (claim_id)""",
    "cor_edges": f"""WITH {CATALOG}, {DOMAIN}, {ASKED}, ok AS (SELECT claim_id, count(*) AS n FROM sel GROUP BY claim_id HAVING sum(times) = count(DISTINCT coordinate) AND count(DISTINCT reference) = count(*))
SELECT claim_id, '<=>' AS operator, reference AS "left", reference AS "right", '0/1' AS left_start, '1/1' AS left_end, '0/1' AS right_start, '1/1' AS right_end FROM sel JOIN ok USING (claim_id) WHERE kind = 'media'
UNION ALL SELECT claim_id, '<~>', reference, 'x://all', '0/1', '1/1', '0/1', '1/1' FROM sel JOIN ok USING (claim_id) WHERE kind = 'tv' AND place = 0
UNION ALL SELECT claim_id, '=>', reference, 'x://all', '0/1', '1/1', CASE place WHEN 0 THEN '0/1' ELSE '1/2' END, CASE place WHEN 0 THEN '1/2' ELSE '1/1' END FROM sel JOIN ok USING (claim_id) WHERE kind = 'series' AND place < 2""",
    "cor_tails": f"""WITH {CATALOG}, {DOMAIN}, {ASKED}, ok AS (SELECT claim_id, kind, count(*) AS n, CASE kind WHEN 'series' THEN 2 ELSE 1 END AS m FROM sel WHERE kind <> 'media' GROUP BY claim_id, kind HAVING sum(times) = count(DISTINCT coordinate) AND count(DISTINCT reference) = count(*))
SELECT claim_id, 'left' AS side, n - m AS rest FROM ok WHERE n > m UNION ALL SELECT claim_id, 'right', m - n FROM ok WHERE m > n""",
    "prj_units": f"WITH {CATALOG} SELECT entity, reference, level, coordinate, {_ATTRIBUTES} AS attributes FROM units",
    "prj_entities": f"WITH {CATALOG} SELECT entity, levels, contexts, complete FROM entities",
    "prj_domain": f"WITH {CATALOG}, {DOMAIN} SELECT entity, dimension, value, position FROM dom",
    "prj_orders": f"WITH {CATALOG} SELECT order_ref, context, reference, season, episode, title, air_date, linked_reference FROM orders",
    "prj_observations": f"""WITH {CATALOG} SELECT order_ref, reference, key, path || '/' || n AS field, CASE WHEN n = 'absoluteNumber' OR (n = 'number' AND kind IS NOT NULL) THEN CAST(episode AS varchar) ELSE json_extract_string(e, '$.' || n) END AS value FROM orders,
  LATERAL (SELECT unnest(CASE WHEN kind IS NULL THEN ['id', 'season_number', 'episode_number', 'name', 'air_date'] ELSE ['id', 'seasonNumber', CASE kind WHEN 'absolute' THEN 'absoluteNumber' ELSE 'number' END, 'name', 'aired'] END) AS n)
UNION ALL SELECT order_ref, reference, linked_key, '/external_ids/tvdb_id', CAST(tvdb AS varchar) FROM orders WHERE tvdb > 0""",
    "prj_violations": f"""WITH {CATALOG} SELECT DISTINCT entity, message FROM (
  SELECT entity, 'a season lacks its number or id' AS message FROM seasons WHERE number IS NULL OR number < 0 OR id IS NULL
  UNION ALL SELECT entity, 'an episode lacks its number or id' FROM ep WHERE n IS NULL OR n < 0 OR id IS NULL OR own IS NULL OR own < 0
  UNION ALL SELECT entity, 'an episode belongs to another season' FROM ep WHERE own >= 0 AND own <> number
  UNION ALL SELECT entity, 'the declared default order is absent' FROM series WHERE kind IS NULL OR kind = ''
  UNION ALL SELECT entity, 'an episode of an order lacks its number or id' FROM oe WHERE season IS NULL OR season < 0 OR n IS NULL OR n < 0 OR id IS NULL)""",
}
