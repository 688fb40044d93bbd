"""Catalogs of units: what a record's payload says of its seasons, episodes, groups, chapters and volumes, and default orders.

``units``: entity, reference, level, attributes map<string,string>, coordinate. ``entities``: entity, levels, contexts map (name to
default), complete. ``domain``: entity, dimension, value, position. Records come as ``bodies`` gives them. What cannot be used is a
row of ``unit_violations``, not an exception: a number that is missing or no number, an episode under another season's number, a
series without its declared default order, a scope with too many units. Numbers may be spelled as text, and a bare object counts as a
list of one.

Payloads are parsed once for each kind, lists are exploded, and the record of a season stands in for what its show lists of it by a
join on the season's id; nothing is gathered by show.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.content import domain_of, key_uri
from .facts import ANILIST, TMDB, TVDB, body

#: Units of a scope, at most.
MOST_UNITS = 100_000

_EPISODES = "array<struct<id: string, season_number: string, episode_number: string, name: string, air_date: string>>"
# lists are read as texts and parsed by themselves, since only then a bare object is taken for a list of one
_SEASONS = "array<struct<id: string, season_number: string, episodes: string>>"
_GROUPS, _GROUPED = "array<struct<`order`: string, episodes: string>>", "array<struct<id: string, `order`: string>>"
_SERIES = "defaultSeasonType string, seasonTypes string, seasons string"
_TYPES, _NUMBERS = "array<struct<id: string, type: string>>", "array<struct<id: string, number: string>>"
_ORDERED = "array<struct<id: string, seasonNumber: string, number: string, absoluteNumber: string, name: string, aired: string>>"
_MEDIA = "type string, episodes string, chapters string, volumes string"
UNITS = ("entity", "reference", "level", "attributes", "coordinate")


def bodies(live: DataFrame) -> DataFrame:
    """source, key, revision, domain, native (id of the key), entity (uri) and body of each live record."""
    return live.select("source", "key", "revision", domain_of(F.col("key")).alias("domain"), F.regexp_replace("key", "^[^:]*:", "").alias("native"), key_uri(F.col("source"), F.col("key")).alias("entity"), body(F.col("payload")).alias("body"))


def _number(c: str | Column) -> Column:
    number = (F.col(c) if isinstance(c, str) else c).try_cast("bigint")
    return F.when(number >= 0, number)


def _list(path: str, schema: str) -> Column:
    return F.from_json(F.get_json_object("body", path), schema)


def _text(c: Column) -> Column:
    return c.cast("string")


def _map(**pairs: Column) -> Column:
    return F.create_map(*[x for name, value in pairs.items() for x in (F.lit(name), value)])


def _unit(rows: DataFrame, entity: Column, reference: Column, level: str, attributes: Column, coordinate: Column) -> DataFrame:
    return rows.select(entity.alias("entity"), reference.alias("reference"), F.lit(level).alias("level"), attributes.alias("attributes"), coordinate.alias("coordinate"))


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def tmdb_seasons(records: DataFrame) -> DataFrame:
    """entity, key, place and number of each season that a show lists, its id, and the episodes of its own record (``record``, its
    key) or else of the listing (``record`` null)."""
    shows = records.where((F.col("source") == TMDB) & (F.col("domain") == "tv")).select("entity", "key", "revision", _list("$.seasons", _SEASONS).alias("seasons"))
    listed = shows.select("entity", "key", "revision", F.posexplode("seasons").alias("place", "s")).where("s IS NOT NULL")
    own = records.where((F.col("source") == TMDB) & (F.col("domain") == "season")).select(F.col("native").alias("id"), F.col("key").alias("record"), _list("$.episodes", _EPISODES).alias("own"))
    listed = listed.select("entity", "key", "place", F.col("s.id").alias("id"), _number("s.season_number").alias("number"), F.from_json("s.episodes", _EPISODES).alias("listed"))
    return listed.join(own, "id", "left").select("entity", "key", "place", "id", "number", "record", F.when(F.col("record").isNotNull(), F.col("own")).otherwise(F.col("listed")).alias("episodes"))


def tmdb_units(records: DataFrame) -> DataFrame:
    """Units of shows (seasons, episodes, episodes of alternative groups) and of seasons."""
    ref = lambda kind, id: F.concat(F.lit(f"{TMDB}://{kind}/"), id.cast("string"))
    seasons = tmdb_seasons(records).where("number IS NOT NULL AND id IS NOT NULL")
    of_season = _unit(seasons, F.col("entity"), ref("season", F.col("id")), "season", _map(season=_text(F.col("number"))), _text(F.col("number")))
    episodes = seasons.select("entity", "number", F.explode("episodes").alias("e")).select("entity", "number", "e.id", _number("e.season_number").alias("own"), _number("e.episode_number").alias("n")).where("own = number AND n IS NOT NULL AND id IS NOT NULL")
    of_episode = _unit(episodes, F.col("entity"), ref("episode", F.col("id")), "episode", _map(season=_text(F.col("number")), episode=_text(F.col("n"))), F.concat_ws("/", "number", "n"))
    alone = records.where((F.col("source") == TMDB) & (F.col("domain") == "season")).select("entity", F.explode(_list("$.episodes", _EPISODES)).alias("e")).select("entity", "e.id", _number("e.episode_number").alias("n")).where("n IS NOT NULL AND id IS NOT NULL")
    of_alone = _unit(alone, F.col("entity"), ref("episode", F.col("id")), "episode", _map(episode=_text(F.col("n"))), _text(F.col("n")))
    groups = tmdb_groups(records).select("entity", "group", F.explode("groups").alias("g")).select("entity", "group", (_number("g.order") + 1).alias("g"), F.explode(F.from_json("g.episodes", _GROUPED)).alias("e"))
    groups = groups.select("entity", "group", "g", "e.id", (_number("e.order") + 1).alias("n")).where("g IS NOT NULL AND n IS NOT NULL AND id IS NOT NULL")
    of_group = _unit(groups, F.col("entity"), ref("episode", F.col("id")), "episode", _map(episode_group=F.col("group"), group=_text(F.col("g")), episode=_text(F.col("n"))), F.concat_ws("/", "g", "n"))
    return _union([of_season, of_episode, of_alone, of_group])


def tmdb_groups(records: DataFrame) -> DataFrame:
    """entity, group (id), groups: the alternative groups that a show lists and that have a record."""
    shows = records.where((F.col("source") == TMDB) & (F.col("domain") == "tv")).select("entity", F.explode(_list("$.episode_groups.results", "array<struct<id: string>>")).alias("g")).select("entity", F.col("g.id").alias("group")).where("group IS NOT NULL")
    bodies_ = records.where((F.col("source") == TMDB) & (F.col("domain") == "episode_group")).select(F.col("native").alias("group"), _list("$.groups", _GROUPS).alias("groups"))
    return shows.join(bodies_, "group")


def tvdb_series(records: DataFrame) -> DataFrame:
    """entity, key, inside (whether the series lies in an envelope beside its orders), kind (its declared default order), seasons, orders."""
    inner = F.get_json_object("body", "$.series")
    rows = records.where((F.col("source") == TVDB) & (F.col("domain") == "series")).select("entity", "key", inner.isNotNull().alias("inside"), F.from_json(F.coalesce(inner, F.col("body")), _SERIES).alias("p"), F.transform_values(_list("$.episode_orders", "map<string, string>"), lambda _, v: F.from_json(v, _ORDERED)).alias("orders"))
    kind = F.get(F.filter(F.from_json("p.seasonTypes", _TYPES), lambda t: t["id"] == F.col("p.defaultSeasonType")), F.lit(0))["type"]
    return rows.select("entity", "key", "inside", F.when(kind != "", kind).alias("kind"), F.from_json("p.seasons", _NUMBERS).alias("seasons"), "orders")


def _named_order(order: Column) -> Column:
    return F.when(order == "official", "aired").otherwise(order)


def _tvdb_episodes(series: DataFrame) -> DataFrame:
    flat = series.select("entity", "key", "kind", F.explode("orders").alias("order", "episodes")).select("entity", "key", "kind", "order", F.posexplode("episodes").alias("place", "e")).where("e IS NOT NULL")
    number = _number(F.when(F.col("order") == "absolute", F.col("e.absoluteNumber")).otherwise(F.col("e.number")))
    return flat.select("entity", "key", "kind", "order", "place", "e", F.col("e.id").alias("id"), _number("e.seasonNumber").alias("season"), number.alias("n"))


def tvdb_units(records: DataFrame) -> DataFrame:
    """Units of series: seasons of the default order, episodes of every order."""
    series = tvdb_series(records).where("kind IS NOT NULL")
    seasons = series.select("entity", "kind", F.explode("seasons").alias("s")).select("entity", "kind", "s.id", _number("s.number").alias("number")).where("number IS NOT NULL AND id IS NOT NULL")
    of_season = _unit(seasons, F.col("entity"), F.concat(F.lit(f"{TVDB}://season/"), "id"), "season", _map(season=_text(F.col("number")), order=_named_order(F.col("kind"))), _text(F.col("number")))
    episodes = _tvdb_episodes(series).where("season IS NOT NULL AND n IS NOT NULL AND id IS NOT NULL")
    coordinate = F.when(F.col("order") == "absolute", _text(F.col("n"))).otherwise(F.concat_ws("/", "season", "n"))
    of_episode = _unit(episodes, F.col("entity"), F.concat(F.lit(f"{TVDB}://episode/"), "id"), "episode", _map(season=_text(F.col("season")), episode=_text(F.col("n")), order=_named_order(F.col("order"))), coordinate)
    return of_season.unionByName(of_episode)


def anilist_units(records: DataFrame) -> DataFrame:
    """Units of series (episodes 1 to n) and of manga (chapters and volumes), as far as their numbers are known."""
    rows = records.where(F.col("source") == ANILIST).select("entity", F.from_json("body", _MEDIA).alias("p"))
    counted = lambda kind, dimension, field: F.when(F.col("p.type") == kind, F.struct(F.lit(dimension).alias("level"), _number(f"p.{field}").alias("n")))
    counts = rows.select("entity", F.explode(F.array(counted("ANIME", "episode", "episodes"), counted("MANGA", "chapter", "chapters"), counted("MANGA", "volume", "volumes"))).alias("c")).where("c.n > 0").select("entity", "c.level", "c.n")
    total = F.sum("n").over(Window.partitionBy("entity"))  # two rows at most
    flat = counts.withColumn("total", total).where(F.col("total") <= MOST_UNITS).select("entity", "level", F.explode(F.sequence(F.lit(1).cast("bigint"), "n")).alias("i"))
    return flat.select("entity", F.concat_ws("/", "entity", "level", "i").alias("reference"), "level", F.create_map("level", _text(F.col("i"))).alias("attributes"), _text(F.col("i")).alias("coordinate"))


def units(records: DataFrame) -> DataFrame:
    return _union([tmdb_units(records), tvdb_units(records), anilist_units(records)])


def _none() -> Column:
    return F.array().cast("array<string>")


def _empty() -> Column:
    return F.create_map().cast("map<string,string>")


def entities(records: DataFrame, found: DataFrame) -> DataFrame:
    """Every record, and every unit that is no record, as an entity: its levels, contexts with their defaults, and whether its
    hierarchy is complete."""
    shows = records.where((F.col("source") == TMDB) & (F.col("domain") == "tv")).select("entity", _list("$.seasons", _SEASONS).isNotNull().alias("listed"))
    bare = tmdb_seasons(records).groupBy("entity").agg(F.bool_or(F.col("episodes").isNull()).alias("bare"))
    grouped = tmdb_groups(records).select("entity", F.lit(True).alias("grouped")).distinct()
    of_tv = shows.join(bare, "entity", "left").join(grouped, "entity", "left").select(
        "entity", F.when(F.col("grouped"), F.array(*map(F.lit, ("season", "group", "episode")))).otherwise(F.array(F.lit("season"), F.lit("episode"))).alias("levels"),
        _map(episode_group=F.lit("")).alias("contexts"), (F.col("listed") & ~F.coalesce("bare", F.lit(False))).alias("complete"),
    )
    of_season = records.where((F.col("source") == TMDB) & (F.col("domain") == "season")).select("entity", F.array(F.lit("episode")).alias("levels"), _empty().alias("contexts"), _list("$.episodes", _EPISODES).isNotNull().alias("complete"))
    series = tvdb_series(records).where("kind IS NOT NULL")
    known = F.transform(F.filter("seasons", lambda s: s.isNotNull()), lambda s: s["number"].try_cast("bigint"))
    unlisted = F.exists(F.try_element_at("orders", F.col("kind")), lambda e: e.isNotNull() & ~F.coalesce(F.array_contains(F.col("known"), e["seasonNumber"].try_cast("bigint")), F.lit(False)))
    of_series = series.withColumn("known", known).select(
        "entity", F.array(F.lit("season"), F.lit("episode")).alias("levels"), _map(order=_named_order(F.col("kind"))).alias("contexts"),
        (F.coalesce(F.map_contains_key("orders", F.col("kind")), F.lit(False)) & F.col("seasons").isNotNull() & ~F.coalesce(unlisted, F.lit(False))).alias("complete"),
    )
    kind = F.get_json_object("body", "$.type")
    of_media = records.where(F.col("source") == ANILIST).select(
        "entity", F.when(kind == "ANIME", F.array(F.lit("episode"))).when(kind == "MANGA", F.array(F.lit("chapter"), F.lit("volume"))).otherwise(_none()).alias("levels"), _empty().alias("contexts"),
        F.coalesce((kind == "ANIME") & _number(F.get_json_object("body", "$.episodes")).isNotNull(), F.lit(False)).alias("complete"),
    )
    described = _union([of_tv, of_season, of_series, of_media])
    named = records.select("entity").union(found.select("reference")).distinct()
    return named.join(described, "entity", "left").select("entity", F.coalesce("levels", _none()).alias("levels"), F.coalesce("contexts", _empty()).alias("contexts"), F.coalesce("complete", F.lit(False)).alias("complete"))


def domains(found: DataFrame, described: DataFrame) -> DataFrame:
    """entity, dimension, value, position (from 1): of each level its distinct values, numbers by size before other texts; of each
    context its values in order of bytes, the empty one where a unit has none."""
    rows = found.select("entity", "attributes").join(described.where((F.size("levels") > 0) | (F.size("contexts") > 0)), "entity")
    of_level = rows.select("entity", "attributes", F.explode("levels").alias("dimension")).select("entity", "dimension", F.col("attributes")[F.col("dimension")].alias("value"), F.lit(False).alias("context")).where("value IS NOT NULL")
    of_context = rows.select("entity", "attributes", F.explode(F.map_keys("contexts")).alias("dimension")).select("entity", "dimension", F.coalesce(F.col("attributes")[F.col("dimension")], F.lit("")).alias("value"), F.lit(True).alias("context"))
    number = F.when(~F.col("context") & F.col("value").rlike("^[0-9]+$"), F.col("value").try_cast("decimal(38,0)"))
    order = Window.partitionBy("entity", "dimension").orderBy(number.asc_nulls_last(), "value")
    return of_level.unionByName(of_context).distinct().withColumn("position", F.row_number().over(order)).select("entity", "dimension", "value", "position")


def unit_violations(records: DataFrame) -> DataFrame:
    """entity and message of what a catalog cannot use of a record."""
    seasons = tmdb_seasons(records)
    episodes = seasons.select("entity", "number", F.explode("episodes").alias("e")).where("e IS NOT NULL")
    series = tvdb_series(records)
    counts = records.where(F.col("source") == ANILIST).select("entity", F.from_json("body", _MEDIA).alias("p")).select("entity", (F.when(F.col("p.type") == "ANIME", F.coalesce(_number("p.episodes"), F.lit(0))).when(F.col("p.type") == "MANGA", F.coalesce(_number("p.chapters"), F.lit(0)) + F.coalesce(_number("p.volumes"), F.lit(0)))).alias("n"))
    said = lambda d, message: d.select("entity", F.lit(message).alias("message"))
    doubled = records.groupBy("source", "entity").agg(F.count("*").alias("n")).where("n > 1")
    return _union([
        said(seasons.where("number IS NULL OR id IS NULL"), "a season lacks its number or id"),
        said(episodes.where(_number("e.episode_number").isNull() | F.col("e.id").isNull() | _number("e.season_number").isNull()), "an episode lacks its number or id"),
        said(episodes.where(_number("e.season_number") != F.col("number")), "an episode belongs to another season"),
        said(series.where("kind IS NULL"), "the declared default order is absent"),
        said(_tvdb_episodes(series.where("kind IS NOT NULL")).where("season IS NULL OR n IS NULL OR id IS NULL"), "an episode of an order lacks its number or id"),
        said(counts.where(F.col("n") > MOST_UNITS), "too many units"),
        said(doubled, "a reference has two records"),
    ]).distinct()


_OBSERVED = "array<struct<source: string, key: string, field: string, value: string>>"


def _observed(source: str, key: Column, prefix: Column, row: Column, fields: dict[str, str]) -> Column:
    return F.array(*[F.struct(F.lit(source).alias("source"), key.alias("key"), F.concat(prefix, F.lit(f"/{name}")).alias("field"), row[column].cast("string").alias("value")) for name, column in fields.items()])


def default_orders(records: DataFrame) -> DataFrame:
    """order_ref, context (order=... or null), reference, season, episode, title, air_date, linked_reference and observations (what
    is read of each episode, as JSON pointers into the records) of the default order of every show and series."""
    seasons = tmdb_seasons(records).where("number IS NOT NULL AND id IS NOT NULL")
    flat = seasons.select("entity", "number", F.coalesce("record", "key").alias("key"), F.when(F.col("record").isNotNull(), "").otherwise(F.concat(F.lit("/seasons/"), F.col("place").cast("string"))).alias("prefix"), F.posexplode("episodes").alias("at", "e"))
    flat = flat.select("*", _number("e.episode_number").alias("n"), F.col("e.id").alias("id")).where((_number("e.season_number") == F.col("number")) & F.col("n").isNotNull() & F.col("id").isNotNull())
    external = records.where((F.col("source") == TMDB) & (F.col("domain") == "episode")).select(F.col("native").alias("id"), F.col("key").alias("linked_key"), _number(F.get_json_object("body", "$.external_ids.tvdb_id")).alias("tvdb")).where("tvdb > 0")
    flat = flat.join(external, "id", "left")
    own = _observed(TMDB, F.col("key"), F.concat("prefix", F.lit("/episodes/"), F.col("at").cast("string")), F.col("e"), {n: n for n in ("id", "season_number", "episode_number", "name", "air_date")})
    linked = F.when(F.col("tvdb").isNotNull(), F.array(F.struct(F.lit(TMDB).alias("source"), F.col("linked_key").alias("key"), F.lit("/external_ids/tvdb_id").alias("field"), F.col("tvdb").cast("string").alias("value")))).otherwise(F.array().cast(_OBSERVED))
    one = flat.select(
        F.col("entity").alias("order_ref"), F.lit(None).cast("string").alias("context"), F.concat(F.lit(f"{TMDB}://episode/"), "id").alias("reference"), F.col("number").alias("season"), F.col("n").alias("episode"), F.col("e.name").alias("title"), F.col("e.air_date").alias("air_date"),
        F.when(F.col("tvdb").isNotNull(), F.concat(F.lit(f"{TVDB}://episode/"), F.col("tvdb").cast("string"))).alias("linked_reference"), F.concat(own, linked).alias("observations"),
    )
    series = tvdb_series(records).where("kind IS NOT NULL")
    listed = series.select("entity", F.explode("seasons").alias("s")).select("entity", _number("s.number").alias("season")).where("season IS NOT NULL").distinct()
    default = _tvdb_episodes(series).where("order = kind AND season IS NOT NULL AND n IS NOT NULL AND id IS NOT NULL").join(listed, ["entity", "season"], "left_semi")
    path = F.concat(F.lit("/episode_orders/"), "kind", F.lit("/"), F.col("place").cast("string"))
    numbering = F.when(F.col("kind") == "absolute", "absoluteNumber").otherwise("number")
    seen = F.array(*[F.struct(F.lit(TVDB).alias("source"), F.col("key"), F.concat(path, F.lit("/"), name).alias("field"), value.cast("string").alias("value")) for name, value in ((F.lit("id"), F.col("e.id")), (F.lit("seasonNumber"), F.col("e.seasonNumber")), (numbering, F.col("n")), (F.lit("name"), F.col("e.name")), (F.lit("aired"), F.col("e.aired")))])
    two = default.select(
        F.col("entity").alias("order_ref"), F.concat(F.lit("order="), _named_order(F.col("kind"))).alias("context"), F.concat(F.lit(f"{TVDB}://episode/"), "id").alias("reference"), "season", F.col("n").alias("episode"), F.col("e.name").alias("title"), F.col("e.aired").alias("air_date"),
        F.lit(None).cast("string").alias("linked_reference"), seen.alias("observations"),
    )
    return one.unionByName(two)
