"""Facts of records: kind, year, titles, identifiers, and the blocks they are compared in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.content import TITLE_BYTES, domain_of, imdb_id, key_uri, normalize_title, positive_id, year_of

TMDB, TVDB, ANILIST, IMDB, MAL = "org.themoviedb", "com.thetvdb", "co.anilist", "com.imdb", "net.myanimelist"


_FIELDS = """title string, original_title string, release_date string, name string, original_name string, first_air_date string, firstAired string, year string,
format string, type string, idMal string, remoteIds string, startDate struct<year: string>, external_ids struct<imdb_id: string, tvdb_id: string>,
series struct<name: string, firstAired: string, remoteIds: string>"""

#: A source name that marks an IMDb id, whatever its case.
_IMDB_NAME = "imdb"


def body(payload: Column) -> Column:
    """The record in a payload that may be encoded once more or wrapped in an envelope {status, data}."""
    plain = F.when(F.ltrim(payload).startswith('"'), F.from_json(F.concat(F.lit('{"x":'), payload, F.lit("}")), "x string")["x"]).otherwise(payload)
    data = F.get_json_object(plain, "$.data")
    return F.when(F.get_json_object(plain, "$.status").isNotNull() & data.startswith("{"), data).otherwise(plain)


def project(live: DataFrame, normalize: Column | None = None) -> DataFrame:
    """uri, source, key, revision, kind, year, titles (field, value) and identifiers (field, target) of each live record.

    Fields by source: films and series have year and titles; everything else is a unit without them. Titles are normalised and
    not empty or over-long; identifiers name records of other catalogs, ingested or not.
    """
    rows = live.select("source", "key", "revision", F.from_json(body(F.col("payload")), _FIELDS).alias("p")).withColumn("domain", domain_of(F.col("key")))
    of_title = F.from_json("p.title", "romaji string, english string, native string")

    def at(path: str) -> Column:
        """A field of the payload, which is parsed once for all of them; a title may be a text or an object."""
        inner = path.removeprefix("$.").split(".", 1)
        return of_title[inner[1]] if inner[0] == "title" and len(inner) > 1 else F.col("p." + path.removeprefix("$."))

    tmdb, tvdb, anilist = (F.col("source") == s for s in (TMDB, TVDB, ANILIST))
    inner = F.col("p.series").isNotNull()  # a series may lie in an envelope beside its orders
    movie, tv, series = (F.col("domain") == d for d in ("movie", "tv", "series"))
    kind = (
        F.when(tmdb & movie, "movie").when(tmdb & tv, "series").when(tvdb & series, "series").when(tvdb & movie, "movie")
        .when(anilist & (at("$.format") == "MOVIE"), "movie").when(anilist & (at("$.type") == "ANIME"), "series").when(anilist, "manga").otherwise("unit")
    )
    year = (
        F.when(tmdb & movie, at("$.release_date")).when(tmdb & tv, at("$.first_air_date"))
        .when(tvdb & series, F.coalesce(at("$.series.firstAired"), at("$.firstAired"))).when(tvdb & movie, at("$.year")).when(anilist, at("$.startDate.year"))
    )
    title = lambda field, value: F.struct(F.lit(field).alias("field"), value.alias("value"))
    titles = (
        F.when(tmdb & movie, F.array(title("/title", at("$.title")), title("/original_title", at("$.original_title"))))
        .when(tmdb & tv, F.array(title("/name", at("$.name")), title("/original_name", at("$.original_name"))))
        .when(tvdb & series & inner, F.array(title("/series/name", at("$.series.name")))).when(tvdb & series, F.array(title("/name", at("$.name"))))
        .when(tvdb & movie, F.array(title("/name", at("$.name"))))
        .when(anilist, F.array(*[title(f"/title/{x}", at(f"$.title.{x}")) for x in ("romaji", "english", "native")]))
    )
    link = lambda field, ok, target: F.when(ok, F.struct(F.lit(field).alias("field"), target.alias("target")))
    imdb = imdb_id(at("$.external_ids.imdb_id"))
    of_tvdb, mal = positive_id(at("$.external_ids.tvdb_id")).cast("string"), positive_id(at("$.idMal")).cast("string")
    remote = F.from_json(F.when(inner, at("$.series.remoteIds")).otherwise(at("$.remoteIds")), "array<struct<sourceName:string,id:string>>")  # a bare object is a list of one
    prefix = F.when(inner, "/series").otherwise("")
    placed = F.transform(F.coalesce(remote, F.array()), lambda r, i: F.struct(r["sourceName"].alias("name"), r["id"].alias("id"), F.concat(prefix, F.lit("/remoteIds/"), i.cast("string"), F.lit("/id")).alias("field")))
    remote_imdb = F.transform(
        F.filter(placed, lambda r: (F.lower(r["name"]) == _IMDB_NAME) & r["id"].rlike("^tt[0-9]+$")),
        lambda r: F.struct(r["field"].alias("field"), F.concat(F.lit(f"{IMDB}://title/"), r["id"]).alias("target")),
    )
    own = F.array(
        link("/external_ids/imdb_id", tmdb & (movie | tv) & imdb.isNotNull(), F.concat(F.lit(f"{IMDB}://title/"), imdb)),
        link("/external_ids/tvdb_id", tmdb & movie & of_tvdb.isNotNull(), F.concat(F.lit(f"{TVDB}://movie/"), of_tvdb)),
        link("/external_ids/tvdb_id", tmdb & tv & of_tvdb.isNotNull(), F.concat(F.lit(f"{TVDB}://series/"), of_tvdb)),
        link("/idMal", anilist & mal.isNotNull(), F.concat(F.lit(f"{MAL}://"), F.when(at("$.type") == "MANGA", "manga/").otherwise("anime/"), mal)),
    )
    facts = rows.select(
        key_uri(F.col("source"), F.col("key")).alias("uri"), "source", "key", "revision", kind.alias("kind"), year_of(year).alias("year"), titles.alias("t"),
        F.array_distinct(F.concat(F.filter(own, lambda x: x.isNotNull()), F.when(tvdb, remote_imdb).otherwise(F.array()))).alias("identifiers"),
    )
    clean = normalize or normalize_title
    # normalising is a Python step: only rows with titles go through it, one title per row
    flat = facts.select("uri", F.explode("t").alias("x")).where("x.value IS NOT NULL").select("uri", "x.field", clean("x.value").alias("value")).where(F.octet_length("value").between(1, TITLE_BYTES))
    named = flat.groupBy("uri").agg(F.array_sort(F.collect_set(F.struct("field", "value"))).alias("titles"))  # a record has a handful of title fields
    return facts.drop("t").join(named, "uri", "left").withColumn("titles", F.coalesce("titles", F.array().cast("array<struct<field:string,value:string>>")))


def blocks(facts: DataFrame) -> DataFrame:
    """scope and uri: the record itself and what its identifiers name (``id:``), and its titles with kind and year (``title:``)."""
    ids = F.transform("identifiers", lambda i: F.concat(F.lit("id:"), i["target"]))
    titled = F.when(F.col("year").isNotNull() & (F.col("kind") != "unit"), F.transform("titles", lambda t: F.concat_ws(":", F.lit("title"), F.col("kind"), F.col("year").cast("string"), t["value"]))).otherwise(F.array())
    return facts.select(F.explode(F.array_distinct(F.concat(F.array(F.concat(F.lit("id:"), F.col("uri"))), ids, titled))).alias("scope"), "uri")
