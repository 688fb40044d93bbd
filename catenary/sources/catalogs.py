"""Catalog feeds as DataFrames: dumps, pages, changes, hierarchies. Readers take files of answers; a live feed writes such files.

``register(spark)`` makes the streaming format ``catenary_pages`` known: pages of JSON answers in a folder, one offset a page, so
that a feed is resumed at the page after the last one committed.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ..functions.content import record_kind
from ..operators.facts import body
from ..operators.records import first_if_equal


def read_dumps(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """domain and id of dumps of newline-delimited JSON (compressed or not), by the kind of each dump. Adult dumps are of their
    plain kind."""
    out = None
    for kind, path in sorted(paths.items()):
        domain = "movie" if kind.endswith("movie") else "tv"
        rows = spark.read.schema("id bigint").json(path).where("id IS NOT NULL").select(F.lit(domain).alias("domain"), "id")
        out = rows if out is None else out.unionByName(rows)
    return out.distinct()


def asked_and_found(asked: DataFrame, found: DataFrame) -> DataFrame:
    """Each id asked for with its payload, or as confirmed absent; ids that were answered twice or not asked for come as violations."""
    twice = found.groupBy("id").agg(F.count("*").alias("n"), F.min("payload").alias("payload"))
    both = asked.select("id", F.lit(True).alias("asked")).join(twice, "id", "full_outer")
    return both.select("id", "payload", F.when(F.col("asked").isNull(), "not asked for").when(F.col("n") > 1, "answered twice").when(F.col("n").isNull(), "absent").otherwise("found").alias("state"))


def new_or_airing(ids: DataFrame, airing: DataFrame, checkpoint: int) -> DataFrame:
    """Ids above the checkpoint, and those in the airing schedule, once each."""
    return ids.where(F.col("id") > checkpoint).select("id").union(airing.select("id")).distinct()


def show_members(shows: DataFrame, payload: str = "payload") -> DataFrame:
    """parent, key, metadata of the seasons, episodes and groups that show payloads list: their descriptors name parent and address.
    Payloads may be encoded once more or wrapped, ids be numbers or text, and a list of one be a bare object."""
    plain = shows.select(body(F.col(payload)).alias("body"))
    show = F.get_json_object("body", "$.id")
    seasons = F.from_json(F.get_json_object("body", "$.seasons"), "array<struct<id:string,season_number:string,episodes:string>>")
    groups = F.from_json(F.get_json_object("body", "$.episode_groups.results"), "array<struct<id:string>>")
    rows = plain.select(F.concat(F.lit("tv:"), show).alias("parent"), show.alias("show"), seasons.alias("seasons"), groups.alias("groups"))
    season = rows.select("parent", "show", F.explode("seasons").alias("s")).where("s.id IS NOT NULL")
    address = F.concat_ws("/", F.lit("tv"), "show", F.lit("season"), F.col("s.season_number"))
    of_season = season.select("parent", F.concat(F.lit("season:"), F.col("s.id")).alias("key"), F.to_json(F.struct(address.alias("address"), "parent")).alias("metadata"))
    episode = season.select("parent", "show", "s", F.explode(F.from_json("s.episodes", "array<struct<id:string,episode_number:string>>")).alias("e")).where("e.id IS NOT NULL")
    of_episode = episode.select("parent", F.concat(F.lit("episode:"), F.col("e.id")).alias("key"), F.to_json(F.struct(F.concat_ws("/", address, F.lit("episode"), F.col("e.episode_number")).alias("address"), "parent", F.col("s.id").alias("season_id"))).alias("metadata"))
    group = rows.select("parent", F.explode("groups").alias("g")).where("g.id IS NOT NULL")
    of_group = group.select("parent", F.concat(F.lit("episode_group:"), "g.id").alias("key"), F.to_json(F.struct("parent")).alias("metadata"))
    return of_season.unionByName(of_episode).unionByName(of_group)


def update_changes(updates: DataFrame, series: DataFrame | None = None) -> DataFrame:
    """key and action (dirty or deleted) of update notices: recordType, recordId, methodInt, seriesId, mergeToId.

    Methods 1 and 2 make a record dirty, 3 deletes it (and makes the one it was merged into dirty); seasons and episodes also make
    their series dirty. A notice of season types makes every known series (``series``: key) dirty. A key that is both deleted and
    dirty was merged and is asked for again.
    """
    rows = updates.select(record_kind(F.col("recordType")).alias("kind"), "recordId", "methodInt", "seriesId", "mergeToId").where("kind IS NOT NULL")
    key = lambda kind, id: F.concat(kind, F.lit(":"), id.cast("string"))
    entry = lambda cond, k, action: F.when(cond, F.struct(k.alias("key"), F.lit(action).alias("action")))
    entries = F.array(
        entry(F.col("methodInt").isin(1, 2), key(F.col("kind"), F.col("recordId")), "dirty"),
        entry(F.col("methodInt") == 3, key(F.col("kind"), F.col("recordId")), "deleted"),
        entry((F.col("methodInt") == 3) & F.col("mergeToId").isNotNull(), key(F.col("kind"), F.col("mergeToId")), "dirty"),
        entry(F.col("kind").isin("season", "episode") & F.col("seriesId").isNotNull(), key(F.lit("series"), F.col("seriesId")), "dirty"),
    )
    flat = rows.select(F.explode(F.filter(entries, lambda x: x.isNotNull())).alias("c")).select("c.*")
    if series is not None:
        # one notice or none decides for all series; the series are not multiplied by the notices
        types = updates.where(F.lower("recordType").isin("seasontype", "seasontypes")).select(F.lit("series").alias("domain")).limit(1)
        flat = flat.unionByName(series.select("key", F.split_part("key", F.lit(":"), F.lit(1)).alias("domain")).join(types, "domain", "left_semi").select("key", F.lit("dirty").alias("action")))
    return flat.groupBy("key").agg(F.max("action").alias("action"))  # dirty comes after deleted


def episode_orders(pages: DataFrame) -> DataFrame:
    """series, order, episodes (JSON texts in the order delivered) of pages of ordered episodes: series, order, page, position, id,
    body. An episode that comes repeatedly is kept once if all its bodies are equal, else dropped."""
    kept = first_if_equal(pages.withColumn("at", F.struct("page", "position")), ("series", "order", "id"), F.col("body"), "at")
    return kept.groupBy("series", "order").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "body"))), lambda x: x["body"]).alias("episodes"))


def guarded_absences(absent: DataFrame, source: str, discovered: int, required: set[str], seen: set[str]) -> DataFrame:
    """What to do with records a full run did not see: films and shows of the catalog with unreliable lists are asked for again,
    others are deleted. A run that found nothing, or not all required domains, is no reason to delete."""
    if not discovered or required - seen:
        raise ValueError("a full run without records of every required domain cannot delete")
    recheck = F.lit(source == "org.themoviedb") & F.split_part("key", F.lit(":"), F.lit(1)).isin("movie", "tv")
    return absent.select("source", "key", F.when(recheck, "dirty").otherwise("deleted").alias("action"))


class _Page(InputPartition):
    def __init__(self, path: str, number: int):
        super().__init__(path)
        self.path, self.number = path, number


def _filesystem(folder: str):
    """The file system of a folder, local or of a cluster, and the folder's path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), os.path.abspath(folder))


def _pages(folder: str) -> list[str]:
    from pyarrow.fs import FileSelector

    files, at = _filesystem(folder)
    return sorted(f.path for f in files.get_file_info(FileSelector(at)) if f.base_name.endswith(".json"))


def _rows(folder: str, path: str, number: int) -> Iterator[tuple[int, str, str]]:
    with _filesystem(folder)[0].open_input_stream(path) as f:
        page = json.loads(f.read())
    for record in page.get("records", []):
        yield number, record["key"], json.dumps(record.get("payload"), ensure_ascii=False, separators=(",", ":"))


class PagesSource(DataSource):
    """Format ``catenary_pages``: option ``path``, a folder of pages {"records": [{"key", "payload"}]} in order of their names."""

    @classmethod
    def name(cls) -> str:
        return "catenary_pages"

    def schema(self) -> str:
        return "page bigint, key string, payload string"

    def reader(self, schema) -> DataSourceReader:
        return _BatchReader(self.options["path"])

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader(self.options["path"])


class _BatchReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[InputPartition]:
        return [_Page(p, i) for i, p in enumerate(_pages(self.path))]

    def read(self, partition: _Page) -> Iterator[tuple]:
        return _rows(self.path, partition.path, partition.number)


class _StreamReader(DataSourceStreamReader):
    def __init__(self, path: str):
        self.path = path

    def initialOffset(self) -> dict:
        return {"page": 0}

    def latestOffset(self) -> dict:
        return {"page": len(_pages(self.path))}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [_Page(p, i) for i, p in enumerate(_pages(self.path)) if start["page"] <= i < end["page"]]

    def commit(self, end: dict) -> None:
        pass

    def read(self, partition: _Page) -> Iterator[tuple]:
        return _rows(self.path, partition.path, partition.number)


def register(spark: SparkSession) -> None:
    from . import feeds

    spark.dataSource.register(PagesSource)
    feeds.register(spark)
