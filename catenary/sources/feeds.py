"""Catalogs' interfaces as Spark data sources: what ``plans`` plans is asked for by ``http``'s client inside tasks.

Format ``catenary_feed``, with the options ``feed``, ``base`` (an address; also file:// for stored answers) and those of the feed:

* ``exports``: dated dumps (``day``), gzip, a JSON object a line: the day before's films and shows, adult ones under their plain kind
* ``changes``: changed ids in windows of days from a day before ``watermark`` to ``until`` (seconds), page by page
* ``lists``: paged lists of ``domains``; each page names the next, which must go forward
* ``ids``: media by ranges of ids above ``after`` up to ``latest``
* ``airing``: the airing schedule from ``watermark`` (less two weeks) to ``until``, windows halved until their pages fit

Columns: key (domain:id), payload (JSON, null where only the id is told) and request (the address that said so). A request or a chain
of pages is one partition, so that tasks ask side by side, each at the pace that ``interval`` sets for it. ``fetched`` asks for single
records by their addresses and tells confirmed absences. Answers of other catalogs than asked for, or with other ids, are errors.
"""

from __future__ import annotations

import gzip
import json
from collections.abc import Iterator
from datetime import date

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from . import plans
from .http import Client


def _json(client: Client, url: str):
    body = client.get(url)
    return None if body is None else json.loads(body)


def _text(value) -> str:
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"))


class _Request(InputPartition):
    def __init__(self, kind: str, *what):
        super().__init__((kind, *what))
        self.kind, self.what = kind, what


class FeedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "catenary_feed"

    def schema(self) -> str:
        return "key string, payload string, request string"

    def reader(self, schema) -> DataSourceReader:
        return _FeedReader({k.lower(): v for k, v in self.options.items()})


class _FeedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.o, self.base, self.interval = options, options["base"].rstrip("/"), float(options.get("interval", 0))

    def partitions(self) -> list[InputPartition]:
        feed = self.o["feed"]
        if feed == "exports":
            return [_Request(feed, "tv" if "tv" in name else "movie", f"{self.base}/p/exports/{name}") for name in plans.export_names(date.fromisoformat(self.o["day"]))]
        if feed == "changes":
            windows = plans.change_windows(int(self.o["watermark"]), int(self.o["until"]))
            return [_Request(feed, kind, str(a), str(b)) for kind in ("movie", "tv") for a, b in windows]
        if feed == "lists":
            return [_Request(feed, d) for d in plans.checked_domains(tuple(self.o["domains"].split(",")), plans.LISTED_DOMAINS)]
        if feed == "ids":
            return [_Request(feed, *r) for batch in plans.id_ranges(int(self.o["after"]), int(self.o["latest"])) for r in batch]
        if feed == "airing":
            client = Client(self.interval)
            pages = lambda a, b: int((_json(client, f"{self.base}/airing/{a}-{b}/1.json") or {}).get("lastPage", 0))
            return [_Request(feed, a, b) for a, b in plans.airing_windows(plans.airing_start(int(self.o["watermark"])), int(self.o["until"]), pages)]
        raise ValueError(f"no feed {feed}")

    def read(self, part: _Request) -> Iterator[tuple[str, str | None, str]]:
        client = Client(self.interval)
        if part.kind == "exports":
            domain, url = part.what
            for line in gzip.decompress(client.get(url) or gzip.compress(b"")).splitlines():
                if line.strip():
                    yield f"{domain}:{json.loads(line)['id']}", line.decode(), url
        elif part.kind == "changes":
            kind, first, last = part.what
            page = total = 1
            while page <= total:
                url = f"{self.base}/{kind}/changes/{first}_{last}/{page}.json"
                answer = _json(client, url) or {"results": [], "total_pages": 0}
                total = int(answer["total_pages"])
                if total > plans.CHANGE_PAGES:
                    raise ValueError(f"{total} pages of changes from {first} to {last}")
                for found in answer["results"]:
                    yield f"{kind}:{found['id']}", None, url
                page += 1
        elif part.kind == "lists":
            (domain,) = part.what
            page: int | None = 0
            while page is not None:
                url = f"{self.base}/{domain}/{page}.json"
                answer = _json(client, url)
                if answer is None:
                    return
                for found in answer["data"]:
                    yield f"{domain}:{found['id']}", _text(found), url
                page = plans.next_page((answer.get("links") or {}).get("next"), page)
        elif part.kind == "ids":
            first, last = part.what
            url = f"{self.base}/media/{first}-{last}.json"
            seen = set()
            for found in (_json(client, url) or {}).get("media", []):
                if not first <= found["id"] <= last or found["id"] in seen:
                    raise ValueError(f"{url}: {found['id']} was not asked for or comes twice")
                seen.add(found["id"])
                yield f"media:{found['id']}", _text(found), url
        else:
            first, last = part.what
            page, total = 1, 1
            while page <= total:
                url = f"{self.base}/airing/{first}-{last}/{page}.json"
                answer = _json(client, url) or {"lastPage": 0, "airingSchedules": []}
                total = int(answer["lastPage"])
                for found in answer["airingSchedules"]:
                    yield f"media:{found['mediaId']}", None, url
                page += 1


def fetched(wanted: DataFrame, base: str, interval: float = 0.0) -> DataFrame:
    """key, payload, state of records by address (columns key, address): ``found``, ``absent`` (the catalog has none), or
    ``unequal`` where the answer is another record, whose payload is not passed on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = Client(interval)
        for batch in batches:
            out = []
            for key, address in zip(batch.column("key").to_pylist(), batch.column("address").to_pylist()):
                answer = _json(client, f"{base.rstrip('/')}/{address}.json")
                if answer is None:
                    out.append((key, None, "absent"))
                elif str(answer.get("id")) != key.partition(":")[2]:
                    out.append((key, None, "unequal"))
                else:
                    out.append((key, _text(answer), "found"))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)] if out else [pa.array([], pa.string())] * 3, ["key", "payload", "state"])

    return wanted.where("key IS NOT NULL AND address IS NOT NULL").select("key", "address").mapInArrow(run, "key string, payload string, state string")


def rechecked(shows: DataFrame, members: DataFrame, base: str) -> DataFrame:
    """Members (key, metadata with parent and address) whose parentage a list only claims: asked for again by address; ``confirmed``
    tells whether the record is there and is the one."""
    rows = members.join(shows.select(F.col("key").alias("__show")).distinct(), F.get_json_object("metadata", "$.parent") == F.col("__show"), "left_semi")
    asked = fetched(rows.select("key", F.get_json_object("metadata", "$.address").alias("address")), base)
    return asked.select("key", (F.col("state") == "found").alias("confirmed"))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FeedSource)
