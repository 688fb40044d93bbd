"""Feeds of catalogs from stored answers."""

import gzip
import json

import pytest

from catenary.sources import catalogs, feeds


@pytest.fixture
def answers(spark, tmp_path):
    catalogs.register(spark)

    def put(path, content):
        at = tmp_path / path
        at.parent.mkdir(parents=True, exist_ok=True)
        at.write_bytes(content if isinstance(content, bytes) else json.dumps(content).encode())

    def read(**options):
        found = spark.read.format("catenary_feed").options(base=f"file://{tmp_path}", **options).load()
        return sorted((r.key, r.payload) for r in found.collect())

    return put, read, f"file://{tmp_path}"


def test_exports(answers):
    put, read, _ = answers
    for kind, ids in (("movie", (1, 2)), ("tv_series", (7,)), ("adult_movie", (3,))):
        put(f"p/exports/{kind}_ids_02_29_2024.json.gz", gzip.compress("\n".join(json.dumps({"id": i}) for i in ids).encode()))
    assert [k for k, _ in read(feed="exports", day="2024-03-01")] == ["movie:1", "movie:2", "movie:3", "tv:7"]


def test_changes_by_pages_and_windows(answers):
    put, read, _ = answers
    put("movie/changes/1970-01-10_1970-01-21/1.json", {"results": [{"id": 5}], "total_pages": 2})
    put("movie/changes/1970-01-10_1970-01-21/2.json", {"results": [{"id": 6}], "total_pages": 2})
    put("tv/changes/1970-01-22_1970-01-25/1.json", {"results": [{"id": 9}], "total_pages": 1})
    assert read(feed="changes", watermark=str(86400 * 10), until=str(86400 * 24)) == [("movie:5", None), ("movie:6", None), ("tv:9", None)]


def test_lists_go_forward(answers):
    put, read, _ = answers
    put("series/0.json", {"data": [{"id": 1}], "links": {"next": "https://x/series?page=1"}})
    put("series/1.json", {"data": [{"id": 2, "name": "é"}], "links": {"next": None}})
    assert read(feed="lists", domains="series") == [("series:1", '{"id":1}'), ("series:2", '{"id":2,"name":"é"}')]
    put("series/1.json", {"data": [], "links": {"next": "https://x/series?page=1"}})
    with pytest.raises(Exception, match="forward"):
        read(feed="lists", domains="series")
    with pytest.raises(Exception, match="domains"):
        read(feed="lists", domains="series,series")


def test_ids_and_airing(answers):
    put, read, _ = answers
    put("media/4-53.json", {"media": [{"id": 4}, {"id": 50}]})
    put("media/54-60.json", {"media": [{"id": 60}]})
    assert [k for k, _ in read(feed="ids", after="3", latest="60")] == ["media:4", "media:50", "media:60"]
    put("media/54-60.json", {"media": [{"id": 61}]})
    with pytest.raises(Exception, match="not asked for"):
        read(feed="ids", after="3", latest="60")
    start = 20 * 86400 - 14 * 86400
    put(f"airing/{start}-{start + 10}/1.json", {"lastPage": 101, "airingSchedules": []})
    for a, b, n in ((start, start + 5, 1), (start + 5, start + 10, 2)):
        for page in range(1, n + 1):
            put(f"airing/{a}-{b}/{page}.json", {"lastPage": n, "airingSchedules": [{"mediaId": a + page}]})
    assert [k for k, _ in read(feed="airing", watermark=str(20 * 86400), until=str(start + 10))] == sorted(f"media:{x}" for x in (start + 1, start + 6, start + 7))


def test_fetch_by_address(spark, answers):
    put, _, base = answers
    put("tv/1/season/2/episode/3.json", {"id": 30, "n": 3})
    put("tv/1/season/2/episode/4.json", {"id": 99})
    wanted = spark.createDataFrame([("episode:30", "tv/1/season/2/episode/3"), ("episode:40", "tv/1/season/2/episode/4"), ("episode:50", "tv/1/season/2/episode/5"), (None, "x")], "key string, address string")
    assert sorted((r.key, r.payload, r.state) for r in feeds.fetched(wanted, base).collect()) == [("episode:30", '{"id":30,"n":3}', "found"), ("episode:40", None, "unequal"), ("episode:50", None, "absent")]
    members = catalogs.show_members(spark.createDataFrame([('{"id":1,"seasons":[{"id":20,"season_number":2,"episodes":[{"id":30,"episode_number":3},{"id":50,"episode_number":5}]}]}',)], "payload string")).where("key LIKE 'episode:%'")
    assert sorted(map(tuple, feeds.rechecked(spark.createDataFrame([("tv:1",)], "key string"), members, base).collect())) == [("episode:30", True), ("episode:50", False)]
