"""Members of shows, however their payloads are spelled."""

import json

from catenary.plans.alignment import src_show_members


def test_all_spellings_and_kinds(spark, tmp_path):
    show = lambda n, **more: {"id": n, "seasons": [{"id": n * 10, "season_number": 1, "episodes": [{"id": n * 100, "episode_number": 2}]}], "episode_groups": {"results": [{"id": f"g{n}"}]}} | more
    bare = {"id": "6", "seasons": {"id": "60", "season_number": "1", "episodes": {"id": "600", "episode_number": "2"}}, "episode_groups": {"results": {"id": "g6"}}}
    payloads = [
        json.dumps(show(1), separators=(",", ":")), json.dumps(show(2), indent=1), json.dumps(json.dumps(show(3))), json.dumps({"status": "success", "data": show(4)}),
        json.dumps(dict(reversed(show(5).items()))), json.dumps(bare), json.dumps(json.dumps({"status": "success", "data": show(7)})), '{"reason":"not found"}', None,
        '{"id":8,"seasons":null}', '{"id":9,"seasons":[null,{"season_number":3}]}',
    ]
    rows = [("org.themoviedb", f" TV:{i} ", False, p) for i, p in enumerate(payloads)] + [("org.themoviedb", "tv:1", True, json.dumps(show(20))), ("com.thetvdb", "tv:1", False, json.dumps(show(21))), ("org.themoviedb", "movie:1", False, json.dumps(show(22)))]
    spark.createDataFrame(rows, "source string, key string, deleted boolean, payload string").write.parquet(f"{tmp_path}/record_versions.parquet")
    found = sorted(tuple(r) for r in src_show_members(spark, str(tmp_path)).collect())
    assert found == sorted((f"tv:{n}", key) for n in range(1, 8) for key in (f"season:{n}0", f"episode:{n}00", f"episode_group:g{n}"))
