"""Record store, linking, alignment, graph, review, sinks and sources on small tables."""

import json
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from catenary.operators import align, graph, link, lookup, numbering, records, review, semantics
from catenary.operators.components import components
from catenary.operators.facts import blocks, project
from catenary.sources import catalogs
from catenary.sources.sinks import Ledger
from catenary.streaming import feeds

VERSIONS = "source string, key string, revision bigint, payload string, hash string, deleted boolean, metadata string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_pages(spark):
    v = spark.createDataFrame([("s", "media:1", 1, "{}", "a", False, "{}"), ("s", "media:2", 1, "{}", "b", False, "{}"), ("s", "media:1", 2, None, None, None, "{}"), ("s", "media:2", 2, "{}", "c", True, "{}")], VERSIONS)
    page = records.changes_page(v, "s", (0, None), 1, 1)
    assert [r.key for r in page.collect()] == ["media:1"]
    assert tuple(records.next_cursor(page, 1, 1).first()) == (1, "media:1", False)
    rest = records.changes_page(v, "s", (1, "media:1"), 1, 5)
    assert [r.key for r in rest.collect()] == ["media:2"] and tuple(records.next_cursor(rest, 1, 5).first()) == (1, None, True)
    filled = records.in_force(v)
    assert rows(filled.where("revision = 2").select("key", "hash", "deleted")) == [("media:1", "a", False), ("media:2", "c", True)]
    with pytest.raises(records.CursorExpired):
        records.changes_page(v, "s", (1, "media:1"), 2, floor=1)
    assert records.changes_page(v, "s", (1, None), 2, floor=1).count() == 2


def test_commit_and_observations(spark):
    v = spark.createDataFrame([("s", "m:1", 1, "{}", "a", False, '{"run_id":"x","mode":"full"}'), ("s", "m:2", 1, "{}", "b", False, "{}")], VERSIONS)
    seen = spark.createDataFrame([("s", "m:1", "{}", "a", False, '{"run_id":"y","materialized_at":9}'), ("s", "m:2", "{}", "b", False, '{"parent":"p"}'), ("s", "m:3", "{}", "c", False, "{}")], "source string, key string, payload string, hash string, deleted boolean, metadata string")
    new = records.observed_changes(records.latest(v), seen)
    assert rows(new.select("key", "hash")) == [("m:2", None), ("m:3", "c")]
    added = records.commit(v, new, 2)
    assert rows(added.select("key", "revision", "hash")) == [("m:2", 2, "b"), ("m:3", 2, "c")]
    again = records.observed_changes(records.latest(v.unionByName(added)), seen)
    assert again.count() == 0  # a replay makes no versions
    run = {"now": 20, "started": 10, "run_id": "r2", "mode": "full"}
    marked = {r.key: json.loads(r.metadata) for r in records.observed_changes(records.latest(v), seen, run).collect()}
    assert marked["m:3"] == {"domain": "m", "source": "s", "materialized_at": 20, "run_started_at": 10, "run_id": "r2", "mode": "full", "acquisition_version": 1, "content_changed_at": 20}
    assert marked["m:2"]["parent"] == "p" and marked["m:2"]["content_changed_at"] is None  # described otherwise, content as before
    etag = seen.where("key = 'm:2'").withColumn("metadata", F.lit('{"etag":"z"}'))
    assert records.observed_changes(records.latest(v), etag).count() == 1  # an etag is part of the description


def test_modes_scopes_and_commits(spark):
    asked = [(None, None, False, False, "full"), (5, None, False, False, "incremental"), (5, None, True, False, "full"), (5, "incremental", False, False, "incremental"), (5, "incremental", True, False, "refused"), (5, "incremental", True, True, "full"), (None, "full", False, False, "full"), (5, "full", True, False, "full")]
    df = spark.createDataFrame(asked, "watermark int, pending string, full boolean, restart boolean, expected string")
    assert df.where(records.run_mode(F.col("watermark"), F.col("pending"), F.col("full"), F.col("restart")) != F.col("expected")).count() == 0
    v = spark.createDataFrame([("s", f"m:{i}", 1, "{}", "a", False, '{"parent":"p:1"}') for i in range(4)] + [("s", "p:1", 1, "{}", "b", False, "{}")], VERSIONS)
    assert rows(records.scope_violations(v, 4)) == [("s", "p:1", 5)] and records.scope(v, "s", "p:1", 4).count() == 0 and records.scope(v, "s", "p:1").count() == 5
    page = records.bootstrap_page(records.latest(v), v, "s", "m:1", 2)
    assert [r.key for r in page.collect()] == ["m:2", "m:3"]
    batch = spark.createDataFrame([("s", "m:1", None, None, None, '{"parent":"p:2"}'), ("s", "m:9", "{}", "n", False, "{}")], "source string, key string, payload string, hash string, deleted boolean, metadata string")
    current = v.select("source", "key", "revision", "hash", "deleted", "metadata", F.lit("r1").alias("seen_run"))
    added, now = records.committed(v, current, batch, 2, "r2")
    assert rows(added.select("key", "hash", "revision")) == [("m:1", "a", 2), ("m:9", "n", 2)]
    assert rows(now.where("seen_run = 'r2'").select("key", "revision")) == [("m:1", 2), ("m:9", 2)] and now.count() == 6
    assert rows(records.run_counters(v, v.limit(3), batch)) == [("s", 5, 3, 2)]


def test_consumer_catches_up(spark):
    """First the current records by key, then the changes since; pages of two."""
    v = spark.createDataFrame([("s", f"m:{i}", 1 + i // 3, "{}", f"h{i}", False, "{}") for i in range(5)], VERSIONS)
    later = v.unionByName(spark.createDataFrame([("s", f"m:{i}", 3, "{}", "new", False, "{}") for i in (1, 3, 7)], VERSIONS))
    state, seen = None, []
    for table, head in [(v, 2)] + [(later, 3)] * 6:
        page, state = records.consumer_page(table, records.latest(table), "s", state, head, limit=2)
        seen.append([(r.key, r.revision) for r in page.orderBy("revision", "key").collect()])
    everything = [x for p in seen for x in p]
    assert {k for k, _ in everything} == {"m:0", "m:1", "m:2", "m:3", "m:4", "m:7"} and [("m:1", 3), ("m:3", 3), ("m:7", 3)] == [x for x in everything if x[1] == 3][-3:]
    assert state == {"bootstrap": False, "revision": 3, "after_key": None}
    with pytest.raises(records.CursorExpired):
        records.consumer_page(later, records.latest(later), "s", {"bootstrap": False, "revision": 1, "after_key": None}, 3, floor=2)


def test_violations(spark):
    b = spark.createDataFrame([("@x:1", "{}"), ("m:1", "[]"), ("m:1", "{}"), (None, None)], "key string, metadata string")
    assert {r.message for r in records.batch_violations(b, 3).collect()} == {"key must be domain:native", "metadata must be an object", "key occurs twice", "too many rows"}


def test_link(spark):
    p = lambda **x: json.dumps(x)
    live = spark.createDataFrame(
        [
            ("org.themoviedb", "movie:1", 1, p(id=1, title="The  Film!", release_date="2001-02-03", external_ids={"imdb_id": "tt01"})),
            ("com.thetvdb", "movie:9", 1, p(id=9, name="the film", year="2001", remoteIds={"sourceName": "IMDB", "id": "tt01"})),
            ("co.anilist", "media:3", 1, p(id=3, type="MANGA", title={"romaji": "X"}, idMal=7)),
            ("org.themoviedb", "season:3", 1, json.dumps(json.dumps({"id": 3}))),
        ],
        "source string, key string, revision bigint, payload string",
    )
    facts = project(live)
    assert rows(facts.select("uri", "kind", "year")) == [("co.anilist://media/3", "manga", None), ("com.thetvdb://movie/9", "movie", 2001), ("org.themoviedb://movie/1", "movie", 2001), ("org.themoviedb://season/3", "unit", None)]
    found = link.supports(facts, blocks(facts))
    pair = link.candidates(found).where("statement = 'com.thetvdb://movie/9 <=> org.themoviedb://movie/1'").first()
    assert (pair.supports, pair.shared, pair.titled) == (2, 1, 1)
    stale = link.current_supports(found, live.where("key <> 'movie:9'").withColumn("deleted", F.lit(False)))
    assert stale.where("method = 'title-year'").count() == 0
    hot = link.supports(facts, blocks(facts), most=1)
    assert hot.where("method = 'title-year'").count() == 0 and hot.where("method = 'shared-identifier'").count() == 1
    assert project(live.limit(0)).count() == 0


def test_large_scopes_of_identifiers(spark):
    uris = [("a" if i % 2 else "b" if i % 3 else "c", f"{'a' if i % 2 else 'b' if i % 3 else 'c'}://x/{i:03d}") for i in range(60)]
    facts = spark.createDataFrame([(u, s, u, 1, "movie") for s, u in uris], "uri string, source string, key string, revision bigint, kind string")
    scopes = facts.select(F.lit("id:t").alias("scope"), "uri")
    found = {(r.a_uri, r.b_uri) for r in link.block_pairs(scopes, facts, 10).collect()}
    assert len(found) <= 2 * 60 and all(a < b and a[0] != b[0] for a, b in found)
    near = {}
    for a, b in found:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    seen, open_ = set(), [uris[0][1]]
    while open_:
        seen.add(u := open_.pop())
        open_ += near.get(u, set()) - seen
    assert seen == {u for _, u in uris}  # all stay linked
    assert len(link.block_pairs(scopes, facts, 60).collect()) == sum(x[0] != y[0] for i, x in enumerate(uris) for y in uris[i + 1 :])


@pytest.mark.parametrize("seed", range(3))
def test_extents_against_cells(spark, seed):
    r = random.Random(seed)
    left, right, expected = [], [], []
    for claim in range(12):
        a, b = [r.randint(1, 5) for _ in range(r.randint(1, 6))], [r.randint(1, 5) for _ in range(r.randint(1, 6))]
        left += [(claim, i, x) for i, x in enumerate(a)]
        right += [(claim, i, x) for i, x in enumerate(b)]
        cells = list(zip([i for i, x in enumerate(a) for _ in range(x)], [i for i, x in enumerate(b) for _ in range(x)]))
        expected += [(claim, i, j, cells.count((i, j))) for i, j in sorted(set(cells))]
    make = lambda x: spark.createDataFrame(x, "claim_id int, ordinal int, extent bigint")
    found = align.align_extents(make(left), make(right))
    assert rows(found.select("claim_id", "left_ordinal", "right_ordinal", F.col("shared").cast("int"))) == sorted(expected, key=repr)
    tail = align.tails(make(left), make(right)).agg(F.sum(F.col("extent") - F.col("covered")).cast("int")).first()[0] or 0
    assert tail == sum(abs(sum(x for c, _, x in left if c == k) - sum(x for c, _, x in right if c == k)) for k in range(12))


EPISODES = "parent int, order_ref string, reference string, season bigint, episode bigint, title string, air_date string, linked_reference string"


def orders(spark, *seasons, prefix="l", linked=None):
    out, n = [], 0
    for s, size in seasons:
        for e in range(1, size + 1):
            n += 1
            out.append((1, f"{prefix}://o", f"{prefix}{n}", s, e, f"t{n}", f"2020-01-{n:02d}", (linked or {}).get(n)))
    return spark.createDataFrame(out, EPISODES)


def test_episode_runs(spark):
    one = align.aligned_statements(orders(spark, (1, 9)), orders(spark, (1, 3), (2, 3), (3, 3), prefix="r"))
    assert [r.statement for r in one.collect()] == ["l://o :: season=1,episode=1..9 <=> r://o :: season=1..3,episode=1..3"]
    two = align.aligned_statements(orders(spark, (4, 2), (5, 5)), orders(spark, (1, 7), prefix="r"))
    assert [r.statement for r in two.collect()] == ["[l://o :: season=4,episode=1..2,l://o :: season=5,episode=1..5] <=> r://o :: season=1,episode=1..7"]
    gone = align.aligned_statements(orders(spark, (1, 3), linked={2: "nowhere"}), orders(spark, (1, 3), prefix="r"))
    assert sorted(r.statement for r in gone.collect()) == ["l://o :: season=1,episode=1 <=> r://o :: season=1,episode=1", "l://o :: season=1,episode=3 <=> r://o :: season=1,episode=3"]
    assert align.order_violations(orders(spark, (1, 2), (1, 1)), ("parent",)).count() == 1


EDGE = "left string, left_start string, left_end string, right string, right_start string, right_end string"


def coverage(m, n):
    """m units of extent n against n units of extent m, as edges."""
    out, at = [], 0
    while at < m * n:
        i, j = at // n, at // m
        end = min((i + 1) * n, (j + 1) * m)
        place = lambda x, unit, extent: str(Fraction(x - unit * extent, extent)) if Fraction(x - unit * extent, extent).denominator > 1 else f"{Fraction(x - unit * extent, extent)}/1"
        out.append((f"a://{i}", place(at, i, n), place(end, i, n), f"b://{j}", place(at, j, m), place(end, j, m)))
        at = end
    return out


def test_atoms(spark):
    found = graph.atoms(spark.createDataFrame(coverage(3, 2), EDGE))
    assert found.agg(F.count_distinct("atom")).first()[0] == 4 and found.where("unit LIKE 'b%'").groupBy("unit").count().where("count = 2").count() == 2
    assert graph.conflicts(found).count() == 0
    both = coverage(1, 2) + [("b://0", "0/1", "1/1", "b://1", "0/1", "1/1")]  # the halves of a unit said to be the same
    assert graph.conflicts(graph.atoms(spark.createDataFrame(both, EDGE))).count() == 1
    rules = graph.implication_rules(found, spark.createDataFrame([("a://0", "0/1", "1/1", "b://0", "0/1", "2/3")], EDGE))
    assert rules.count() == 1
    groups = spark.createDataFrame([("c", 0, "b://0"), ("c", 1, "a://0")], "claim_id string, side int, unit string")
    rule = graph.group_rules(found, groups).first()
    assert rule.antecedent <= rule.consequent
    with pytest.raises(graph.LimitExceeded):  # different scales in a cycle cut for ever
        graph.cuts(spark.createDataFrame([("a://0", "0/1", "1/2", "b://0", "0/1", "1/1"), ("b://0", "0/1", "1/1", "a://0", "0/1", "1/3")], EDGE), max_cuts=12, max_rounds=9)


def test_components_and_numbers(spark):
    r = random.Random(7)
    edges = [(r.randint(0, 300), r.randint(0, 300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 440)] + [(5, 5), (900, 900)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    for hot in (10**6, 40):  # below and above the number of rows from which hubs are looked for
        assert rows(components(df, hot_rows=hot)) == sorted(((x, find(x)) for x in root), key=repr)
    hub = spark.range(500).select(F.lit("hub").alias("a"), F.concat(F.lit("n"), "id").alias("b")).union(spark.createDataFrame([("x", None), (None, None)], "a string, b string"))
    assert rows(components(hub, hot_rows=100).groupBy("root").count()) == [("hub", 501), ("x", 1)]
    order = numbering.numbered(spark.createDataFrame([(x,) for x in r.sample(range(999), 50)], "x int"), ("x",))
    assert [row.number for row in order.orderBy("x").collect()] == list(range(50))


def test_lookup_keeps_hot_keys(spark):
    left = spark.range(500).select((F.col("id") % 10).alias("k"), "id").union(spark.range(2000).select(F.lit(3).cast("bigint").alias("k"), "id")).union(spark.range(5).select(F.lit(None).cast("bigint").alias("k"), "id"))
    right = spark.range(8).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("inner", "left"):
        assert rows(lookup.lookup(left, right, "k", 2505, how, 100)) == rows(left.join(right, "k", how))


def test_selection(spark):
    units = spark.createDataFrame([("e", f"u{i}", "episode", {"season": str(1 + i // 10), "episode": str(1 + i % 10)}) for i in range(20)], "entity string, reference string, level string, attributes map<string,string>")
    domain = semantics.ranked_domain(units.select("entity", F.explode("attributes").alias("dimension", "value")))
    assert [r.value for r in domain.where("dimension = 'episode'").orderBy("position").collect()] == [str(i) for i in range(1, 11)]
    ask = [("q", "e", "episode", "season", "scalar", ["2"], None, None), ("q", "e", "episode", "episode", "range", [], "4", "2"), ("w", "e", "episode", "episode", "range", [], "9", None), ("w", "e", "episode", "season", "wildcard", [], None, None), ("x", "e", "episode", "season", "scalar", ["7"], None, None)]
    found = semantics.select_units(units, domain, spark.createDataFrame(ask, "question string, entity string, level string, dimension string, kind string, items array<string>, low string, high string"))
    got = {q: [r.reference for r in found.where(F.col("question") == q).orderBy("ordinal").collect()] for q in "qwx"}
    assert got["q"] == ["u13", "u12", "u11"] and sorted(got["w"]) == ["u18", "u19", "u8", "u9"] and got["x"] == []


def test_review(spark):
    assert review.parse_policy('{"format_version":1,"exclusive_source_pairs":[["b","a"]]}') == [("a", "b")]
    for bad in ("{}", '{"format_version":1,"exclusive_source_pairs":[["a","a"]]}', '{"format_version":1,"exclusive_source_pairs":[],"x":1}'):
        with pytest.raises(ValueError):
            review.parse_policy(bad)
    claims = spark.createDataFrame([("a://1 <=> b://1",), ("a://1 <=> b://2",), ("a://3 <=> c://1",)], "statement string")
    foot = review.footprint(review.endpoints(claims), review.policy_table(spark, [("a", "b")]))
    assert rows(review.policy_conflicts(foot)) == [("a://1", "b", 2)] and foot.count() == 4
    files = review.artifacts(claims.select(F.lit("v1:" + "0" * 64).alias("claim_id"), F.concat("statement", F.lit("\n")).alias("record"), F.lit("accepted").alias("action"), F.lit(None).cast("map<string,string>").alias("bindings")))
    checked = files.select(review.checked_artifact("path", "content").alias("c")).select("c.error").distinct().collect()
    assert [r.error for r in checked] == ["wrong path"]
    old, new = (spark.createDataFrame(x, "path string, content string") for x in ([("a", "1"), ("b", "1"), ("c", "1")], [("a", "1"), ("b", "2"), ("d", "1")]))
    assert rows(review.delta(old, new)) == [("b", "changed", "2"), ("c", "deleted", None), ("d", "added", "1")]
    pending = spark.createDataFrame([(i, "x" * 10) for i in range(30)], "claim_id int, record string")
    assert review.publication_batch(pending, files=20, most_bytes=75).count() == 7 and review.publication_batch(pending, files=5).count() == 5


def test_bindings(spark):
    resolved = spark.createDataFrame([("c", "a://1 :: x=1", ["a://2", "a://3"], None), ("c", "b://1 :: **", None, "unknown")], "claim_id string, selection_key string, units array<string>, error string")
    maps = review.binding_map(resolved)
    back = review.resolved_from(resolved.select("claim_id", "selection_key"), maps)
    assert rows(back) == [("c", "a://1 :: x=1", ["a://2", "a://3"]), ("c", "b://1 :: **", None)]


def test_ledger_and_pages(spark, tmp_path):
    ledger = Ledger(spark, f"file://{tmp_path}/ledger")
    assert ledger.append(spark.range(3), "r1") and not ledger.append(spark.range(9), "r1") and ledger.append(spark.range(2), "r2")
    assert ledger.read().count() == 5 and ledger.read("r1").count() == 3 and ledger.revisions() == ["r1", "r2"]
    folder = tmp_path / "pages"
    folder.mkdir()
    for i in range(3):
        (folder / f"{i:03d}.json").write_text(json.dumps({"records": [{"key": f"m:{i}", "payload": {"id": i}}]}))
    catalogs.register(spark)
    assert rows(spark.read.format("catenary_pages").option("path", str(folder)).load().select("page", "key")) == [(0, "m:0"), (1, "m:1"), (2, "m:2")]
    stream = lambda: spark.readStream.format("catenary_pages").option("path", str(folder)).load()
    feeds.run_to_end(stream(), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    (folder / "003.json").write_text(json.dumps({"records": [{"key": "m:3", "payload": None}]}))
    feeds.run_to_end(stream(), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 4  # the feed went on after its last page


def test_sources(spark):
    updates = spark.createDataFrame([("movies", 1, 1, None, None), ("series", 2, 3, None, 5), ("episodes", 3, 2, 9, None), ("companies", 4, 1, None, None)], "recordType string, recordId bigint, methodInt int, seriesId bigint, mergeToId bigint")
    assert rows(catalogs.update_changes(updates)) == [("episode:3", "dirty"), ("movie:1", "dirty"), ("series:2", "deleted"), ("series:5", "dirty"), ("series:9", "dirty")]
    show = spark.createDataFrame([('{"id":7,"seasons":[{"id":70,"season_number":1,"episodes":[{"id":700,"episode_number":2}]}],"episode_groups":{"results":[{"id":"g"}]}}',)], "payload string")
    assert [r.key for r in catalogs.show_members(show).orderBy("key").collect()] == ["episode:700", "episode_group:g", "season:70"]
    with pytest.raises(ValueError):
        catalogs.guarded_absences(show, "x", 0, set(), set())
    kept = records.first_if_equal(spark.createDataFrame([(1, 1, "a"), (1, 2, "a"), (2, 1, "a"), (2, 2, "b")], "id int, at int, body string"), ("id",), F.col("body"), "at")
    assert rows(kept) == [(1, 1, "a")]
