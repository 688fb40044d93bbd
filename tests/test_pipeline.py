"""Evidence kept up to date step by step, hierarchies under accepted claims, decisions and what waits to be published."""

import json

from pyspark.sql import functions as F

from catenary.operators import pipeline as P

LIVE = "source string, key string, revision bigint, payload string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def film(source, n, revision, title, imdb=None, year="2001"):
    body = {"id": n, "title": title, "release_date": f"{year}-01-01", "external_ids": {"imdb_id": imdb}} if source == "org.themoviedb" else {"id": n, "name": title, "year": year, "remoteIds": [None, {"sourceName": "imdb", "id": imdb}]}
    return (source, f"movie:{n}", revision, json.dumps(body))


def test_changes_are_as_from_scratch(spark):
    first = [film("org.themoviedb", n, 1, f"Film {n % 4}", f"tt{n}") for n in range(8)] + [film("com.thetvdb", n, 1, f"Film {n % 4}", f"tt{n}") for n in range(6)]
    later = first[2:5] + [film("org.themoviedb", 0, 2, "Other", "tt0"), film("org.themoviedb", 5, 2, "Film 2", "tt99")] + first[8:12] + [film("com.thetvdb", 9, 2, "Film 1", "tt1"), film("com.thetvdb", 5, 3, "Film 3", None)]
    old, new = spark.createDataFrame(first, LIVE), spark.createDataFrame(later, LIVE)
    for most in (256, 3):
        state = P.reprojected(P.started(old, most=most), new, most=most)
        assert rows(state["supports"].select("id")) == rows(P.started(new, most=most)["supports"].select("id"))
        assert state["withdrawn"].count() > 0 and P.dirty_records(new, state["projected"]).count() == 0
    assert P.dirty_records(new, state["projected"], "2").count() == new.count()  # another engine makes everything anew
    changed = P.touched(P.started(old)["supports"], spark.createDataFrame([("org.themoviedb", "movie:5")], "source string, key string"))
    assert changed.count() >= 2


def test_revisions_of_candidates(spark):
    make = lambda *x: spark.createDataFrame([(i, c, f"s{c}") for i, c in x], "id string, claim_id string, statement string")
    none = spark.createDataFrame([], "claim_id string, statement string, revision bigint")
    one = P.bumped(none, make(("0", "0")).limit(0), make(("1", "a"), ("2", "a"), ("3", "b")))
    assert rows(one) == [("a", "sa", 2), ("b", "sb", 1)]
    assert rows(P.bumped(one, make(("1", "a"), ("2", "a"), ("3", "b")), make(("1", "a"), ("4", "c")))) == [("a", "sa", 3), ("b", "sb", 2), ("c", "sc", 1)]


ORDER = "order_ref string, context string, reference string, season bigint, episode bigint, title string, air_date string, linked_reference string"


def test_hierarchy(spark):
    tv, series = "org.themoviedb://tv/{}", "com.thetvdb://series/{}"
    out = []
    for n in (1, 2, 3):
        out += [(tv.format(n), None, f"org.themoviedb://episode/{n}{e}", 1, e, f"t{e}", f"2020-01-0{e}", None) for e in (1, 2, 3, 4)]
        out += [(series.format(n), "order=aired", f"com.thetvdb://episode/{n}{e}", 1 + (e > 2), 1 + (e - 1) % 2, f"t{e}", f"2020-01-0{e}", None) for e in (1, 2, 3, 4)]
    out += [(tv.format(2), None, "org.themoviedb://episode/29", 1, 1, "again", None, None)]  # a coordinate twice
    accepted = [("c1", 7, f"{series.format(1)} <=> {tv.format(1)}"), ("c2", 8, f"{series.format(2)} <=> {tv.format(2)}"), ("c3", 9, f"{series.format(3)} <~> {tv.format(3)}"), ("c4", 10, f"{series.format(4)} <=> {tv.format(4)}"), ("c5", 11, f"{series.format(3)} :: season=1 <=> {tv.format(3)}")]
    found, faults = P.hierarchy_supports(spark.createDataFrame(accepted, "claim_id string, version bigint, statement string"), spark.createDataFrame(out, ORDER))
    assert rows(found.select("statement", "method", "depends")) == [("com.thetvdb://series/1 :: episode=1..2,order=aired,season=1..2 <=> org.themoviedb://tv/1 :: episode=1..4,season=1", "default-order-structure:7", 7)]
    assert {r.claim_id for r in faults.collect()} == {"c2", "c4"}
    decisions = spark.createDataFrame([("c1", 7, "accepted"), ("c9", 3, "rejected")], "claim_id string, version bigint, action string")
    ends = spark.createDataFrame([("c1", tv.format(1)), ("c9", tv.format(1))], "claim_id string, uri string")
    claims = P.touched_claims(decisions, ends, spark.createDataFrame([(tv.format(1),)], "uri string"))
    assert rows(claims) == [("c1", 7)] and rows(P.queued_scopes(claims, ends.select("claim_id"))) == [("parent:c1",), ("policy:c1",), ("policy:c9",)]
    kept, fallen = P.invalidated(found, found.select(F.col("id").alias("support_id"), F.col("depends").alias("version")), claims)
    assert kept.count() == 0 and fallen.count() == 1


def test_decisions_and_publication(spark):
    event = "claim_id string, version bigint, record string, action string, note string"
    events = spark.createDataFrame([("a", 1, "ra", "accepted", "n"), ("b", 2, "rb", "accepted", "n")], event)
    ask = spark.createDataFrame([("c", "rc", "accepted", "better", "a"), ("b", "rb", "retracted", "wrong", None)], "claim_id string, record string, action string, note string, replaces string")
    out = P.saved_decisions(events, ask)
    assert rows(out["decisions"].select("claim_id", "version", "action", "record")) == [("a", 3, "rejected", "ra"), ("b", 4, "retracted", "rb"), ("c", 5, "accepted", "rc")]
    waiting = P.pending_decisions(out["pending"], out["decisions"])
    assert rows(waiting.select("claim_id", "generation", "file")) == [("a", 3, "write"), ("b", 4, "delete"), ("c", 5, "write")]
    again = P.saved_decisions(out["events"], ask.where("claim_id = 'b'"))
    assert rows(P.acknowledged(again["pending"].unionByName(out["pending"].where("claim_id <> 'b'")), waiting)) == [("b", 6)]
    policy = spark.createDataFrame([("{}", 4)], "document string, generation bigint")
    assert rows(P.set_policy(policy, "{}")) == [("{}", 4)] and rows(P.set_policy(policy, "x")) == [("x", 5)]
    consumers = spark.createDataFrame([("s", False, None, 5), ("t", False, None, 4), ("u", True, None, 9), ("v", False, "k", 9)], "source string, bootstrap boolean, after_key string, revision bigint")
    heads = spark.createDataFrame([(x, 5) for x in "stuv"], "source string, revision bigint")
    assert rows(P.pending_consumers(consumers, heads)) == [("t",), ("u",), ("v",)]
    scopes = spark.createDataFrame([("policy:1",), ("policy",), ("policy;",), ("parent:1",)], "scope string")
    assert rows(scopes.where(P.in_prefix(F.col("scope"), "policy:"))) == [("policy:1",)]


def test_commands(spark, tmp_path, capsys):
    """Linking in two steps, a decision, and what is published of it."""
    from catenary import __main__ as cli

    feed = "source string, key string, revision bigint, payload string, hash string, deleted boolean, metadata string"
    write = lambda d, *films: spark.createDataFrame([(s, k, r, p, "h", False, "{}") for s, k, r, p in films], feed).write.parquet(f"{tmp_path}/{d}/record_versions.parquet")
    one = (film("org.themoviedb", 1, 1, "A", "tt1"), film("com.thetvdb", 1, 1, "A", "tt1"))
    write("a", *one)
    write("b", *one, film("com.thetvdb", 1, 2, "B", "tt2"))
    cli.sync(spark, f"{tmp_path}/a", f"{tmp_path}/state")
    cli.sync(spark, f"{tmp_path}/b", f"{tmp_path}/state")
    withdrawn = [json.loads(line) for line in capsys.readouterr().out.splitlines()]
    assert {w["method"] for w in withdrawn} == {"explicit-identifier", "shared-identifier", "title-year"}
    (tmp_path / "claim.txt").write_text("b://1 <=> a://1\n")
    cli.decide(spark, f"{tmp_path}/state", f"{tmp_path}/claim.txt", "rejected", "no")
    cli.decide(spark, f"{tmp_path}/state", f"{tmp_path}/claim.txt", "accepted", "yes")
    from catenary.operators import review
    from catenary.sources.sinks import Ledger

    events = Ledger(spark, f"{tmp_path}/state/events").read()
    assert rows(review.decisions(events).select("version", "action")) == [(2, "accepted")] and events.count() == 2
