"""Resolving selectors and compiling statements on a small catalog."""

import pytest
from pyspark.sql import functions as F

from catenary.operators import resolve

UNITS = "entity string, reference string, level string, attributes map<string,string>, coordinate string"


@pytest.fixture(scope="module")
def catalog(spark):
    units = [("a://show", f"a://s{s}", "season", {"season": str(s), "order": "aired"}, str(s)) for s in (0, 1, 2)]
    units += [("a://show", f"a://e{s}{e}", "episode", {"season": str(s), "episode": str(e), "order": "aired"}, f"{s}/{e}") for s in (1, 2) for e in range(1, 3 + s)]
    units += [("a://show", f"a://e{9 - i}", "episode", {"season": "1", "episode": str(i), "order": "dvd"}, f"d{i}") for i in (1, 2)]
    units += [("b://film", f"b://p{i}", "part", {"part": str(i)}, str(i)) for i in (1, 2, 3)]
    entities = [("a://show", ["season", "episode"], {"order": "aired"}, True), ("b://film", ["part"], {}, False), ("c://x", [], {}, False)] + [(u[1], [], {}, False) for u in units]
    u = spark.createDataFrame(units, UNITS)
    e = spark.createDataFrame(entities, "entity string, levels array<string>, contexts map<string,string>, complete boolean")
    from catenary.operators.catalog import domains

    return {"units": u, "entities": e, "domain": domains(u, e)}


def resolved(spark, catalog, *texts):
    asked = resolve.selections(spark.createDataFrame([(t,) for t in texts], "statement string"))
    return asked, resolve.resolve(asked, **catalog)


CASES = {
    "a://show :: season=1": ["s1"], "a://show :: season=1,episode=*": ["e11", "e12", "e13"], "a://show :: episode={3,1},season=*": ["e11", "e13", "e21", "e23"], "a://show :: season=2,episode=3..2": ["e23", "e22"],
    "a://show :: season=2..1,episode=..1": ["e21", "e11"], "a://show :: order=dvd,season=1,episode=1..": ["e8", "e7"], "a://show :: **": ["s0", "s1", "e11", "e12", "e13", "s2", "e21", "e22", "e23", "e24"], "a://show": ["show"], "a://show :: season=*": ["s0", "s1", "s2"],
}
FAULTS = {"a://show :: season=7": "Unresolved", "a://show :: season=1,episode=4": "Unresolved", "a://show :: part=1": "Invalid", "a://show :: order=*": "Invalid", "b://film :: **": "Unresolved", "a://gone": "Unresolved", "c://x :: part=1": "Invalid", "a://show :: season=1,episode=2..9": "Unresolved", "a://show :: order=vhs,season=1": "Unresolved"}


def test_selectors(spark, catalog):
    texts = {f"{x} <~> c://x": x for x in (*CASES, *FAULTS)}
    asked, (members, errors) = resolved(spark, catalog, *texts)
    from catenary.functions.claims import parse_statement

    ids = {parse_statement(t).claim_id(): x for t, x in texts.items()}
    found = {}
    for r in members.where("reference <> 'c://x'").orderBy("claim_id", "place").collect():
        found.setdefault(ids[r.claim_id], []).append(r.reference[4:])
    assert {k: v for k, v in found.items() if k in CASES} == CASES
    kinds = {ids[r.claim_id]: set() for r in errors.collect()}
    for r in errors.collect():
        kinds[ids[r.claim_id]].add(r.kind)
    assert set(kinds) == set(FAULTS) and all(FAULTS[k] in v for k, v in kinds.items())


def test_statements(spark, catalog):
    verdicts = {
        "a://show :: season=1,episode=1..3 <=> b://film :: part=1..3": "valid", "a://show :: season=1,episode=1..2 <=> b://film :: part=1..3": "Invalid", "a://show :: season=2,episode=1..2 @3 <~> b://film :: part=1..3 @2": "valid",
        "[a://show :: season=1,episode=1..2,a://show :: season=1] <~> b://film :: part={1,3} @2": "Invalid", "a://show :: season=2,episode={1,2} @3 <~> b://film :: part=1..3 @2": "valid", "a://show :: ** => c://x @4": "valid", "a://e11 => [c://x @2,a://e11]": "Invalid",
    }
    from catenary.functions.claims import parse_statement

    ids = {parse_statement(t).claim_id(): t for t in verdicts}
    asked = resolve.selections(spark.createDataFrame([(t,) for t in verdicts], "statement string"))
    out = resolve.compiled(asked, **catalog)
    got = {ids[r.claim_id]: r.verdict.split(":")[0] for r in out["verdicts"].collect()}
    assert got == verdicts
    edges = {}
    for r in out["edges"].collect():
        edges.setdefault(ids[r.claim_id], []).append((r.left[4:], r.left_start, r.left_end, r.right[4:], r.right_start, r.right_end))
    three = sorted(edges["a://show :: season=2,episode=1..2 @3 <~> b://film :: part=1..3 @2"])
    assert three == [("e21", "0/1", "2/3", "p1", "0/1", "1/1"), ("e21", "2/3", "1/1", "p2", "0/1", "1/2"), ("e22", "0/1", "1/3", "p2", "1/2", "1/1"), ("e22", "1/3", "1/1", "p3", "0/1", "1/1")]
    assert len(edges["a://show :: season=1,episode=1..3 <=> b://film :: part=1..3"]) == 3
    assert {ids[r.claim_id] for r in out["groups"].collect()} == {"a://show :: season=2,episode={1,2} @3 <~> b://film :: part=1..3 @2"}
    rest = {(ids[r.claim_id], r.side): r.n for r in out["tails"].groupBy("claim_id", "side").agg(F.sum(F.col("extent") - F.col("covered")).cast("int").alias("n")).collect()}
    assert rest == {("a://show :: ** => c://x @4", "left"): 6}
    few = resolve.compiled(asked, **catalog, captured=("a", "c"), most=5)["verdicts"]
    kinds = {ids[r.claim_id]: r.verdict.split(":")[0] for r in few.collect()}
    assert kinds["a://show :: ** => c://x @4"] == "LimitExceeded" and sum(v == "InvalidCapture" for v in kinds.values()) == 5


def test_coordinates_of_composites(spark, catalog):
    asked, (members, _) = resolved(spark, catalog, "[a://show :: **,[b://film :: part=2..1,c://x]] => c://x")
    whole, sides = resolve.expressions(asked, members)
    got = [r.coordinate for r in whole.where("side = 0").orderBy("ordinal").collect()]
    assert got[:3] == ["0/0", "0/1", "0/1/1"] and got[-3:] == ["1/@0", "1/@1", "1/@2"]
    assert {(r.side, r.members, r.ordered, r.dynamic) for r in sides.collect()} == {(0, 13, True, True), (1, 1, True, False)}
