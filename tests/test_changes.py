"""Feeds and snapshots against replays in plain Python."""

import random

from catenary.operators.changes import apply_changes, live_records, live_revisions
from catenary.operators.snapshots import snapshot_changes

FEED = "source string, key string, revision bigint, payload string, hash string, deleted boolean, metadata string, recorded_at timestamp"


def replayed(rows):
    state = {}
    best = {}
    for s, k, r, p, h, d, m, _ in rows:
        if k is None or r is None:
            continue
        key = (s, k.strip().lower())
        old = best.get((*key, r))
        best[(*key, r)] = (p, d) if old is None else (old[0] or p, d if old[1] is None else old[1] or bool(d))
    for s, k, r in sorted(best, key=lambda x: x[2]):
        p, d = best[s, k, r]
        revision, carrier, live = state.get((s, k), (None, None, False))
        if d is not None:
            carrier, live = r, not d
        state[s, k] = (r, carrier, live)
    return sorted((s, k, r, c) for (s, k), (r, c, live) in state.items() if live)


def test_live_revisions(spark):
    r = random.Random(2)
    rows = [("s", None, 1, "{}", "h", False, "{}", None), ("s", "k:1", None, "{}", "h", False, "{}", None)]
    for _ in range(600):
        kind = r.random()
        p, h, d = (None, None, None) if kind < 0.3 else ('{"reason":1}', "x", True) if kind < 0.5 else ("{}", "y", False)
        rows.append((r.choice("ab"), r.choice([" K:{}", "k:{}\t", "k:{}"]).format(r.randint(0, 25)), r.randint(1, 60), p, h, d, r.choice([None, "{}"]), None))
    rows += rows[:100]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, FEED)
    assert sorted(map(tuple, live_revisions(df).collect())) == replayed(rows)
    assert live_revisions(df.limit(0)).count() == 0


def test_fields_end_with_a_delete(spark):
    df = spark.createDataFrame([("s", "k:1", 1, "p1", "h1", False, "m1", None), ("s", "k:1", 2, "gone", "h", True, None, None), ("s", "k:1", 3, "p3", "h3", False, None, None), ("s", "k:1", 4, None, None, None, "m4", None)], FEED)
    row = live_records(df).collect()[0]
    assert (row.revision, row.payload, row.payload_at, row.metadata, row.metadata_at) == (4, "p3", 3, "m4", 4)
    assert live_records(df.where("revision < 4")).collect()[0].metadata is None  # m1 lies before the delete


def test_clashing_columns_and_replacement(spark):
    df = spark.createDataFrame([(1, 1, "a", "x", False, False), (1, 2, None, "y", False, True), (1, 3, "c", None, None, None)], "id int, seq bigint, a string, `b_at` string, del boolean, whole boolean")
    row = apply_changes(df, ("id",), "seq", ("a", "b_at"), "del", "whole").collect()[0]
    assert (row.a, row.b_at) == ("c", "y")
    row = apply_changes(df.where("seq < 3"), ("id",), "seq", ("a", "b_at"), "del", "whole").collect()[0]
    assert (row.a, row.b_at) == (None, "y")  # the replacement did not set a


RECORDS = "source string, key string, domain string, revision bigint, hash string, deleted boolean, metadata string, seen_run string"
RUNS = "run_id string, source string, mode string, status string, started_at int, finished_at int"


def compared(rows, runs):
    out = set()
    for source in {r[1] for r in runs}:
        full = [r[0] for r in sorted(runs, key=lambda r: r[4]) if r[1] == source and r[2] == "full" and r[3] == "complete"]
        snaps = []
        for run in full:
            best = {}
            for s, k, _, rev, h, d, _, seen in rows:
                if s == source and seen == run and k is not None:
                    key = k.strip().lower()
                    cand = (-1 if rev is None else rev, bool(d), "" if h is None else h.strip().lower()[-64:])
                    best[key] = max(best.get(key, cand), cand)
            snaps.append({k: v[2] for k, v in best.items() if not v[1]})
        for i in range(1, len(full)):
            a, b = snaps[i - 1], snaps[i]
            out |= {(source, full[i], k, "added") for k in b.keys() - a.keys()} | {(source, full[i], k, "removed") for k in a.keys() - b.keys()} | {(source, full[i], k, "changed") for k in a.keys() & b.keys() if a[k] != b[k]}
    return out


def test_snapshots(spark):
    r = random.Random(4)
    runs = [(f"{s}{i}", s, r.choice(["full", "full", "incremental"]), r.choice(["complete", "complete", "failed"]), i, None) for s in "abc" for i in range(7)]
    rows = [("a", None, None, 1, "h", False, "{}", "a0"), ("a", "k", None, 1, "h", False, "{}", None)]
    for run in runs:
        for k in range(150):
            if r.random() < 0.85:
                h = f"{k % 7 if r.random() < 0.97 else 9}" * 64
                rows.append((run[1], f"k:{k}" if r.random() < 0.9 else f" K:{k} ", None, r.choice([None, 1, 2]), h if r.random() < 0.9 else r.choice([None, "sha256:" + h, h + " "]), r.random() < 0.05, "{}", run[0]))
                if r.random() < 0.2:
                    rows.append(rows[-1])
    records, table = spark.createDataFrame(rows, RECORDS), spark.createDataFrame(runs, RUNS)
    for bits in (0, 2, 6):
        found = [tuple(x) for x in snapshot_changes(records, table, bits).collect()]
        assert len(found) == len(set(found)) and set(found) == compared(rows, runs)
    assert snapshot_changes(records.limit(0), table).count() == 0 and snapshot_changes(records, table.limit(0)).count() == 0
