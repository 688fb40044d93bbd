"""Episodes: the assignment against brute force, the windows against all pairs, and invented shows."""

import random
from itertools import combinations

from pyspark.sql import functions as F

from catenary.llm.episodes import best_assignment, day_of, match_episodes, neighbours, title_names

COLUMNS = "episode_id bigint, source string, order_ref string, reference string, season bigint, episode bigint, title string, air_date string, linked_reference string"


def test_assignment_is_the_best():
    r = random.Random(3)
    for _ in range(400):
        pairs = [(a, 10 + b, r.choice([0.5, 0.55, 0.6, 0.7, 0.9])) for a in range(r.randint(1, 4)) for b in range(r.randint(1, 4)) if r.random() < 0.6]
        best = max((sum(w for _, _, w in c) for n in range(5) for c in combinations(pairs, n) if len({a for a, _, _ in c}) == n == len({b for _, b, _ in c})), default=0)
        assert abs(sum(w for _, _, w in best_assignment(pairs)) - best) < 1e-9


def test_windows_cross_range_borders(spark):
    r = random.Random(5)
    entries = [(f"{r.randint(0, 40):03d}", "", "", i, r.randint(0, 1), r.choice([None, 3, 4, 90])) for i in range(300)]
    df = spark.createDataFrame(entries, "k1 string, k2 string, k3 string, id bigint, side int, day int").repartition(7)
    order = sorted(entries, key=lambda e: (e[:3], e[3]))
    expected = set()
    for i, x in enumerate(order):
        for y in order[i + 1 : i + 6]:
            if x[4] != y[4] and (x[5] is None or y[5] is None or abs(x[5] - y[5]) <= 8 or x[0] == y[0]):
                expected.add((x[3], y[3]) if x[4] == 0 else (y[3], x[3]))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert {tuple(p) for p in neighbours(df, 5).collect()} == expected
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_titles_and_dates():
    assert title_names("# 3: The Lost & Found (2) / Élan")[0] == ["lost and found", "elan"] and title_names("Ep 7") == ([], None, False)
    assert title_names("The Lost…") == (["lost"], None, True) and title_names(None) == ([], None, False) and title_names("X, Part 2")[1] == 2
    assert day_of("1970-1-2") == day_of("1970/01/02") == day_of("1970-01-02T00:00:00Z") == 1 and day_of("0000-00-00") is day_of("1970-02-30") is day_of("1970") is None


def shows(r):
    words = [a + b for a in ("sil", "gol", "mid", "cro", "win", "lan", "har", "bri") for b in ("ver", "den", "night", "oked", "ter", "tern", "bor", "dge")]
    rows, truth, n = [], set(), 0
    for show in range(6):
        shift, offset = r.choice([0, 0, 1, 7]), r.choice([0, 0, 1])
        for e in range(1, 21):
            name = " ".join(r.sample(words, 3)).title()
            day = f"20{10 + show:02d}-{1 + e // 4:02d}-{1 + (e * 7) % 27:02d}"
            a, b = n, n + 1
            n += 2
            other = name if r.random() < 0.6 else r.choice([name.upper(), f"Episode {e + offset}: {name}", name[:-1], name + " / Something Else", "" if shift == 0 else name])
            later = str((__import__("datetime").date.fromisoformat(day) + __import__("datetime").timedelta(days=shift)))
            rows.append((a, "org.themoviedb", f"l{show}", f"x://{a}", 1, e, name, day, None))
            if r.random() < 0.85:
                rows.append((b, "com.thetvdb", f"r{show}", f"y://{b}", 1, e + offset, other, later, None))
                truth.add((a, b))
    return rows, truth


def test_invented_shows(spark):
    rows, truth = shows(random.Random(2))
    odd = [(9001, "org.themoviedb", None, None, None, None, None, None, None), (9002, "com.thetvdb", "q", None, None, None, None, "never", None), (9003, "co.anilist", "q", "z", 1, 1, rows[0][6], rows[0][7], None)]
    df = spark.createDataFrame(rows + odd + rows[:7], COLUMNS).withColumn("side", F.lit("x")).withColumn("name", F.lit(1))
    found = {(r.a, r.b) for r in match_episodes(df).collect()}
    assert len({a for a, _ in found}) == len(found) == len({b for _, b in found})
    assert len(found & truth) >= 0.95 * len(truth) and len(found - truth) <= 0.03 * len(truth)
    assert match_episodes(df.limit(0)).count() == 0


def test_confidence_grows_with_evidence(spark):
    """More agreement never lowers a pair's confidence, and values are shares."""
    from catenary.llm.episodes import confidence

    schema = "link bigint, title double, shift bigint, show_move bigint, date_share double, step bigint, number_share double, a_season bigint, b_season bigint, a_year int, b_year int, a_part int, b_part int, rivals double"
    made = [(1, t, s, 0, 1.0 if s == 0 else None, 0, n, 1, 1, None, None, None, None, 0.0) for t in (0.3, 0.5, 0.8, 1.0) for s in (40, 5, 1, 0) for n in (None, 1.0)]
    found = {(r.title, r["shift"], r.number_share or 0): r.c for r in spark.createDataFrame(made, schema).withColumn("c", confidence()).collect()}
    for (t, s, n), c in found.items():
        assert 0 <= c <= 1
        assert all(c <= found[x] + 1e-9 for x in found if x[0] >= t and x[1] <= s and x[2] >= n)
    odd = [(1, 1.0, 0, 0, 1.0, 0, 1.0, 1, 1, None, None, 1, 2, 0.0), (None, 1.0, 0, None, None, 0, None, 1, 1, None, None, None, None, 3.0), (None, None, None, None, None, None, None, None, None, None, None, None, None, None)]
    assert [r.c for r in spark.createDataFrame(odd, schema).withColumn("c", confidence()).collect()] == [0.0, 0.0, 0.0]
