"""Episodes whose titles are common are told by dates and numbers, however many shows have the titles."""

from catenary.llm.episodes import match_episodes

COLUMNS = "episode_id bigint, source string, order_ref string, reference string, season bigint, episode bigint, title string, air_date string, linked_reference string"
COMMON = ("Pilot", "Homecoming", "Finale")


def test_common_titles_on_equal_dates(spark):
    rows, truth = [], set()

    def add(source, show, episode, title, date):
        rows.append((len(rows), source, show, f"x://{len(rows)}", 1, episode, title, date, None))
        return len(rows) - 1

    for k in range(40):  # shows of one catalog only
        for e, title in enumerate(COMMON):
            add("org.themoviedb" if k % 2 else "com.thetvdb", f"o{k}", e + 1, title, f"{1980 + k // 2}-{1 + 4 * e + k % 2 * 2:02d}-0{1 + k % 7}")
    for n in (1, 3):  # shows of both, that share one and three common titles and an episode without a title
        for e, title in enumerate((*COMMON[:n], None)):
            date = f"{2004 + n}-0{1 + e}-15"
            truth.add((add("org.themoviedb", f"l{n}", e + 1, title, date), add("com.thetvdb", f"r{n}", e + 1, title, date)))
    assert {(r.a, r.b) for r in match_episodes(spark.createDataFrame(rows, COLUMNS)).collect()} == truth
