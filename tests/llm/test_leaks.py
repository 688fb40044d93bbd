"""Leaked items: planted passages are found with their places, quotations and stock phrases are not."""

import random

import pytest

pytest.importorskip("ahocorasick")

from catenary.llm.leaks import Items, aligned, leaked_items, words_of  # noqa: E402

WORDS = "amber basin cedar delta ember flint grove heron ivory jetty knoll lotus maple north ochre pearl quartz river slate thorn umber vale willow yarrow zephyr".split()
STOCK = "this summary was written by a volunteer and may contain spoilers"


def text(r, n):
    return " ".join(r.choice(WORDS) + str(r.randint(0, 99)) if r.random() < 0.3 else r.choice(WORDS) for _ in range(n))


def test_planted(spark):
    r = random.Random(6)
    items = [(i, text(r, 40) + ". " + STOCK + ".") for i in range(12)] + [(90, None), (91, ""), (92, "？！"), (93, "東京の古い図書館で失われた地図を探す若い司書の物語が静かに始まる")]
    docs = [(i, text(r, 60) + " " + STOCK) for i in range(40)] + [(100, None), (101, ""), (102, "   ")]
    truth = set()
    for i in range(12):
        words = items[i][1].split()
        part = words[: 22 + i]
        if i % 3 == 0:
            part.insert(9, "<b>inserted words here</b>")
        if i % 3 == 1:
            part[5] = part[5][::-1]
        docs.append((200 + i, text(r, 30) + " " + (" ".join(part).upper() if i % 2 else "\r\n".join(part)) + " " + text(r, 30)))
        truth.add((200 + i, i))
        docs.append((300 + i, text(r, 30) + " " + " ".join(words[3:10]) + " " + text(r, 30)))  # a short quotation
    docs.append((400, "前書き。" + items[15][1][4:30] + "。後書き"))
    docs.append((200, docs[-2][1]))
    truth.add((400, 93))
    df = spark.createDataFrame([(d, t, 0) for d, t in docs], "doc_id bigint, text string, item_id int")
    asked = spark.createDataFrame([(i, t) for i, t in items], "item_id bigint, text string")
    for block in (10**7, 500):
        found = leaked_items(df, asked, item_block=block).collect()
        assert {(r.doc_id, r.item_id) for r in found} == truth
    place = {r.doc_id: (r.start, r.end) for r in found}
    assert dict(docs)[400][slice(*place[400])] == items[15][1][4:30]
    assert leaked_items(df.limit(0), asked).count() == 0 and leaked_items(df, asked.limit(0)).count() == 0


def test_every_run_is_met():
    """The automaton against looking for each run in each text."""
    r = random.Random(9)
    items = Items([(i, text(r, 20)) for i in range(5)])
    for _ in range(30):
        words = words_of(" ".join(items.words[r.randint(0, 4)][r.randint(0, 9) :]) + " " + text(r, 15))[0]
        found = {(i, at, k) for i, hits in items.hits(words).items() for at, k, _ in hits}
        assert found == {(i, at, k) for i, own in items.words.items() for k in range(len(own) - 3) for at in range(len(words) - 3) if own[k : k + 4] == words[at : at + 4]}


def test_alignment_counts_what_stands_in_order():
    item = text(random.Random(1), 30).split()
    assert aligned(item, item, 3)[0] == sum(map(len, item))
    assert aligned(item, item[:10] + ["x"] * 5 + item[12:], 3)[3] == [*range(10), *range(12, 30)]
    assert aligned(item, item[15:] + ["y"] * 90 + item[:15], 3)[0] < 0.7 * sum(map(len, item))


def test_dense_passage_beside_a_thin_one(spark):
    """Half an item stands in one piece; further on the item's words stand scattered."""
    r = random.Random(12)
    item = [f"{w}{i}" for i, w in enumerate(text(r, 40).split())]
    thin = " ".join(" ".join(item[k : k + 3]) + " " + text(r, 22) for k in range(0, 39, 3))
    df = spark.createDataFrame([(1, text(r, 20) + " " + " ".join(item[:20]) + " " + text(r, 20) + " " + thin), (2, thin)], "doc_id bigint, text string")
    found = leaked_items(df, spark.createDataFrame([(7, " ".join(item))], "item_id bigint, text string")).collect()
    assert [(x.doc_id, x.item_id) for x in found] == [(1, 7)]


def test_altered_words_and_long_markup(spark):
    """A word altered in every sixth, and a tag of any length within the passage."""
    r = random.Random(13)
    item = [f"{w}{i}" for i, w in enumerate(text(r, 42).split())]
    part = ["changed" if i % 6 == 5 else w for i, w in enumerate(item[:24])]
    tag = '<a href="https://example.org/' + "x" * 300 + '" title="one two three four five six">'
    docs = [(1, " ".join(part)), (2, " ".join(item[:12]) + f" {tag} " + " ".join(item[12:20])), (3, " ".join(item[:5]) + " " + text(r, 30))]
    found = leaked_items(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame([(7, " ".join(item))], "item_id bigint, text string")).collect()
    assert sorted(x.doc_id for x in found) == [1, 2]


def test_places_in_the_original():
    odd = "Ein Straßen-\n bahn &amp; <b>café</b> ﬁn が ½"
    words, spans = words_of(odd)
    assert words[:4] == ["ein", "strassenbahn", "cafe", "fin"] and len(words) == len(spans)
    assert [odd[a:b] for a, b in spans[2:5]] == ["café", "ﬁn", "が"] and odd[slice(*spans[1])] == "Straßen-\n bahn"
