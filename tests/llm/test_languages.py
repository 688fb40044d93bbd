"""Languages: held-out accuracy of sentences, stretches of mixed texts, labels."""

import random

from pyspark.sql import functions as F

from catenary.llm.languages import Model, fit, label_code, language_segments, sentences

PARTS = {
    "en": ("The old captain {} repairs the broken lamp.", "Nobody knows where the {} was hidden.", "We walk slowly towards the river with {}.", "This is the best story of {} so far."),
    "de": ("Der alte Kapitän {} repariert die kaputte Lampe.", "Niemand weiß, wo die {} versteckt wurde.", "Wir gehen langsam zum Fluss mit {}.", "Das ist die beste Geschichte von {} bisher."),
    "ru": ("Старый капитан {} чинит сломанную лампу.", "Никто не знает, где спрятана {}.", "Мы медленно идём к реке с {}.", "Это лучшая история о {} до сих пор."),
    "ja": ("古い船長の{}は壊れたランプを直す。", "{}がどこに隠されたのか誰も知らない。", "私たちは{}とゆっくり川へ歩く。", "これは今までで最高の{}の物語です。"),
}


def made(spark, r):
    name = lambda: "".join(r.choice(["mo", "ka", "ri", "zu"]) for _ in range(3)).title()
    say = lambda lang, n: ("" if lang == "ja" else " ").join(r.choice(PARTS[lang]).format(name()) for _ in range(n))
    items = [(lang, say(lang, 4)) for lang in PARTS for _ in range(6)]
    docs, truth = [], {}
    for i in range(120):
        langs = r.sample(sorted(PARTS), r.choice([1, 1, 1, 2, 3]))
        docs.append((i, "The Golden Heading\n\n" * (i % 7 == 0) + r.choice(["\n\n", " ", " / "]).join(say(x, 2) for x in langs), langs[0] if r.random() < 0.8 else r.choice([None, "xx", "de"])))
        truth[i] = langs
    return docs, truth, spark.createDataFrame(items, "lang string, text string"), spark.createDataFrame([("en", "English"), ("de", "German"), ("ru", "Russian"), ("ja", "Japanese")], "lang string, lang_name string")


def test_stretches(spark):
    docs, truth, items, languages = made(spark, random.Random(4))
    extra = [(500, None, "en"), (501, "", "en"), (502, " \n\t", None), (503, "a.b://c/1 <=> d://e/2\nx://y ~> z://q", None), (504, "No Full Stop Here", "en"), (505, docs[0][1] * 300, docs[0][2])]
    df = spark.createDataFrame([(*d, "x") for d in docs + extra], "doc_id bigint, text string, lang string, segment_no string")
    found = {}
    for r in language_segments(df, items, languages).orderBy("doc_id", "segment_no").collect():
        assert 0 < r.confidence <= 1
        found.setdefault(r.doc_id, []).append(r.lang)
    assert {k: found[k] for k in truth} == truth and not {500, 501, 502, 503, 504} & set(found)
    cases = {r.doc_id for r in language_segments(df.where("doc_id < 500"), items, languages, only_cases=True).collect()}
    assert cases == {i for i, _, label in docs if len(truth[i]) > 1 or label != truth[i][0]}
    assert language_segments(df.limit(0), items, languages).count() == 0


def test_held_out(spark):
    docs, truth, items, languages = made(spark, random.Random(5))
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string")
    model = fit(df.where("doc_id % 2 = 0"), items, languages)
    wrong = [i for i, t, _ in docs if i % 2 and [s[0] for s in model.segments(t)] != truth[i]]
    assert len(wrong) <= 1


def test_labels(spark):
    languages = spark.createDataFrame([("en", "English"), ("pt", "Portuguese"), ("de", "German")], "lang string, lang_name string")
    given = {"en": "en", " EN ": "en", "en-US": "en", "en_GB": "en", "eng": "en", "English": "en", "pt-BR": "pt", "português": "pt", "ger": "de", "Deutsch": "de", "und": None, "": None, "xx": None, "engine": None, None: None, "zh": None}
    df = spark.createDataFrame([(k,) for k in given], "lang string")
    assert {r.lang: r.code for r in df.select("lang", label_code(F.col("lang"), languages).alias("code")).collect()} == given


def test_unknown_words_fall_back():
    m = Model(("a", "b"), [("a", ["straße weiß"] * 3), ("b", ["ciudad niño"] * 3)], known_in=1)
    assert m.score("weiße")[0] > m.score("weiße")[1] and m.score("niños")[1] > m.score("niños")[0]
    assert m.score("ж") == (0.0, 0.0)
    assert [x.strip() for x in sentences("A title\n\nOne. Two!  <p>Three…</p>\r\nx://y <=> z://q\r\n")] == ["One.", "Two!", "Three…"]
