"""Joined pieces against encoding whole texts."""

import random

import pytest

pytest.importorskip("public_tokenizers")

from catenary.llm.tokens import Tree, default_vocabulary, encode_corpus, encoding  # noqa: E402


def test_any_cut_gives_the_same():
    r = random.Random(8)
    e = encoding(default_vocabulary())
    for _ in range(6000):
        text = "".join(r.choice(r.choice(["ab", "the ", "aA0 \n", "　あ漢é ", "'s't x  ", "-=_.", "\x1c= \x85a", "🎬\r\n", "12345", "  \t\n"])) for _ in range(r.randint(1, 120)))
        assert Tree(default_vocabulary(), r.choice([1, 3, 8, 21])).encode(text) == e.encode_ordinary(text)


def test_long_runs_and_counts():
    e = encoding(default_vocabulary())
    r = random.Random(2)
    for run in ("a", "ab", " ", "\n", "7", "12", "=", "漢", "'s", "\n  ", " a"):
        text = (run * 700)[: r.randint(300, 700)] + r.choice(["", " end", "\nend", "  x"])
        tree = Tree(default_vocabulary(), 37)
        assert tree.encode(text) == e.encode_ordinary(text)
        assert tree.counts["joins"] >= 7


def test_corpus(spark):
    e = encoding(default_vocabulary())
    texts = [None, "", "  \n", "plain text", "<|endoftext|>", "a" * 9000, "漢" * 3000, ("word " * 2000) + "x" * 5000 + " end", "plain text", "=" * 4097]
    df = spark.createDataFrame([(i if i != 8 else 3, t, [i]) for i, t in enumerate(texts)], "doc_id bigint, text string, ids array<int>")
    found = sorted((r.doc_id, list(r.ids)) for r in encode_corpus(df).collect())
    assert found == sorted((i if i != 8 else 3, e.encode_ordinary(t) if t else []) for i, t in enumerate(texts))
    assert encode_corpus(df.limit(0)).count() == 0
    joins = {r.doc_id: r.joins for r in encode_corpus(df, counts=True).collect()}
    assert joins[3] == 0 and joins[5] == 7 and joins[6] == 1
