"""Items that share most of their words are found like others, and notices that stand in many texts still are not."""

import random

import pytest

pytest.importorskip("ahocorasick")

from catenary.llm.leaks import leaked_items  # noqa: E402

WORDS = [a + b for a in ("am", "ba", "ce", "del", "em", "fli", "gro", "he") for b in ("ber", "sin", "dar", "ta", "nt", "ve", "ron", "tty")]
NOTICE = "this summary was written by a volunteer and may contain spoilers"


def test_near_copies_and_one_passage(spark):
    r = random.Random(8)
    text = lambda n: " ".join(r.choice(WORDS) for _ in range(n))
    copied, passage = text(30).split(), text(24)
    items = [(1, " ".join(copied)), (2, " ".join([*copied[:15], "otherwise", *copied[16:]])), (3, f"{passage} {text(20)}"), (4, f"{passage} {text(20)}"), *((10 + i, f"{text(40)} {NOTICE}") for i in range(4))]
    docs = [(1, f"{text(40)} {items[0][1]} {text(40)}"), (2, f"{text(40)} {passage} {text(40)}"), *((100 + i, f"{text(60)} {NOTICE} {text(9)}") for i in range(20)), *((200 + i, f"{text(9)} {items[0][1]}") for i in range(4))]
    truth = {(d, i) for d in (1, 200, 201, 202, 203) for i in (1, 2)} | {(2, 3), (2, 4)}
    df, asked = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    for block in (10**7, 300):
        assert {(x.doc_id, x.item_id) for x in leaked_items(df, asked, item_block=block).collect()} == truth
