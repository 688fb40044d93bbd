"""Nested records against a plain walk of the decoded JSON."""

import json
import random

import pyarrow as pa

from catenary.operators.nested import BARE, explode_objects, index_block, nested_objects


def walked(value, at="", around="", name=None, listed=False):
    if isinstance(value, dict):
        if not listed and name in BARE:
            at, listed = at + "/0", True
        if listed:
            own = value.get("id")
            yield around, at, "" if own is None else own if isinstance(own, str) else json.dumps(own, separators=(",", ":"), ensure_ascii=False)
            around = at
        for k, v in value.items():
            yield from walked(v, f"{at}/{k.replace('~', '~0').replace('/', '~1')}", around, k)
    elif isinstance(value, list):
        for i, v in enumerate(value):
            yield from walked(v, f"{at}/{i}", around, None, True)


def compact(own):
    """A container's text without its spaces."""
    try:
        return json.dumps(json.loads(own), separators=(",", ":"), ensure_ascii=False) if own[:1] in "[{" and own else own
    except ValueError:
        return own


def brute(text):
    try:
        value = json.loads(text or "")
        while isinstance(value, str):
            value = json.loads(value)
    except ValueError:
        return []
    return sorted(walked(value))


def indexed(texts):
    found = index_block(pa.array(texts, pa.string())).to_pydict()
    out = [[] for _ in texts]
    for r, *x in zip(found["row"], found["parent_pointer"], found["pointer"], found["native_id"]):
        out[r].append((*x[:2], compact(x[2])))
    return [sorted(x) for x in out]


FIXED = [
    "", "  ", None, "{", "}", "[]", "5", "null", '"x"', '"\\"x\\""', "{} {}", '{"a":[}]', '{"a":"[{"}', '{"a":[{"id":"x\\"y\\\\","k/~z":[{"id":1.5},null,{"id":null},[{"id":true}]]}]}',
    '[{"id":1},{"titles":{"id":"\\u00e9"}}]', '{"seasons":{"results":{"id":{"a":[1]}}}}', '{"a\\"b":[{"x":{"y":[{}]}}]}', '"{\\"seasons\\":[{\\"id\\":3}]}"', '{"a":[{"\\u0069d":7}]}', '{"a":[{"id":" é "}]}',
]


def made(r, depth=0):
    kind = r.random()
    if depth > 4 or kind < 0.3:
        return r.choice([None, True, 3, -1.5, "", 'q"\\', "[{,:}]", "日本", "a/b~c"])
    if kind < 0.65:
        return {r.choice(["id", "seasons", "groups", "x", "a/b", "t~", 'q"', "titles"]): made(r, depth + 1) for _ in range(r.randint(0, 4))}
    return [made(r, depth + 1) for _ in range(r.randint(0, 4))]


def test_fixed_and_random_texts():
    r = random.Random(5)
    texts = FIXED + [json.dumps(made(r), separators=r.choice([(",", ":"), (", ", ": ")]), indent=r.choice([None, 1]), ensure_ascii=r.random() < 0.5) for _ in range(1500)]
    texts += [json.dumps(t) for t in texts[-50:]]
    assert indexed(texts) == [brute(t) for t in texts]


def test_very_long_and_repeated():
    text = json.dumps({"episodes": [{"id": i, "crew": [{"id": "c"}]} for i in range(20000)]})
    assert indexed([text, text]) == [brute(text)] * 2


def test_repeated_names_count_last():
    assert indexed(['{"a":[{"id":1,"b":[{}]},{}],"a":[{"id":2}],"id":1}']) == [[("", "/a/0", "2")]]


def test_versions(spark):
    rows = [("s", " Tv:1", 1, '{"seasons":[{"id":1}]}', 1), ("s", "tv:1 ", 1, '{"seasons": [{"id": 1}]}', 2), ("s", "tv:1", 2, None, 3), ("s", "tv:1", 3, "{", 4), (None, None, None, None, 5)]
    df = spark.createDataFrame(rows, "source string, key string, revision bigint, payload string, pointer int")
    assert [tuple(r) for r in nested_objects(df).collect()] == [("s", "tv:1", 1, "", "/seasons/0", "1")]
    assert nested_objects(df.limit(0)).count() == 0
    full = explode_objects(df, "payload", ("source", "key"), body=True).where("key = 'tv:1 '").collect()
    assert [(r.field, r.body) for r in full] == [("seasons", '{"id": 1}')]
