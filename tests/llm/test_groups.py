"""Groups of linked units against union-find."""

import random

import pytest

from catenary.llm.groups import linked_groups


def brute(pairs):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for pair in pairs:
        units = [x for x in (None if u is None else u.strip().lower() for u in pair) if x]
        for u in units:
            find(u)
        if len(units) == 2:
            a, b = map(find, units)
            root[max(a, b)] = min(a, b)
    return sorted((u, find(u)) for u in root)


def pairs_of(r):
    chain = [(f"c{i}", f"C{i + 1} ") for i in range(60)]
    star = [("hub", f"s{i}") for i in range(80)]
    loose = [(f"x{r.randint(0, 90)}", f"x{r.randint(0, 90)}") for _ in range(60)]
    odd = [(None, "only"), ("self", "self"), (None, None), ("", "\t"), ("é日本", None)]
    out = chain + star + loose + odd + chain[:5] + [(b, a) for a, b in star[:9]]
    r.shuffle(out)
    return out


@pytest.mark.parametrize("hot_rows", [10**6, 40])
def test_against_union_find(spark, hot_rows):
    pairs = pairs_of(random.Random(3))
    df = spark.createDataFrame([(a, b, 1, "x") for a, b in pairs], "left_unit string, right_unit string, v int, unit string")
    assert sorted(map(tuple, linked_groups(df, hot_rows=hot_rows).collect())) == brute(pairs)


def test_nothing_and_only_loops(spark):
    df = spark.createDataFrame([("a", "A"), ("b", None)], "left_unit string, right_unit string")
    assert sorted(map(tuple, linked_groups(df).collect())) == [("a", "a"), ("b", "b")]
    assert linked_groups(df.limit(0)).count() == 0
