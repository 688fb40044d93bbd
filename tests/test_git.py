"""Publications as commits: the same one twice, a lost race, deltas in batches."""

import shutil

import pytest

from catenary.operators import review
from catenary.sources.git import History, batched

pytestmark = pytest.mark.skipif(not shutil.which("git"), reason="git is not here")


def path(n):
    digits = f"{n:064x}"
    return f"claims/{digits[:2]}/{digits}.trk"


def test_publications(spark, tmp_path):
    h = History(str(tmp_path / "claims.git"))
    files = lambda *rows: spark.createDataFrame([(path(n), c) for n, c in rows], "path string, content string")
    one = h.prepare(files((1, "a\n"), (2, "é\n")), "first", 1000)
    assert h.head() is None and h.prepare(files((2, "é\n"), (1, "a\n")), "first", 1000) == one
    h.apply(one, None)
    h.apply(one, None)  # again, after a crash
    two = h.prepare(files((1, "b\n"), (2, None), (3, "c\n")), "second", 2000)
    other = h.prepare(files((4, "d\n"),), "third", 3000)
    h.apply(two, one)
    with pytest.raises(RuntimeError):
        h.apply(other, one)  # another came first
    assert h.head() == two
    assert sorted(h.changes(one, two)) == [(path(1), "changed", "b\n"), (path(2), "deleted", None), (path(3), "added", "c\n")]
    before, after = (spark.createDataFrame([(p, c) for p, _, c in h.changes(None, x)], "path string, content string") for x in (one, two))
    assert sorted(map(tuple, review.delta(before, after).collect())) == sorted(h.changes(one, two))
    assert [d.count() for d in h.delta(spark, one, two, files=2)] == [2, 1]
    for bad in ("../x", "claims/zz/1.trk"):
        with pytest.raises(ValueError):
            h.prepare(spark.createDataFrame([(bad, "x")], "path string, content string"), "m", 1)
    with pytest.raises(ValueError):
        History(str(tmp_path / "x.git"), "a..b")


def test_batches_by_bytes():
    rows = [(str(i), "added", "x" * n) for i, n in enumerate((4, 4, 20, 1, 1))]
    assert [[r[0] for r in b] for b in batched(rows, 2, 8)] == [["0", "1"], ["2"], ["3", "4"]]
