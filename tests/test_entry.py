"""The contract with the driver: every query has a result with the columns of its SQL."""

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
QUICK = ("p1_found", "p4_found", "p5_found", "rec_latest", "rec_in_force", "rec_retention", "link_candidates", "sem_align_extent", "aln_spans", "pol_conflicts", "pub_delta", "stream_windows", "stream_sessions", "prj_units", "prj_domain", "prj_orders", "cor_verdicts", "pip_project", "rec_observed_changes", "rec_committed", "src_show_members", "aln_statements", "dsl_documents")


@pytest.fixture(scope="module")
def duck():
    from pathlib import Path

    if not Path(SF).exists():
        pytest.skip("no test data here")
    c = duckdb.connect()
    for p in Path(SF).iterdir():
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


def same(x):
    return "NULL" if x is None else str(x)


@pytest.mark.parametrize("name", QUICK)
def test_against_sql(spark, duck, name):
    found = entry.queries()[name](spark, SF)
    columns = sorted(found.columns)
    result = duck.execute(entry.oracle_sql()[name])
    places = {d[0]: i for i, d in enumerate(result.description)}
    assert sorted(places) == columns
    assert sorted([same(r[c]) for c in columns] for r in found.collect()) == sorted([same(r[places[c]]) for c in columns] for r in result.fetchall())


def test_sql_names_are_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    from pathlib import Path

    if not Path(SF).exists():
        pytest.skip("no test data here")
    assert entry.entry(spark).columns
