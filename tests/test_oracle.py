"""Every registered query against its DuckDB oracle SQL (sf0.001; the
driver repeats this at sf0.01)."""

import pytest

import __spark_entry__ as entry
from tessera.plans import catalogue
from tests.conftest import SF_MID, SF_SMALL
from tests.oracle import compare, duck

QUERIES, SQL = catalogue.QUERIES, catalogue.ORACLE_SQL


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_the_entry_module_lists_the_catalogue():
    assert QUERIES.items() <= entry.queries().items() and SQL.items() <= entry.oracle_sql().items()


def test_every_query_but_als_has_an_oracle():
    assert set(SQL) == set(QUERIES) - {"als_recommend"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, QUERIES[name], SQL[name], SF_SMALL, con)
    assert r["status"] == "ok", r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["other", "score", "n", "s_name"]
    assert len(rows) >= 0


def test_als_recommend_rows(spark):
    df = QUERIES["als_recommend"](spark, SF_SMALL)
    rows = df.collect()
    assert 0 < len(rows) <= 15
    assert [r["rank"] for r in rows] == sorted(r["rank"] for r in rows)
    ratings = [r["rating"] for r in sorted(rows, key=lambda r: r["rank"])]
    assert ratings == sorted(ratings, reverse=True)
    assert len({r["item"] for r in rows}) == len(rows)


def test_names_of_all_suppliers_are_read(spark, con):
    n = con.execute(f"SELECT count(*) FROM read_parquet('{SF_MID}/supplier.parquet')").fetchone()[0]
    assert n > 80
    assert QUERIES["parse_names_all"](spark, SF_MID).count() == n
    assert QUERIES["parse_names_uncut"](spark, SF_MID).where("name LIKE '%/ALIAS'").count() == min(n, 6487)
