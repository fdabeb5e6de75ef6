"""Every registered query against its DuckDB equivalent on the smallest tables."""

import pytest

import __spark_entry__ as entry

from .compare import differences, duck

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_duckdb(spark, con, name):
    assert differences(spark, con, FOLDER, QUERIES[name], ORACLE[name]) == []


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["source_bank", "moved_in", "stayed", "left_us", "retention_rate"]
    assert df.count() == 9


def test_manifest_lists_all_sources(spark):
    rows = QUERIES["landing_manifest"](spark, FOLDER).collect()
    assert len(rows) == 5 and all(r.landed and r.files >= 1 and r.bytes > 0 for r in rows)
