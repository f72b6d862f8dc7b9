"""Driver contract and the DuckDB oracle on the smallest tables."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import __spark_entry__ as entry  # noqa: E402
from oracle_check import _close, _rows  # noqa: E402
from ampere.sources.fixtures import TABLES  # noqa: E402

from conftest import SF_SMOKE  # noqa: E402

ORACLE = entry.oracle_sql()


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "avg_load_mw" in df.columns and "iso_code" in df.columns


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(entry.queries())
    assert len(entry.queries()) >= 90


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMOKE}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    sdf = entry.queries()[name](spark, SF_SMOKE).toPandas()
    ddf = duck.execute(ORACLE[name]).df()
    sc, sr = _rows(sdf)
    dc, dr = _rows(ddf)
    assert sc == dc
    assert len(sr) == len(dr)
    assert all(_close(a, b) for a, b in zip(sr, dr))
