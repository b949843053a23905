"""Every registered query against its DuckDB oracle on the smallest tables."""

import importlib.util
import os

import duckdb
import pytest

from conftest import SF_SMALL
from tidewater.sources.tables import TABLES

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
spec = importlib.util.spec_from_file_location("oracle_check", os.path.join(HERE, "tools", "oracle_check.py"))
OC = importlib.util.module_from_spec(spec)
spec.loader.exec_module(OC)
E = OC.E


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(E.catalog.oracle_sql()))
def test_matches_oracle(spark, duck, name):
    sp = E.queries()[name](spark, SF_SMALL).toPandas()
    dk = duck.execute(E.oracle_sql()[name]).df()
    assert sorted(sp.columns) == sorted(dk.columns)
    assert len(sp) == len(dk)
    assert OC._rows(sp) == OC._rows(dk)
