"""Every registered query against its SQL, and the rules the registry keeps."""

import duckdb
import pytest

import __spark_entry__ as entry_module
from check import compare, oracle
from ledgerflow.plans import registry

NAMES = list(registry.QUERIES)


@pytest.fixture(scope="module")
def connection(sf_dir):
    return oracle(sf_dir)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, sf_dir, connection, name):
    frame = entry_module.queries()[name](spark, sf_dir)
    assert compare(frame, connection, entry_module.oracle_sql()[name]) == ""


def test_every_query_has_sql():
    assert set(registry.ORACLES) == set(NAMES)


def test_entry_has_a_stable_schema(spark):
    frame = entry_module.entry(spark)
    assert frame.columns == ["source_folder_id", "high_water_mark", "low_water_mark"]
    assert frame.count() > 0


def test_oracle_runs_without_network():
    assert duckdb.connect().execute("SELECT json_valid('{}')").fetchone() == (True,)
