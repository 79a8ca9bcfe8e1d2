"""Every query that has an oracle matches DuckDB, as the driver checks it.

The driver compares at sf0.01; set ``KESTREL_ORACLE_DIRS`` (comma-separated
data folders) to compare at other scales as well.
"""

import os

import pytest

import __spark_entry__ as entry_mod
from support import SF01
from oracle import compare, duck

ORACLES = entry_mod.oracle_sql()
DIRS = [d for d in os.environ.get("KESTREL_ORACLE_DIRS", SF01).split(",") if d]
_CONS = {}


def _con(data_dir):
    if data_dir not in _CONS:
        _CONS[data_dir] = duck(data_dir)
    return _CONS[data_dir]


@pytest.mark.parametrize("data_dir", DIRS)
@pytest.mark.parametrize("key", sorted(ORACLES))
def test_matches_duckdb(spark, key, data_dir):
    problems = compare(spark, _con(data_dir), entry_mod.queries()[key], ORACLES[key], data_dir)
    assert not problems, problems


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry_mod.queries())


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["label", "prediction", "percentage"]
