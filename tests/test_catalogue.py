"""Each query with SQL gives DuckDB's rows on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from compare import differences

from curafold.catalogue import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, name):
    assert not differences(spark, FOLDER, name, QUERIES[name], SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs_without_sql(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0
