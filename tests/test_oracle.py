"""Every registered query against its DuckDB oracle SQL on the sf0.01 tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry
from stellate.plans.oracle import ORACLE_SQL
from stellate.plans.queryset import QUERIES
from tests.conftest import SF001
from tools.oracle_check import compare, duck

NAMES = list(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    result = compare(spark, con, name, QUERIES[name], ORACLE_SQL[name], SF001)
    assert result.startswith("OK"), result


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["year", "month", "nation", "n_orders"]
    assert df.count() > 0


# Operators whose output shape depends on the data (columns chosen by
# completeness) are also checked at the other scale factors.
@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.1"])
def test_data_dependent_shapes_across_scales(spark, sf):
    con = duck(sf)
    for name in ("drop_low_completeness", "profile_completeness", "quality_completeness"):
        result = compare(spark, con, name, QUERIES[name], ORACLE_SQL[name], sf)
        assert result.startswith("OK"), result
