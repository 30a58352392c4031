"""Every registered query equals its DuckDB twin (multiset of rows, names, type families) at sf0.001."""

import duckdb
import pytest
from compare import differences, views

from martforge.plans.oracle_registry import ORACLE
from martforge.plans.queries import REGISTRY


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    views(con, sf)
    return con


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(REGISTRY)


def test_the_entry_module_offers_them_all():
    import __spark_entry__

    assert set(REGISTRY) <= set(__spark_entry__.queries()) and set(ORACLE) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, sf, duck, name):
    assert differences(REGISTRY[name](spark, sf), duck.sql(ORACLE[name])) == []
