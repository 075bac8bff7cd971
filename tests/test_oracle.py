"""Every registered query against its SQL on the given tables."""

import math

import duckdb
import pytest

import __spark_entry__ as registry
from paceline.operators.skew import LOOKUP_ROWS_CONF, MAX_ROWS_CONF
from paceline.queries import all_queries, all_sql
from tests.helpers import TABLES

QUERIES, SQL = all_queries(), all_sql()
# Forests of many trees have their own tests; those of one exact tree have SQL.
MODELS = {name for name in QUERIES if name.startswith("rf_")}


@pytest.fixture(scope="module")
def oracle(data_module):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{data_module}/{name}.parquet'")
    return con


@pytest.fixture(scope="module")
def data_module():
    from tests.conftest import DATA

    if not DATA.exists():
        pytest.skip("no test tables")
    return str(DATA)


def ordered(found):
    clean = [[0.0 if isinstance(v, float) and (v == 0 or math.isnan(v)) else v for v in r] for r in found]
    return sorted(clean, key=lambda r: tuple((v is not None, str(v)) for v in r))


def test_every_query_has_sql():
    assert set(QUERIES) - MODELS <= set(SQL) <= set(QUERIES)
    assert set(QUERIES) <= set(registry.queries()) and set(SQL) <= set(registry.oracle_sql())


@pytest.fixture(params=["plain", "divided"])
def limits(spark, request):
    """Every check runs twice: as it is, and with limits so small that groups are divided and lookups joined."""
    if request.param == "divided":
        spark.conf.set(MAX_ROWS_CONF, "100")
        spark.conf.set(LOOKUP_ROWS_CONF, "2")
    yield request.param
    for name in (MAX_ROWS_CONF, LOOKUP_ROWS_CONF):
        spark.conf.unset(name)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, oracle, data_module, limits, name):
    df = QUERIES[name](spark, data_module)
    result = oracle.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    places = [names.index(c) for c in df.columns]
    expected = ordered([r[i] for i in places] for r in result.fetchall())
    found = ordered(list(r) for r in df.collect())
    assert found and found == expected


def test_entry(spark):
    df = registry.entry(spark)
    assert df.count() > 0
    assert {"form", "career", "pace_rank"} <= set(df.columns)
