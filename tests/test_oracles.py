"""Every registered query against DuckDB on the same tables."""

import os
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from tallystar.plans.oracles import ORACLES
from tallystar.plans.queries import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables not there")

# Arrow's names for the types of the two engines differ only in these.
SAME_TYPE = {"timestamp[us, tz=UTC]": "timestamp[us]", "large_string": "string"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    yield connection
    connection.close()


def types(table):
    named = {field.name: str(field.type) for field in table.schema}
    return {name: SAME_TYPE.get(kind, kind) for name, kind in named.items()}


def in_order(table):
    names = sorted(table.column_names)
    columns = [table.column(name).to_pylist() for name in names]
    return [
        tuple(v.normalize() if isinstance(v, Decimal) else v for v in row) for row in zip(*columns)
    ]


def rows(table):
    return sorted(in_order(table), key=repr)


ORDERED = [
    "sort_multi",
    "top_k",
    *(name for name in ORACLES if name.startswith("report_")),
]


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", list(ORACLES))
def test_query(spark, duck, name):
    ours = contract.queries()[name](spark, FOLDER).toArrow()
    theirs = duck.execute(ORACLES[name]).to_arrow_table()
    assert types(ours) == types(theirs)
    assert rows(ours) == rows(theirs)
    assert ours.num_rows > 0


@pytest.mark.parametrize("name", ORDERED)
def test_order(spark, duck, name):
    ours = contract.queries()[name](spark, FOLDER).toArrow()
    theirs = duck.execute(ORACLES[name]).to_arrow_table()
    assert in_order(ours) == in_order(theirs)


@pytest.mark.parametrize("name", ["dim_time_text", "fact_inventory", "report_quarterly_profit"])
def test_dates_do_not_depend_on_the_time_zone(spark, duck, name):
    spark.conf.set("spark.sql.session.timeZone", "Pacific/Apia")
    try:
        ours = contract.queries()[name](spark, FOLDER).toArrow()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert rows(ours) == rows(duck.execute(ORACLES[name]).to_arrow_table())


def test_entry(spark):
    assert contract.entry(spark).count() == 4
