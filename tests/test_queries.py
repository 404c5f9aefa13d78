"""Every query against its SQL on the smallest tables, and the driver contract."""

import os
import subprocess
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as contract  # noqa: E402
from check import lines  # noqa: E402
from lodestep.catalog.registry import TABLES  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, db, name):
    frame = contract.queries()[name](spark, DATA)
    answer = db.execute(contract.oracle_sql()[name])
    columns = [item[0] for item in answer.description]
    assert sorted(columns) == sorted(frame.columns)
    mine = lines(frame.columns, [tuple(row) for row in frame.collect()])
    assert mine == lines(columns, answer.fetchall()) and mine


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() > 0


def test_entry_without_the_optional_package():
    """Whatever the optional operators need may be missing: all other queries stay."""
    code = ("import sys; sys.modules['public_tokenizers'] = None; import __spark_entry__ as c; "
            "from lodestep.catalog import QUERIES; assert set(c.queries()) == set(QUERIES)")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)
