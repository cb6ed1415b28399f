"""Every registered query against its SQL oracle, on whole tables."""

import os
import re

import pytest

import __spark_entry__ as driver
from tests import oracle_check

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = driver.queries(), driver.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return oracle_check.connect(SF_DIR)


NUMBERED = re.compile(r"op\d+_|pipeline$")  # have their own tests


def test_every_query_has_an_oracle():
    assert {name for name in QUERIES if not NUMBERED.match(name)} == {name for name in ORACLES if not NUMBERED.match(name)}


@pytest.mark.parametrize("name", sorted(name for name in QUERIES if not NUMBERED.match(name)))
def test_query(spark, connection, name):
    differs = oracle_check.compare(spark, connection, name, QUERIES[name], ORACLES[name], SF_DIR)
    assert differs == ""


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["symbol", "timestamp", "open", "high", "low", "close", "volume"]
    assert df.count() > 0
