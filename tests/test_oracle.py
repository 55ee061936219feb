"""Every registered query against its SQL twin."""

import os

import pytest

import __spark_entry__ as entry
from botiquin.plans.registered import QUERIES
from oracle_queries import ORACLE
from tests.compare import connect, difference

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    assert difference(df, con, ORACLE[name]) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
