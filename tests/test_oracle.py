"""Every registered query against its SQL twin."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from brooklog.workloads import analytics, log, records, streams
from oracle import difference, duck

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


# queries of other packages are tested beside these
OWN = [name for module in (log, records, analytics, streams) for name in module.QUERIES]


def test_every_query_has_sql():
    assert set(OWN) <= set(contract.queries())
    assert set(OWN) <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(OWN))
def test_query(spark, con, name):
    frame = contract.queries()[name](spark, SF_DIR)
    assert difference(frame, con, contract.oracle_sql()[name]) is None


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
