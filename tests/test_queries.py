"""Every registered query gives the rows of its SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from catalog.oracle import ORACLE
from catalog.queries import QUERIES

from .compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_entry(spark):
    row = contract.entry(spark).first()
    # figures worked out beforehand on independent SQL
    assert (row.rows_raw, row.rows_after_hard_clean) == (1500, 1449)
    assert (row.completeness_pct, row.validity_pct) == (96.6, 96.67)
    assert (row.uniqueness_pct, row.timeliness_pct) == (99.47, 96.93)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= contract.queries().items() and ORACLE.items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert differences(spark, con, SF_DIR, QUERIES[name], ORACLE[name]) == []
