"""Every registered imagery query against its SQL, or for rows where SQL cannot express it."""

from __future__ import annotations

import pytest
from oracle import assert_equal

import __spark_entry__ as entry_module
from skyloom.catalogue import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, name):
    frame = QUERIES[name](spark, sf_dir)
    if name in ORACLE_SQL:
        assert assert_equal(frame, ORACLE_SQL[name], sf_dir) >= 0
    else:
        assert frame.count() > 0


def test_entry(spark):
    assert entry_module.entry(spark).limit(1).count() == 1
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
