"""Registered queries: the contract, and a cross-section next to their SQL.

``python -m tests.oracle_check`` runs all of them; set CELLARIUM_ALL=1 to do it here.
"""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from cellarium.workload import catalog
from tests.oracle_check import compare, database

SF_DIR = "/root/testdata/sf0.001"
SOME = [
    "flagship", "scan_row_set_large", "multi_get", "filter_list_nested", "row_filter_scv_missing",
    "cells_per_row_offset", "replay_mutations", "batch_results", "check_absent", "apply_retention",
    "mask_tombstones", "size_guards", "sync_range_counts", "cell_diff_ignore_ts", "repl_metrics",
    "dual_write",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


def test_every_query_has_its_sql():
    assert set(catalog.ORACLES) == set(catalog.QUERIES)
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).columns == ["row_key", "family", "qualifier", "ts", "value"]


@pytest.fixture(scope="module")
def con():
    return database(SF_DIR)


@pytest.mark.parametrize("name", list(contract.queries()) if os.environ.get("CELLARIUM_ALL") else SOME)
def test_query_equals_its_sql(spark, con, name):
    problem = compare(spark, con, name, SF_DIR)
    assert problem in ("", "both empty")
