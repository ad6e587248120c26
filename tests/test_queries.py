"""Every registered query against its SQL, and what its plan has to look like."""

import os

import pytest

import check_queries
from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not here")


@pytest.fixture(scope="module")
def tables():
    return check_queries.connect(SF_DIR)


def test_every_query_has_its_sql():
    without = set(queries()) - set(oracle_sql())
    assert set(oracle_sql()) <= set(queries())
    assert all(name == "pipeline" or name.startswith("op") for name in without)


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_query_equals_sql(spark, tables, name):
    frame = queries()[name](spark, SF_DIR)
    assert check_queries.difference(frame, tables, oracle_sql()[name]) is None


def test_entry(spark):
    assert entry(spark).count() == 1500


def test_published_layer_is_one_stage(spark, plan):
    text = plan(queries()["published_layer"](spark, SF_DIR))
    assert "Exchange" not in text and text.count("FileScan") == 1


def test_year_range_prunes_partitions(spark, plan):
    text = plan(queries()["year_range"](spark, SF_DIR))
    assert "(release_year" in text.split("PartitionFilters")[1]


def test_covered_years_scans_nothing(spark, plan):
    assert "FileScan" not in plan(queries()["covered_years"](spark, SF_DIR))
