"""Every registered query against its SQL on the given tables."""

import pytest

import __spark_entry__ as entry
import check
from tidemark.workload.oracle import ORACLE
from tidemark.workload.queries import QUERIES


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, sf_dir, name):
    assert check.compare(spark, duck, sf_dir, name) == ""


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
