"""Every registered query against its SQL on the smallest test data."""

import parity
import pytest

import __spark_entry__ as registry

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return parity.connect(FOLDER)


def test_every_report_has_sql():
    assert set(registry.PLANS) <= set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", list(registry.PLANS))
def test_query_matches_sql(spark, con, name):
    frame = registry.queries()[name](spark, FOLDER)
    assert parity.differences(frame, con, registry.oracle_sql()[name]) is None


def test_entry_has_rows(spark):
    assert registry.entry(spark).limit(1).count() == 1
