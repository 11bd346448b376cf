"""Registered queries against their SQL, at the smallest scale. tests/compare.py checks all of them."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
sys.path.insert(0, str(Path(__file__).parent.parent))

import __spark_entry__ as driver  # noqa: E402
import compare  # noqa: E402
from sentloom.plans.oracles import ORACLES  # noqa: E402
from sentloom.plans.queries import QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    got, want, *_ = compare.check(spark, con, FOLDER, name, QUERIES[name], ORACLES[name])
    assert got == want


def test_entry(spark):
    rows = {r["lang"]: r["sentences"] for r in driver.entry(spark).collect()}
    assert sum(rows.values()) == 9382
