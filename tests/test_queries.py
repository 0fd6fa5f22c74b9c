"""Every registered query against its SQL on the smallest supplied tables."""

import functools
import os

import pytest

import __spark_entry__ as contract
from queries.common import REGISTRY
from tests.check_oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the supplied tables are not here")

# A site has fewer than 100 such rows at this size, or a rollup passes no threshold.
MAY_BE_EMPTY = {
    "meter_theft_rollup", "outage_rollup", "pos_rollup", "assurance_rollup", "offers_rollup", "pricing_rollup",
    "scan_pages", "customer_value_rollup", "fraud_rollup",
}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", [n for n, q in REGISTRY.items() if q.sql is not None])
def test_query_equals_sql(spark, con, name):
    verdict, detail = compare(REGISTRY[name], spark, con, SF_DIR)
    assert verdict == "ok", detail
    assert name in MAY_BE_EMPTY or not detail.startswith("0 rows")


def test_contract(spark):
    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert {n for n, q in REGISTRY.items() if q.sql is None} == set()


ORDERED = {
    "sales_details": [("sales_date", True), ("sales_id", False)],
    "sales_by_region": [("total_sales", True), ("region", False)],
    "sales_by_month": [("sales_year", False), ("sales_month", False)],
    "product_performance": [("revenue", True), ("product_id", False)],
    "supply_chain_view": [("production_date", True), ("sales_amount", True), ("batch_id", False)],
}


@pytest.mark.parametrize("name", ORDERED)
def test_sorted_results_come_in_order(spark, name):
    """The rows as collected, by each key in its direction; NULL goes first ascending and last descending."""
    rows = REGISTRY[name].run(spark, SF_DIR).collect()
    key = lambda r: [
        (r[c] is None, Down(r[c])) if down else (r[c] is not None, r[c]) for c, down in ORDERED[name]
    ]
    assert len(rows) > 3
    for a, b in zip(rows, rows[1:]):
        assert key(a) <= key(b), (a, b)


@functools.total_ordering
class Down:
    """Sorts the other way round."""

    def __init__(self, value):
        self.value = value

    def __eq__(self, other):
        return self.value == other.value

    def __lt__(self, other):
        return other.value is not None and (self.value is None or self.value > other.value)
