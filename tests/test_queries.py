"""Every registered query against its SQL, and the driver's entry points."""

import __spark_entry__ as driver
import pytest
from conftest import SF
from oracle import connect, differences

from tickstone.plans import REGISTRY


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", [n for n, q in REGISTRY.items() if q.sql])
def test_matches_sql(spark, con, name):
    assert differences(REGISTRY[name].run(spark, SF), con, REGISTRY[name].sql) is None


@pytest.mark.parametrize("name", [n for n, q in REGISTRY.items() if not q.sql])
def test_rows_without_sql(spark, name):
    assert not REGISTRY[name].run(spark, SF).isEmpty()


def test_entry_points(spark):
    assert driver.queries().keys() >= REGISTRY.keys()
    assert driver.oracle_sql().keys() <= driver.queries().keys()
    assert not driver.entry(spark).isEmpty()


def test_approximate_distinct_is_close(spark):
    exact = REGISTRY["distinct_exact"].run(spark, SF)
    approx = REGISTRY["distinct_approx"].run(spark, SF).withColumnRenamed("distinct_count", "guess")
    both = exact.join(approx, ["window_start", "window_end", "user_id"])
    assert both.count() == exact.count()
    assert both.where("abs(guess - distinct_count) > 0.1 * distinct_count + 1").isEmpty()
