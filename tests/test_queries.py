"""Every registered query of the core against its SQL."""

import threading

import pytest
from oracle_check import connect, differences

import __spark_entry__ as e
from sparkelt import oracle
from sparkelt import queries as registry
from sparkelt import schemas as S


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(registry.queries()) == set(oracle.oracle_sql())
    assert set(registry.queries()) <= set(e.queries()) and set(oracle.oracle_sql()) <= set(e.oracle_sql())


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query_matches_its_sql(spark, sf_dir, duck, name):
    assert differences(registry.queries()[name](spark, sf_dir), duck, oracle.oracle_sql()[name]) is None


def test_entry(spark):
    rows = e.entry(spark).collect()
    assert [r.payment_name for r in rows] == sorted(r.payment_name for r in rows)
    assert {"Cash", "Credit card"} <= {r.payment_name for r in rows}
    assert all(r.trips > 0 and r.mean_duration > 0 for r in rows)


def test_feeds_run_at_the_same_time(spark):
    both = threading.Barrier(2, timeout=20)

    def of(feed):
        both.wait()
        return spark.createDataFrame([(feed.raw_name,)], f"{feed.fee} string")

    found = registry._both_feeds(of).select("taxi_type", *[f.fee for f in S.FEEDS.values()]).collect()
    assert [tuple(r) for r in found] == [("green", S.GREEN.raw_name, None), ("yellow", None, S.YELLOW.raw_name)]
