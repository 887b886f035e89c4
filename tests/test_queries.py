"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_module
from tests.compare import connect, same
from tidepair.plans.oracles import ORACLES
from tidepair.plans.queries import REGISTRY

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert REGISTRY.keys() == ORACLES.keys()
    assert REGISTRY.items() <= entry_module.queries().items()
    assert ORACLES.items() <= entry_module.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_sql(spark, con, name):
    result = entry_module.queries()[name](spark, SF_DIR)
    ok, note = same(result, con, entry_module.oracle_sql()[name])
    assert ok, note


def test_queries_do_not_depend_on_the_session_time_zone(spark, con):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for name in ("clean_series", "sketch_similarity_windows", "stream_cells", "stream_progress"):
            result = entry_module.queries()[name](spark, SF_DIR)
            ok, note = same(result, con, entry_module.oracle_sql()[name])
            assert ok, (name, note)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_entry(spark):
    assert entry_module.entry(spark).count() == 20
