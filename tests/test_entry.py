import os

import pytest

import __spark_entry__ as entry

SMALL = "/root/testdata/sf0.001"


def test_names():
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and "p4_found" in queries


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the test tables")
def test_entry(spark):
    assert entry.entry(spark).count() > 0
    for name in ("org_registry", "geo_methods", "p7_found", "stream_first_seen"):
        assert entry.queries()[name](spark, SMALL).count() > 0
