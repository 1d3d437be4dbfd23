"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry_module
from compare import compare, connect

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_entry(spark):
    assert entry_module.entry(spark).count() == 200


def test_every_query_has_sql():
    assert not {n for n in set(entry_module.queries()) - set(entry_module.oracle_sql()) if n != "pipeline" and not n.startswith("op")}


@pytest.mark.parametrize("name", sorted(n for n in entry_module.oracle_sql() if n != "pipeline" and not n.startswith("op")))
def test_query(spark, con, name):
    assert compare(spark, con, FOLDER, name, entry_module.queries()[name], entry_module.oracle_sql()[name]) is None


def test_template_budget_brings_one_row_to_the_driver(spark, tmp_path, monkeypatch):
    from spanloom.plans.queries import template_budget

    frame = spark.createDataFrame([("ab",), (" c ",), ("def",), ("ab",)], "event_type string")
    frame.write.parquet(f"{tmp_path}/events.parquet")
    brought, collect = [], type(frame).collect
    monkeypatch.setattr(type(frame), "collect", lambda self: brought.append(rows := collect(self)) or rows)
    out = template_budget(spark, str(tmp_path))
    assert brought and all(len(rows) <= 1 for rows in brought)
    assert [tuple(r) for r in out.collect()] == [(3, 13, 755)]
