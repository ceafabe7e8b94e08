"""Runs published by manifest: what is half written is never read, reruns replace, empty reruns remove, leftovers go."""

import os

import pytest

from lectern.plans.oracle_check import compare, duckdb_con
from lectern.plans.registry import load_all
from lectern.sources import published
from lectern.sources.published import Published


def rows(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v long")


@pytest.fixture
def table(spark, tmp_path):
    return Published(spark, str(tmp_path / "t"), rows(spark, []).schema)


def seen(table, slot=None):
    return sorted(r.v for r in table.read(slot).collect())


def test_publish_replace_remove(spark, table):
    assert seen(table) == [] and table.slots() == {}
    assert table.publish(rows(spark, [1, 2]), "a") == 2
    assert table.publish(rows(spark, [3]), "b") == 1
    assert seen(table) == [1, 2, 3] and seen(table, "b") == [3]
    table.publish(rows(spark, [9]), "a")
    assert seen(table) == [3, 9]
    assert table.publish(rows(spark, []), "a") == 0
    assert seen(table) == [3] and set(table.slots()) == {"b"}


def test_a_run_killed_half_way_is_never_read(spark, table, monkeypatch, tmp_path):
    table.publish(rows(spark, [1]), "a")
    monkeypatch.setattr(Published, "_commit", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):  # rows written, manifest not
        table.publish(rows(spark, [2]), "a")
    monkeypatch.undo()
    assert seen(table) == [1]
    with open(table._manifest(2), "w") as f:  # a manifest that was begun only
        f.write('{"a": {"pa')
    assert seen(table) == [1]
    table.publish(rows(spark, [5]), "c")
    assert seen(table) == [1, 5] and table.versions() == [1, 2, 3]
    gone = table.collect()
    assert len(gone) == 1 and seen(table) == [1, 5]
    assert len(os.listdir(tmp_path / "t" / "data")) == 2 and table.versions() == [3]
    assert table.collect() == []


def test_two_publishers_keep_each_others_slots(spark, table, monkeypatch):
    table.publish(rows(spark, [1]), "a")
    real, other = Published.versions, Published(spark, table.base, table.schema)
    stale = iter([[1]])

    def versions(self):
        known = next(stale, None) if self is table else None
        if known is not None:  # the other run publishes after this one has looked
            other.publish(rows(spark, [2]), "b")
            return known
        return real(self)

    monkeypatch.setattr(published.Published, "versions", versions)
    table.publish(rows(spark, [3]), "c")
    monkeypatch.undo()
    assert seen(table) == [1, 2, 3]


def test_daily_job_equals_sql(spark, sf_small):
    load_all()
    assert compare(spark, "job_daily_published", sf_small, duckdb_con(sf_small))["status"] == "match"
