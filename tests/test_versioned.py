"""Atomic commits on a partitioned table."""

import uuid

import pytest

from panelcast.session import path_exists, scratch_path
from panelcast.sources.versioned import Conflict, VersionedTable

SCHEMA = "day string, k int, v int"


@pytest.fixture
def table(spark):
    return VersionedTable(spark, scratch_path(spark, f"versioned/{uuid.uuid4().hex}"), "day")


def df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows(table, version=None):
    return sorted((r.day or "", r.k, r.v) for r in table.read(version).collect())


def test_versions_stay_readable(spark, table):
    assert table.version() == 0
    table.upsert(df(spark, [("a", 1, 1), ("a", 2, 1), ("b", 3, 1), (None, 4, 1)]), ["day", "k"])
    table.upsert(df(spark, [("a", 2, 2), ("c", 5, 2)]), ["day", "k"])
    assert rows(table, 1) == [("", 4, 1), ("a", 1, 1), ("a", 2, 1), ("b", 3, 1)]
    assert rows(table) == [("", 4, 1), ("a", 1, 1), ("a", 2, 2), ("b", 3, 1), ("c", 5, 2)]
    table.replace(["b", "c"], df(spark, [("c", 6, 3)]))
    assert rows(table) == [("", 4, 1), ("a", 1, 1), ("a", 2, 2), ("c", 6, 3)] and table.version() == 3
    table.replace(["a", "c"])
    assert rows(table) == [("", 4, 1)] and len(rows(table, 2)) == 5
    with pytest.raises(ValueError):
        table.replace(["a"], df(spark, [("z", 1, 1)]))


def test_untouched_partitions_are_not_written_again(spark, table):
    table.upsert(df(spark, [("a", 1, 1), ("b", 2, 1)]), ["day", "k"])
    before = table._entries(1)[0]
    table.upsert(df(spark, [("a", 1, 2)]), ["day", "k"])
    after = table._entries(2)[0]
    assert after["_part=b"] == before["_part=b"] and after["_part=a"] != before["_part=a"]


def test_stop_between_writing_and_committing(spark, table, monkeypatch):
    table.upsert(df(spark, [("a", 1, 1), ("b", 2, 1)]), ["day", "k"])
    old = rows(table)

    def stop(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(table, "_rename", stop)  # all folders and the pending version are written
    with pytest.raises(KeyboardInterrupt):
        table.upsert(df(spark, [("a", 1, 2), ("b", 2, 2), ("c", 3, 2)]), ["day", "k"])
    monkeypatch.undo()
    assert path_exists(spark, f"{table.path}/pending") and table.version() == 1 and rows(table) == old
    table.upsert(df(spark, [("a", 1, 2), ("b", 2, 2), ("c", 3, 2)]), ["day", "k"])
    assert rows(table) == [("a", 1, 2), ("b", 2, 2), ("c", 3, 2)]


def test_second_writer_starts_again(spark, table, monkeypatch):
    table.upsert(df(spark, [("a", 1, 1)]), ["day", "k"])
    other = VersionedTable(spark, table.path, "day")
    with pytest.raises(Conflict):
        table.commit(0, table.read().schema, {})
    commit, first = table.commit, []

    def late(base, *args, **kw):
        if not first:
            first.append(other.upsert(df(spark, [("a", 2, 7)]), ["day", "k"]))
        return commit(base, *args, **kw)

    monkeypatch.setattr(table, "commit", late)
    table.upsert(df(spark, [("a", 3, 9)]), ["day", "k"])
    assert table.version() == 3 and rows(table) == [("a", 1, 1), ("a", 2, 7), ("a", 3, 9)]


def test_replayed_batch(spark, table):
    table.upsert(df(spark, [("a", 1, 1)]), ["day", "k"], batch=0)
    table.upsert(df(spark, [("a", 1, 2)]), ["day", "k"], batch=1)
    assert table.upsert(df(spark, [("a", 1, 1)]), ["day", "k"], batch=0) == 2 and rows(table) == [("a", 1, 2)]
    table.replace(["a"])
    assert table.upsert(df(spark, [("a", 1, 2)]), ["day", "k"], batch=1) == 3 and rows(table) == []
    table.upsert(df(spark, []), ["day", "k"], batch=2)
    assert rows(table) == [] and table.version() == 4
