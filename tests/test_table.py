"""The merged table with a manifest: writers beside each other, failures, compaction."""

from __future__ import annotations

from pathlib import Path

import pytest
from gaugeloom.session import scratch
from gaugeloom.streaming import table
from helpers import at, by_key, obs_frame

DAY = 24 * 60


def folders(path):
    return [p.name for p in Path(path, "data").glob("*") if p.is_dir()]


def test_first_value_stays_and_a_batch_counts_once(spark):
    path = scratch(spark, "table")
    table.merge_into(obs_frame(spark, [("A", 0, 1.0), ("A", 5, None)]), path, "r", 0)
    table.merge_into(obs_frame(spark, [("A", 0, 9.0), ("A", 5, 9.0), ("B", 0, 2.0)]), path, "r", 1)
    table.merge_into(obs_frame(spark, [("C", 0, 7.0)]), path, "r", 1)  # a repeated number of the same run
    table.merge_into(obs_frame(spark, [("D", 0, 8.0)]), path, "other", 0)
    want = {("A", at(0)): 1.0, ("A", at(5)): None, ("B", at(0)): 2.0, ("D", at(0)): 8.0}
    assert by_key(table.read_merged(spark, path)) == want


def test_two_writers_do_not_both_win(spark, monkeypatch):
    """While one writer works another commits; the first starts over and adds only what is still new."""
    path = scratch(spark, "table")
    table.merge_into(obs_frame(spark, [("A", 0, 1.0)]), path, "r", 0)
    write, beside = table._write, []

    def slow(rows, where):
        if not beside:
            beside.append(True)
            table.merge_into(obs_frame(spark, [("A", 5, 2.0)]), path, "second", 0)
        return write(rows, where)

    monkeypatch.setattr(table, "_write", slow)
    table.merge_into(obs_frame(spark, [("A", 5, 9.0), ("A", 10, 3.0)]), path, "r", 1)
    want = {("A", at(0)): 1.0, ("A", at(5)): 2.0, ("A", at(10)): 3.0}
    rows = table.read_merged(spark, path)
    assert rows.count() == 3 and by_key(rows) == want
    assert table.live(spark, path)[0] == 3 and not table._commit(spark, path, 3, {"days": {}, "batches": {}})
    assert by_key(table.read_merged(spark, path)) == want


def test_compaction_keeps_rows_and_folders_few(spark):
    path = scratch(spark, "table")
    want = {}
    for n in range(6):
        rows = [("A", n * 10, float(n)), ("B", n * 10, None), ("A", DAY * n, float(n))]
        table.merge_into(obs_frame(spark, rows), path, "r", n)
        table.compact(spark, path, many=3)
        want |= {(s, at(m)): v for s, m, v in rows if (s, at(m)) not in want}
        days = table.live(spark, path)[1]["days"]
        assert max(map(len, days.values())) <= 3
    assert by_key(table.read_merged(spark, path)) == want
    assert by_key(table.read_merged(spark, path, ["2021-09-03"])) == {("A", at(2 * DAY)): 2.0}
    assert len(folders(path)) > len({f for names in days.values() for f in names})


def test_a_failed_writer_leaves_nothing(spark, monkeypatch):
    path = scratch(spark, "table")
    table.merge_into(obs_frame(spark, [("A", 0, 1.0)]), path, "r", 0)

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(table, "_commit", lost)
        with pytest.raises(OSError):
            table.merge_into(obs_frame(spark, [("A", 5, 2.0)]), path, "r", 1)
        table_rows = table.read_merged(spark, path)
        assert by_key(table_rows) == {("A", at(0)): 1.0}
    table.merge_into(obs_frame(spark, [("A", 5, 3.0)]), path, "r", 1)
    assert by_key(table.read_merged(spark, path)) == {("A", at(0)): 1.0, ("A", at(5)): 3.0}


def test_an_empty_table_and_rows_without_keys(spark):
    path = scratch(spark, "table")
    assert table.read_merged(spark, path).count() == 0
    table.compact(spark, path)
    rows = spark.createDataFrame([(None, at(0), 1.0), ("A", None, 2.0)], "station string, time timestamp_ntz, value double")
    table.merge_into(rows, path, "r", 0)
    assert table.read_merged(spark, path).count() == 0 and table.live(spark, path)[1]["batches"] == {"r": 0}
