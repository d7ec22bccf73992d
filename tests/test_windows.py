"""Windowed check counts: late rows, repeated batches, rows without time."""

import datetime as dt

import pytest

from stratiform.errors import ConfigError
from stratiform.session import new_folder
from stratiform.streaming import files as streams
from stratiform.streaming import windows

SCHEMA = "id int, ts timestamp, v double"
CHECKS = {"range_constraints": {"v": {"min": 0}}}


def _row(number, minute, value=1.0):
    return (number, None if minute is None else dt.datetime(2024, 1, 1, minute // 60, minute % 60), value)


@pytest.fixture
def deliver(spark, new_name):
    path, state, table = new_folder(spark, "in"), new_folder(spark, "state"), new_name("windows")

    def go(data, **more):
        spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(path)
        frame = streams.read_stream(spark, path, "parquet", "web", "e", {"add_metadata_columns": False}, SCHEMA)
        windows.stream_window_counts(frame, table, state, more.get("checks", CHECKS), "ts", "10 minutes", "30 minutes")
        found = windows.window_counts(spark, table)
        return sorted(
            ((r.window_start and r.window_start.hour * 60 + r.window_start.minute, r.status, r.is_late, r.n) for r in found.collect()), key=repr
        )

    return go


def test_late_rows_are_counted_apart(deliver):
    first = deliver([_row(1, 5), _row(2, 9, -1.0), _row(3, 100), _row(4, None)])
    assert first == sorted([(0, "PASS", False, 1), (0, "FAIL", False, 1), (100, "PASS", False, 1), (None, "PASS", False, 1)], key=repr)
    # The latest event is at 100: windows that ended by 70 are closed, that of 61 to 70 as the last.
    then = deliver([_row(5, 6), _row(6, 65), _row(7, 72), _row(8, 101), _row(9, None)])
    assert then == sorted(
        [(0, "PASS", False, 1), (0, "FAIL", False, 1), (0, "PASS", True, 1), (60, "PASS", True, 1), (70, "PASS", False, 1),
         (100, "PASS", False, 2), (None, "PASS", False, 2)], key=repr,
    )


def test_a_repeated_batch_is_there_once(spark, deliver, monkeypatch):
    def lost(*_, **__):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(windows.publish, "compact", lost)
        with pytest.raises(Exception):
            deliver([_row(1, 5), _row(2, 300)])
    assert deliver([_row(3, 301)]) == [(0, "PASS", False, 1), (300, "PASS", False, 2)]


def test_checks_are_looked_at_first(deliver):
    with pytest.raises(ConfigError):
        deliver([_row(1, 5)], checks={"no_such_check": 1})
