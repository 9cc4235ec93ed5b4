"""Streaming forms over small folders of files: late rows, sessions, newest values, bounded pools, restarts."""

import datetime as dt

import pytest

from curafold.streaming import events as S

SCHEMA = "event_id long, ts timestamp, user_id long, event_type string, value double"


def at(minutes):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minutes)


@pytest.fixture
def stream(spark, tmp_path):
    """put(rows) adds a file; run(make, mode) processes what is new and gives the sink's rows so far."""
    source, state = tmp_path / "in", {"n": 0}
    source.mkdir()

    def put(rows):
        state["n"] += 1
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(source))

    def run(make, mode, name="out"):
        events = S.new_files(spark, str(source), SCHEMA)
        query = make(events).writeStream.outputMode(mode).option("checkpointLocation", str(tmp_path / f"check-{name}")).trigger(availableNow=True)
        got = []
        query.foreachBatch(lambda df, _: got.extend(map(tuple, df.collect()))).start().awaitTermination(60)
        return got

    return put, run


def test_windows_drop_late_rows(stream):
    put, run = stream
    put([(1, at(0), 1, "a", 1.0), (2, at(10), 1, "a", 2.0)])
    put([(3, at(200), 1, "a", 5.0)])
    first = run(S.windowed, "append")
    assert first == [(at(0), "a", 2, 3.0)] or first == []  # the watermark follows a batch
    put([(4, at(5), 1, "a", 9.0), (5, at(400), 1, "a", 1.0)])  # the first row is late by now
    later = run(S.windowed, "append")
    assert sorted(first + later) == [(at(0), "a", 2, 3.0), (at(180), "a", 1, 5.0)]


def test_sessions(stream):
    put, run = stream
    put([(1, at(0), 1, "a", 1.0), (2, at(20), 1, "a", 1.0), (3, at(90), 1, "a", 1.0), (4, at(500), 2, "a", 1.0)])
    assert sorted(run(S.user_sessions, "append")) == [(1, at(0), 2), (1, at(90), 1)]


def test_newest_values_across_restarts(stream):
    put, run = stream
    put([(1, at(0), 1, "a", 1.0), (2, at(5), 1, "a", 2.0), (3, at(5), 2, "a", 3.0)])
    assert sorted(run(S.latest_values, "update")) == [(1, 2, 2.0), (2, 3, 3.0)]
    put([(9, at(1), 1, "a", 7.0), (5, at(5), 2, "a", 8.0)])  # older for user 1, equal time and larger number for user 2
    assert sorted(run(S.latest_values, "update")) == [(1, 2, 2.0), (2, 5, 8.0)]


def test_pool_emits_each_row_once(stream):
    put, run = stream
    pool = lambda events: S.shuffle_pool(events, pools=1, size=10)
    put([(i, at(i), 1, "a", 1.0) for i in range(25)])
    first = run(pool, "append")
    put([(i, at(i), 1, "a", 1.0) for i in range(25, 40)])
    later = run(pool, "append")
    out = [x for _, x in first + later]
    assert len(first) == 15 and len(out) == 30 and len(set(out)) == 30 and out != sorted(out)
