"""Streams against their batch forms, fed in several batches."""

import pytest
from pyspark.sql import functions as F

from kinetrace.operators import sequences
from kinetrace.streaming import live


@pytest.fixture
def feed(spark, tmp_path):
    """Rows in batches as a stream: one file per batch, in order."""

    def make(batches, schema):
        import time

        for i, rows in enumerate(batches):
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
            time.sleep(0.02)
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))

    return make


def run(spark, df, mode, name):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return spark.sql(f"SELECT * FROM {name}").collect()


def test_audit(spark, feed):
    times = [0, 10, 20, 20, 15, 90]
    rows = [(1, "s", i, t) for i, t in enumerate(times)]
    out = run(spark, live.running_audit(feed([rows[:2], rows[2:4], rows[4:]], "episode long, stream string, seq long, t long"), 50), "update", "audit")
    last = max(out, key=lambda r: r.n)
    assert (last.n, last.n_zero, last.n_duplicate, last.n_backward, last.n_large_gap, last.last_t) == (6, 1, 1, 1, 1, 90)


def test_ema(spark, feed):
    rows = [(e, t, float(t * e)) for e in (1, 2) for t in range(6)]
    schema = "episode long, t long, value double"
    out = run(spark, live.running_ema(feed([[r for r in rows if r[1] < 3], [r for r in rows if r[1] >= 3]], schema), 0.3), "append", "ema")
    want = sequences.ema(spark.createDataFrame(rows, schema), ["episode"], ["t"], "value", 0.3).collect()
    assert {(r.episode, r.t): round(r.ema, 9) for r in out} == {(r.episode, r.t): round(r.ema, 9) for r in want}


def test_hold(spark, feed):
    schema = "episode long, t long, kind string, value double"
    a = [(1, 5, "anchor", 0.0), (1, 10, "command", 1.0), (1, 10, "anchor", 0.0)]
    b = [(1, 14, "anchor", 0.0), (1, 99, "anchor", 0.0)]
    out = run(spark, live.running_hold(feed([a, b], schema), 20), "append", "hold")
    assert {r.t: (r.value, r.age) for r in out} == {5: (None, None), 10: (1.0, 0), 14: (1.0, 4), 99: (None, 89)}


def test_hold_waits_for_late_rows(spark, feed):
    schema = "episode long, t long, kind string, value double"
    a = [(1, 10, "command", 1.0), (1, 30, "anchor", 0.0)]
    b = [(1, 25, "command", 2.0), (1, 60, "command", 3.0)]
    c = [(1, 70, "anchor", 0.0), (1, 200, "command", 4.0)]
    out = run(spark, live.running_hold(feed([a, b, c], schema), 100, wait=20), "append", "late_hold")
    assert {r.t: (r.value, r.age) for r in out} == {30: (2.0, 5), 70: (3.0, 10)}


def test_ema_values_in_blocks():
    import numpy as np

    x = np.random.default_rng(4).normal(size=1200)
    got = np.concatenate([live.ema_values(x[:700], 0.4, None), live.ema_values(x[700:], 0.4, float(live.ema_values(x[:700], 0.4, None)[-1]))])
    y, want = x[0], []
    for v in x:
        y = 0.6 * y + 0.4 * v
        want.append(y)
    assert np.allclose(got, want)


def test_windows_and_late_rows(spark, feed):
    schema = "ts timestamp, kind string, value double"
    import datetime as d

    at = lambda m: d.datetime(2024, 1, 1) + d.timedelta(minutes=m)
    batches = [[(at(1), "a", 1.0), (at(61), "a", 2.0)], [(at(200), "a", 4.0)], [(at(201), "a", 0.0)], [(at(2), "a", 8.0), (at(300), "a", 0.0)]]
    out = run(spark, live.windowed_counts(feed(batches, schema), "ts", ["kind"], "1 hour", late="30 minutes"), "append", "windows")
    assert {r.start.hour: (r.n, r.total) for r in out} == {0: (1, 1.0), 1: (1, 2.0), 3: (2, 4.0)}


def test_distinct(spark, feed):
    import datetime as d

    at = d.datetime(2024, 1, 1)
    schema = "ts timestamp, id long"
    out = run(spark, live.distinct_events(feed([[(at, 1), (at, 2)], [(at, 1), (at, 3)]], schema), "ts", ["id"], "1 hour"), "append", "ids")
    assert sorted(r.id for r in out) == [1, 2, 3]


def test_shuffled_and_late_rows_give_the_batch_rows(spark, feed):
    import random

    ms = 1000
    rng = random.Random(5)
    rows = [(e, t * ms + e, rng.choice(["anchor", "command"]), float(t)) for e in (1, 2) for t in range(0, 4000, 37)]
    rows.append((1, 2000 * ms + 1, "anchor", None))
    near = sorted(rows, key=lambda r: r[1] + rng.randrange(900 * ms))  # at most 900 ms behind a later row
    flush = [[(3, 10_000 * ms, "command", 0.0)], [(1, 5, "anchor", 0.0), (3, 20_000 * ms, "command", 0.0)], [(1, 21_000 * ms, "anchor", 0.0)], [(3, 40_000 * ms, "anchor", 0.0)]]
    batches = [near[i : i + 40] for i in range(0, len(near), 40)] + flush
    source = feed(batches, "episode long, t long, kind string, value double")
    with live.rocksdb_state(spark):
        out = run(spark, live.ordered_hold(source, 300 * ms, "1 second", idle=15_000 * ms), "append", "ordered")
    want, held = {}, {}
    for e, t, kind, v in sorted(rows, key=lambda r: (r[0], r[1], r[2] == "anchor")):
        if kind == "command":
            held[e] = (t, v)
        else:
            age = t - held[e][0] if e in held else None
            want[e, t] = (held[e][1] if age is not None and age <= 300 * ms else None, age)
    # The anchor behind the watermark is dropped; the one after a long pause finds no command any more.
    want[1, 21_000 * ms] = (None, None)
    assert {(r.episode, r.t): (r.value, r.age) for r in out} == want


def test_held_at():
    import numpy as np

    t, v, last = live.held_at(np.array([1, 2, 3]), np.array([True, False, True]), np.array([0.0, 5.0, 0.0]), None)
    assert t.tolist() == [-1, 2, 2] and v[1:].tolist() == [5.0, 5.0] and last == (2, 5.0)
    assert live.held_at(np.array([4]), np.array([True]), np.array([0.0]), (3, 7.0))[2] == (3, 7.0)
    assert live.held_at(np.array([4]), np.array([True]), np.array([0.0]), None)[2] is None
