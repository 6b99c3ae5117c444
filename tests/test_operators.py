"""Operators on small hand-made inputs with known results."""

import collections
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinetrace.operators import asof, audit, etl, lags, ordering, scans, sequences, shards, signal, statistics


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_nearest_takes_the_earlier_of_equals_and_clamps(spark):
    a = frame(spark, [(1, 10), (1, -5), (1, 99), (2, 1)], "k int, t long")
    s = frame(spark, [(1, 0), (1, 20)], "k int, t long")
    got = {(r.k, r.t): r.src.t if r.src else None for r in asof.nearest(a, s, ["k"]).collect()}
    assert got == {(1, 10): 0, (1, -5): 0, (1, 99): 20, (2, 1): None}


def test_backward_includes_equal_times_and_buckets_agree(spark):
    a = frame(spark, [(1, t) for t in (0, 5, 7, 400, 1000)], "k int, t long")
    s = frame(spark, [(1, 5, 1.0), (1, 6, 2.0), (1, 300, 3.0)], "k int, t long, v double")
    want = {0: None, 5: 1.0, 7: 2.0, 400: 3.0, 1000: 3.0}
    for bucket in (None, 10, 250):
        assert {r.t: r.src.v if r.src else None for r in asof.backward(a, s, ["k"], bucket=bucket).collect()} == want


def test_linear_copies_hits_and_reports_brackets(spark):
    a = frame(spark, [(1, t) for t in (0, 10, 15, 20, 21)], "k int, t long")
    s = frame(spark, [(1, 10, [0.0, 1.0]), (1, 20, [10.0, 3.0])], "k int, t long, v array<double>")
    got = {r.t: (r.v, r.gap) for r in asof.linear(a, s, ["k"], vector=True).collect()}
    assert got == {0: (None, None), 10: ([0, 1], 0), 15: ([5, 2], 10), 20: ([10, 3], 0), 21: (None, None)}


def test_intervals_and_buckets(spark):
    p = frame(spark, [(1, i) for i in range(10)], "k int, x long")
    i = frame(spark, [(1, 2, 5, "a"), (1, 4, 4, "empty"), (1, 4, 20, "b")], "k int, a long, b long, n string")
    got = sorted((r.x, r.n) for r in asof.in_intervals(p, i, ["k"], "x", "a", "b", width=3).collect())
    assert got == sorted([(x, "a") for x in (2, 3, 4)] + [(x, "b") for x in range(4, 10)])
    s = frame(spark, [(1, 0, 1.0), (1, 3, 2.0), (1, 31, 3.0)], "k int, t long, v double")
    got = [(r.bucket, r.t) for r in asof.first_in_bucket(s, ["k"], "t", 10, ["v"]).orderBy("bucket").collect()]
    assert got == [(0, 0), (1, 0), (2, 0), (3, 31)]


def test_ema_and_runs(spark):
    e = frame(spark, [(1, 0, 0.0), (1, 1, 10.0), (1, 2, 20.0)], "k int, t long, v double")
    assert [round(r.ema, 6) for r in sequences.ema(e, ["k"], ["t"], "v", 0.3).orderBy("n").collect()] == [0, 3, 8.1]
    flags = frame(spark, [(1, i, f) for i, f in enumerate([True, True, None, True, True, True, False])] + [(2, 0, False)], "k int, t int, f boolean")
    assert {r.k: r.longest for r in sequences.longest_run(flags, ["k"], ["t"], F.col("f")).collect()} == {1: 3, 2: 0}
    d = frame(spark, [(1, i, x) for i, x in enumerate("aabbbc")] + [(2, 0, "a"), (2, 1, "b")], "k int, t int, d string")
    assert {r.k: r.frozen for r in sequences.frozen_run(d, ["k"], ["t"], "d").collect()} == {1: 3, 2: 0}


def test_unwrap_and_signs_follow_numpy(spark):
    rng = np.random.default_rng(1)
    a = rng.uniform(-math.pi, math.pi, 60)
    df = frame(spark, [(1, i, float(x)) for i, x in enumerate(a)], "k int, t int, a double")
    got = [r.unwrapped for r in sequences.unwrapped(df, ["k"], ["t"], "a").orderBy("t").collect()]
    assert np.allclose(got, np.unwrap(a))
    q = rng.normal(size=(40, 4))
    want = [q[0]]
    for x in q[1:]:
        want.append(-x if x @ want[-1] < 0 else x)
    df = frame(spark, [(1, i, x.tolist()) for i, x in enumerate(q)], "k int, t int, q array<double>")
    got = [r.continuous for r in sequences.sign_continuous(df, ["k"], ["t"], "q").orderBy("t").collect()]
    assert np.allclose(got, want)


def test_motion_window(spark):
    x = frame(spark, [(1, i, s) for i, s in enumerate([None, 0.0, 1.0, 1.0])], "k int, t int, s double")
    got = sequences.motion_window(x, ["k"], "t", {"s": 0.5}, 1).first()
    assert (got.start, got.stop) == (2, 4)
    still = frame(spark, [(1, i, 0.0) for i in range(5)], "k int, t int, s double")
    assert tuple(sequences.motion_window(still, ["k"], "t", {"s": 0.5}, 1).first())[1:] == (0, 5)


def test_chunks_and_gather(spark):
    df = frame(spark, [(1, i, [float(i)]) for i in range(4)], "k int, step long, v array<double>")
    got = {r.step: [x[0] for x in r.chunk] for r in sequences.chunks(df, ["k"], ["step"], "v", 3).collect()}
    assert got == {0: [0, 1, 2], 1: [1, 2, 3], 2: [2, 3, 3], 3: [3, 3, 3]}
    replay = sequences.chunks(df, ["k"], ["step"], "v", 3, every=2).collect()
    assert sorted(r.step for r in replay) == [0, 2]
    for boundary, want in (("clamp", [0, 0]), ("wrap", [3, 0])):
        rows = sequences.delta_gather(df, ["k"], "step", "v", [-1, 0], boundary).where("step = 0").orderBy("delta").collect()
        assert [r.v[0] for r in rows] == want
    with pytest.raises(Exception, match="outside"):
        sequences.delta_gather(df, ["k"], "step", "v", [-1], "error").collect()
    with pytest.raises(ValueError):
        sequences.delta_gather(df, ["k"], "step", "v", [-1], "other")
    c = frame(spark, [([[1.0], [3.0], [6.0]],)], "c array<array<double>>")
    r = c.select(sequences.relative_chunk("c"), sequences.delta_chunk("c"), sequences.absolute_chunk(sequences.relative_chunk("c"), F.col("c")[0])).first()
    assert list(r) == [[[0], [2], [5]], [[0], [2], [3]], [[1], [3], [6]]]


def test_audit_counts(spark):
    ms = 1_000_000
    rows = [(1, "s", i, t * ms, t * ms + (i + 1) * ms) for i, t in enumerate([10, 20, 30, 30, 25, 60])]
    m = frame(spark, rows, "e int, stream string, seq int, t long, b long")
    a = audit.stream_audit(m, ["e", "stream"], 10**9, 15 * ms, bag_t="b").first()
    assert (a.n, a.n_duplicate, a.n_backward, a.n_large_gap, a.n_dropped, a.largest_gap_at) == (6, 1, 1, 1, 3, 25 * ms)
    assert a.offset_drift == 5 * ms and a.interval_median == 10 * ms and a.frequency == 100
    r = audit.stream_reasons(audit.stream_audit(m, ["e", "stream"], 10**9, 15 * ms), ["e"]).first()
    assert r.reasons == ["non_monotonic_header_timestamp"] and r.warnings == ["raw_gap_exceeded"]


def test_audit_of_one_message_and_of_equal_gaps(spark):
    """As in the query's SQL: no step, no count of steps; of equal largest gaps the first."""
    rows = [(1, 7, 5), *((2, i, t) for i, t in enumerate([0, 1, 10, 11, 20, 21, 30]))]
    m = frame(spark, rows, "e int, seq int, t long")
    one, two = audit.stream_audit(m.repartition(3), ["e"], 10**9, 8).orderBy("e").collect()
    assert (one.n, one.n_zero, one.n_duplicate, one.n_backward, one.n_large_gap, one.largest_gap_at, one.n_dropped) == (1, 0, None, None, None, None, 0)
    assert (two.interval_max, two.n_large_gap, two.largest_gap_at) == (9, 3, 1)
    r = audit.stream_reasons(audit.stream_audit(m, ["e"], 10**9, 8), ["e"]).orderBy("e").collect()
    assert [(x.reasons, x.warnings) for x in r] == [([], []), (["zero_header_timestamp"], ["raw_gap_exceeded"])]


def test_payload_faults(spark):
    rows = [(1, 0, [1.0, 2.0], ["a", "b"]), (1, 1, [float("nan"), 2.0], ["a", "b"]), (1, 2, [1.0, 2.0], ["b", "a"]), (1, 3, [None, 1.0], ["a", "b"])]
    m = frame(spark, rows, "e int, seq int, v array<double>, names array<string>")
    r = audit.payload_faults(m, ["e"], "seq", "v", "names").first()
    assert (r.n_non_finite, r.n_name_change) == (2, 1)


@pytest.mark.parametrize("skews, reason, warning", [([0, 0, 0], None, None), ([0, 41, 0], "wrist_camera_skew_exceeded", None), ([25, 25, 0, 0], "wrist_camera_skew_exceeded", None), ([-25] + [0] * 300, None, "wrist_camera_skew_warning")])
def test_skew_gate(spark, skews, reason, warning):
    m = frame(spark, [(1, i, s) for i, s in enumerate(skews)], "e int, i int, s long")
    r = audit.skew_gate(m, ["e"], ["i"], "s", 20, 40, 1, 0.005).first()
    assert (r.reason, r.warning) == (reason, warning)


def test_age_gate_order(spark):
    m = frame(spark, [(1, None), (1, 99), (2, -1), (2, 99), (3, 99), (4, 1)], "e int, age long")
    got = {r.e: r.reason for r in audit.age_gate(m, ["e"], F.col("age"), 50).collect()}
    assert got == {1: "action_missing_history", 2: "future_action_violation", 3: "action_age_exceeded", 4: None}


def test_age_gate_without_any_source(spark):
    m = frame(spark, [(1, None), (1, None), (2, None), (2, 99)], "e int, age long")
    got = {r.e: (r.n_missing, r.n_future, r.n_old, r.reason) for r in audit.age_gate(m, ["e"], F.col("age"), 50).collect()}
    assert got == {1: (2, None, None, "action_missing_history"), 2: (1, 0, 1, "action_missing_history")}


def test_aligned_checks(spark):
    good = [(1, i, float(np.float32(i) / np.float32(30)), [0.0], [0.0], 1, "i") for i in range(3)]
    bad = [(2, 0, 0.5, [0.0], [float("inf")], -1, None)]
    f = frame(spark, good + bad, "e int, frame_index long, timestamp double, state array<double>, action array<double>, age long, img string")
    got = {r.e: r.reasons for r in audit.aligned_checks(f, ["e"], 30.0, "img").collect()}
    assert got == {1: [], 2: ["frame_count_mismatch", "future_action_violation", "non_finite_payload", "output_timestamp_mismatch"]}


def test_filter_computes_the_responses_of_a_section_once():
    """Forwards and backwards share them."""
    signal.section_responses.cache_clear()
    signal.zero_phase(signal.butterworth(4, 5.0, 200.0), np.arange(40.0)[:, None])
    assert signal.section_responses.cache_info()[:2] == (2, 2)


def test_filter_keeps_low_and_drops_high():
    t = np.arange(0, 4, 1 / 200)
    x = np.sin(2 * np.pi * 5 * t) + np.sin(2 * np.pi * 30 * t)
    y = signal.low_pass(t, x[:, None], 10, 4)[:, 0]
    mid = slice(200, -200)
    amp = lambda f: 2 * abs(np.mean(y[mid] * np.exp(-2j * np.pi * f * t[mid])))
    assert amp(5) > 0.9 and amp(30) < 0.1
    pulse = np.zeros(801)
    pulse[400] = 1
    assert signal.low_pass(np.arange(801) / 200, pulse[:, None], 10, 4)[:, 0].argmax() == 400
    low, high = signal.retention(t, x[:, None], y[:, None])
    assert 0.9 < low < 1.1 and high < 0.01
    for bad in (t[:3], np.array([0, 1, 1, 2.0])):
        with pytest.raises(ValueError):
            signal.low_pass(bad, np.zeros((len(bad), 1)), 10, 4)
    with pytest.raises(ValueError):
        signal.butterworth(4, 100, 200)


def test_filter_reports_what_it_cannot_do(spark):
    df = frame(spark, [(1, i, [float(i)]) for i in range(3)] + [(2, i, [1.0]) for i in range(200)], "e int, t long, v array<double>")
    got = {r.e: r.filter_error for r in signal.filtered(df, ["e"], "t", "v", 200.0).collect()}
    assert got[2] is None and "four samples" in got[1]


def plain_retention(t, before, after, low, high):
    """By sums of cosines, window by window."""
    step = np.median(np.diff(t))
    grid = np.arange(0, t[-1] - t[0] + np.diff(t).mean() / 2, step)
    size = min(512, len(grid))
    k = np.arange(size)
    f = np.arange(size // 2 + 1) / (size * step)
    shares = []
    for v in (before, after):
        speed, total = np.gradient(np.interp(grid, t - t[0], v), step), 0
        for i in range(0, len(grid) - size + 1, size - size // 2):
            part = speed[i : i + size] - np.polyval(np.polyfit(k, speed[i : i + size], 1), k)
            part = part * np.sin(np.pi * k / size) ** 2
            total = total + np.array([abs((part * np.exp(-2j * np.pi * j * k / size)).sum()) ** 2 * (1 if 2 * j in (0, size) else 2) for j in range(len(f))])
        shares.append([np.trapezoid(total[m], f[m]) for m in ((f >= low[0]) & (f <= low[1]), f >= high)])
    return [b / a if a else None for a, b in zip(*shares)]


def test_filter_report_follows_the_cutoff(spark):
    """Series of days and of hundredths of a second, irregular, long and short, and some without a spectrum."""
    rng = np.random.default_rng(3)
    for unit, cutoff in ((100_000.0, 1e-6), (0.01, 10.0)):
        times = {k: np.cumsum(rng.integers(500_000, 1_500_000, n)) for k, n in ((1, 60), (2, 7), (3, 1100), (4, 3), (7, 25))}
        times |= {None: times[1], 5: np.array([0, 10, 10, 20, 30]), 6: 20 * times[1]}
        rows = [(k, int(t), [float(x)]) for k, own in times.items() for t, x in zip(own, rng.normal(size=len(own)))]
        both = signal.filtered(frame(spark, rows, "e int, t long, v array<double>"), ["e"], "t", "v", 1e6 / unit, cutoff, into="w")
        own = {k: sorted((r.t, r.v[0], r.w[0]) for r in both.collect() if r.e == k) for k in times}
        assert [(t, v) for t, v, _ in own[1]] == [(t, v[0]) for e, t, v in rows if e == 1]
        got = {r.e: r for r in signal.filter_report(both, ["e"], "t", "v", "w", 1e6 / unit, cutoff).collect()}
        assert set(got) == set(times)
        for k in (1, 2, 3, 7, None):
            t, v, w = np.array(own[k]).T
            low, high = plain_retention(t * unit / 1e6, v, w, (cutoff / 20, cutoff), 1.5 * cutoff)
            assert (got[k].low_retention, got[k].high_retention) == (low and pytest.approx(low), pytest.approx(high)) and got[k].filter_error is None
            assert high < 0.1 and (low > 0.1 if k != 2 else low is None)  # 2 has no two frequencies up to the cutoff
        assert (got[4].low_retention, got[4].high_retention) == (got[5].low_retention, got[5].high_retention) == (None, None)
        assert "four samples" in got[4].filter_error and "increase" in got[5].filter_error
        assert (got[6].low_retention, got[6].high_retention) == (1.0, None) and "cutoff" in got[6].filter_error


def test_lag_is_recovered(spark):
    rng = np.random.default_rng(7)
    t = np.arange(0, 8, 1 / 200)
    a = np.repeat(rng.normal(size=41), 40)[: len(t)]
    a = np.convolve(a, np.ones(8) / 8, "same")
    s = np.concatenate([np.full(16, a[0]), a[:-16]])
    rows = [(1, int(x * 1e9), [float(p), 1.0], [float(q), 1.0]) for x, p, q in zip(t, a, s)]
    both = frame(spark, rows, "e int, t long, a array<double>, s array<double>")
    out = lags.lag_audit(both.select("e", "t", F.col("a").alias("v")), both.select("e", "t", F.col("s").alias("v")), ["e"])
    got = {r.axis: r for r in out.collect()}
    assert abs(got[0].lag - 0.08) < 0.005 and got[1].reason == "insufficient_excitation"
    c = lags.consensus(out, ["e"]).first()
    assert abs(c.lag - 0.08) < 0.005 and c.active_axes == 1


def plain_sections(sections, x, steady=None):
    """Sample by sample."""
    y, level = x.astype(float), steady
    for b0, b1, b2, _, a1, a2 in sections:
        gain = (b0 + b1 + b2) / (1 + a1 + a2)
        z2 = (b2 - a2 * gain) * level if level is not None else np.zeros(y.shape[1:])
        z1 = (b1 - a1 * gain) * level + z2 if level is not None else np.zeros(y.shape[1:])
        out = np.empty_like(y)
        for i in range(len(y)):
            out[i] = b0 * y[i] + z1
            z1, z2 = b1 * y[i] - a1 * out[i] + z2, b2 * y[i] - a2 * out[i]
        y = out
        level = gain * level if level is not None else None
    return y


@pytest.mark.parametrize("n", [1, 5, 127, 128, 129, 700])
def test_blocked_sections_equal_a_plain_loop(n):
    x = np.random.default_rng(n).normal(size=(n, 3))
    for order in (2, 4):
        sections = signal.butterworth(order, 10.0, 200.0)
        assert np.allclose(signal.run_sections(sections, x), plain_sections(sections, x), atol=1e-10)
        assert np.allclose(signal.run_sections(sections, x, x[0]), plain_sections(sections, x, x[0]), atol=1e-10)


def test_lag_audit_against_a_plain_version(spark):
    """Series on their own times, one without overlap, one that hardly moves; windows inside the audit."""
    rng = np.random.default_rng(11)
    rules = lags.LagRules(max_lag=0.2, rate=100.0, excitation=1e-3, window=1.0)
    ta, ts = np.sort(rng.uniform(0, 4, 300)), np.sort(rng.uniform(0.3, 4.4, 400))
    wave = lambda t: np.sin(5 * t) + 0.4 * np.sin(17 * t)
    actions = [(1, int(t * 1e9), [float(wave(t)), 1.0]) for t in ta] + [(2, int(t * 1e9), [float(t)]) for t in ta]
    states = [(1, int(t * 1e9), [float(wave(t - 0.07)), 2.0]) for t in ts] + [(2, int(9e9 + t * 1e9), [float(t)]) for t in ts] + [(3, 5, [1.0])]
    schema = "e int, t long, v array<double>"
    got = {(r.e, r.axis): r for r in lags.lag_audit(frame(spark, actions, schema), frame(spark, states, schema), ["e"], rules=rules).collect()}
    assert got[2, 0].reason == got[3, 0].reason == "insufficient_overlap" and got[1, 1].reason == "insufficient_excitation"
    r = got[1, 0]
    at, st = (np.array([x[1] for x in rows if x[0] == 1]) * 1e-9 for rows in (actions, states))
    origin = min(at[0], st[0])
    at, st = at - origin, st - origin
    grid = np.arange(max(at[0], st[0]), min(at[-1], st[-1]), 0.01)
    a = np.array([wave(ta)[np.flatnonzero(at <= g)[-1]] for g in grid])
    s = np.interp(grid, st, wave(ts - 0.07))
    va, vs = np.gradient(a, 0.01), np.gradient(s, 0.01)
    scores = [np.corrcoef(va[: len(va) - k], vs[k:])[0, 1] for k in range(21)]
    k = int(np.argmax(scores))
    assert abs(r.lag - k / 100) < 1e-12 and abs(r.lag - 0.07) <= 0.02 and r.reason is None
    assert np.allclose([r.corr, r.margin], [scores[k], scores[k] - sorted(scores)[-2]], atol=1e-6)
    err = np.abs(a[: len(a) - k] - s[k:])
    assert np.allclose([r.error_mean, r.error_p95, r.error_max, r.duration], [err.mean(), np.percentile(err, 95), err.max(), len(err) / 100], atol=1e-6)
    own, mid = [], []
    for i in range(0, len(va) - 100 + 1, 50):
        own.append(int(np.argmax([np.corrcoef(va[i : i + 100 - j], vs[i + j : i + 100])[0, 1] for j in range(21)])) / 100)
        mid.append((i + 50) / 100)
    assert np.allclose([r.window_median, r.window_range, r.window_trend], [np.median(own), np.ptp(own), np.polyfit(mid, own, 1)[0]], atol=1e-6)


def test_lag_pairs_cover_the_fixed_six(spark):
    names = [k for _, a, s, _ in lags.LAG_PAIRS for k in (a, s)]
    samples = frame(spark, [(1, k, t, [float(i) for i in range(7)]) for k in names for t in (0, 5, 10)], "episode int, stream string, t long, v array<double>")
    bounds = frame(spark, [(1, 5, 10)], "episode int, active_start long, active_stop long")
    actions, states = lags.paired(samples, bounds, ["episode"])
    rows = actions.collect() + states.collect()
    assert len(rows) == 24 and {r.pair for r in rows} == {p[0] for p in lags.LAG_PAIRS}
    assert all(len(r.v) == (3 if r.pair.startswith("eef") else 7) and r.t >= 5 for r in rows)


@pytest.mark.parametrize("alpha", [0.3, 0.001, 0.97, 1.0])
def test_ema_over_many_blocks(spark, alpha):
    x = np.random.default_rng(1).normal(size=1300)
    rows = [(k, i, float(v)) for k in (1, 2) for i, v in enumerate(x[: 1300 if k == 1 else 3])] + [(1, 5000, None)]
    got = {(r.k, r.t): r.ema for r in sequences.ema(frame(spark, rows, "k int, t int, v double"), ["k"], ["t"], "v", alpha).collect()}
    y, want = None, {}
    for i, v in enumerate(x):
        y = v if y is None else (1 - alpha) * y + alpha * v
        want[i] = y
    assert len(got) == 1303 and all(abs(got[k, t] - want[t]) < 1e-9 for k, t in got)


def test_nearest_ranks(spark):
    rows = [(1, v) for v in (5, 1, 4, 2, 3)] + [(2, 7), (1, None)]
    got = {r.k: (r.a, r.b, r.c) for r in statistics.nearest_ranks(frame(spark, rows, "k int, v int"), ["k"], "v", {"a": 0.0, "b": 0.4, "c": 1.0}).collect()}
    assert got == {1: (1, 3, 5), 2: (7, 7, 7)}


def test_time_buckets_change_nothing(spark):
    rng = np.random.default_rng(2)
    source = frame(spark, [(int(k), int(t), float(t % 17)) for k in (1, 2) for t in rng.choice(1000, 40, replace=False)], "k int, t long, v double")
    anchors = frame(spark, [(k, int(t)) for k in (1, 2, 3) for t in rng.choice(1200, 60, replace=False) - 100], "k int, t long")
    for f in (asof.nearest, asof.linear):
        rows = [sorted(map(str, f(anchors, source, ["k"], bucket=b).collect())) for b in (None, 50, 5000)]
        assert rows[0] == rows[1] == rows[2] and len(rows[0]) == 180


def test_grids_and_intervals_refuse_absurd_ranges(spark):
    with pytest.raises(Exception, match="steps"):
        asof.regular_grid(frame(spark, [(1, 0), (1, 1_700_000_000_000_000_000)], "k int, t long"), ["k"], step=1_000_000).count()


def test_state_dropout_and_episode_choice(spark):
    df = spark.range(2000).selectExpr("id episode_index", "array(1D, 2D) s")
    drop = lambda d: {r.episode_index: r.x for r in d.select("episode_index", shards.dropped_state("s", 0.25, 7, "episode_index").alias("x")).collect()}
    a = drop(df)
    assert a == drop(df.repartition(7)) and 0.2 < sum(v == [0, 0] for v in a.values()) / 2000 < 0.3
    assert [r.episode_index for r in etl.selected_episodes(df, [9, 4, 9, 7], 2).orderBy("episode_index").collect()] == [4, 7]
    with pytest.raises(Exception, match="no episode 5000"):
        etl.selected_episodes(df, [5, 5000]).count()


def test_format_changes(spark):
    rows = [(1, 0, 4, "a"), (1, 1, 4, "a"), (1, 2, 5, "a"), (1, 3, 4, None), (2, 0, 4, "a")]
    got = {r.k: (r.n_changed, r.first_changed) for r in audit.format_changes(frame(spark, rows, "k int, seq int, h int, f string"), ["k"], "seq", ["h", "f"]).collect()}
    assert got == {1: (2, 2), 2: (0, None)}


def test_statistics(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 3)).astype(np.float32)
    df = frame(spark, [(i, r.tolist()) for i, r in enumerate(x)], "i int, v array<float>")
    s = statistics.as_vectors(statistics.vector_stats(df, "v", exact=True)).first()
    assert np.allclose(s.mean, x.mean(0), atol=1e-5) and np.allclose(s.std, x.std(0), atol=1e-5)
    assert np.allclose(s.q01, np.quantile(x, 0.01, axis=0), atol=1e-5) and np.allclose(s.max, x.max(0))
    m = frame(spark, [("a", 0, 1.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0), ("a", 0, 3.0, 2.0, 1.0, 0.0, 2.0, 0.0, 2.0), ("a", 0, 9.0, None, None, None, None, None, None)], "g string, dim int, w double, mean double, std double, min double, max double, q01 double, q99 double")
    r = statistics.merged_stats(m, "w", ["g", "dim"]).first()
    assert (r.mean, r.max, r.q99) == (1.5, 2, 2) and abs(r.std - math.sqrt(0.25 * 1 + 0.75 * 5 - 2.25)) < 1e-12


def test_shards(spark):
    e = frame(spark, [(0, 50), (1, 50), (None, 50), (3, 7), (4, 0), (5, None)], "e long, n long")
    opt = shards.ShardOptions(shard_size=64, sampling_rate=0.5, margin_start=2, margin_end=1, seed=1)
    plan = lambda rows, **more: sorted((tuple(r) for r in shards.balanced_shards(rows, "e", "n", 4, shards.ShardOptions(**(opt.__dict__ | more))).collect()), key=str)
    own = plan(e)
    steps = [(k, s) for _, k, s in own]
    assert sorted(steps, key=str) == sorted([(k, s) for k in (0, 1, None) for s in range(2, 46)] + [(3, 2)], key=str)
    sizes = collections.Counter(s for s, _, _ in own)
    assert sorted(sizes) == [0, 1, 2] and max(sizes.values()) - min(sizes.values()) <= 22
    assert plan(e.repartition(7)) == own and plan(e, seed=2) != own
    assert plan(e.where("n < 5")) == []
    with pytest.raises(ValueError):
        plan(e, shard_size=2)
    e = frame(spark, [(0, 50)], "e int, n long")
    assert shards.step_windows(e, ["e"], "n", 8).count() == 43
    got = sorted(r.step for r in shards.step_windows(e, ["e"], "n", 8, 5, 3).collect())
    assert got == list(range(5, 40))


def test_shards_of_a_long_episode(spark):
    """One episode holds nearly all steps: its shards stay even, and a part mixes its whole length."""
    e = frame(spark, [(0, 1_000_000)] + [(k, 40) for k in range(1, 50)], "e long, n long")
    out = shards.balanced_shards(e, "e", "n", 1, shards.ShardOptions(shard_size=100_000))
    sizes = [r["count"] for r in out.groupBy("shard_id").count().collect()]
    assert len(sizes) == 11 and max(sizes) - min(sizes) <= 100_000 and out.distinct().count() == 1_000_000 + 49 * 40
    assert "rangepartitioning" not in out._jdf.queryExecution().executedPlan().toString()
    cells = out.where("e = 0").groupBy("shard_id", F.floor(F.col("step") / 100_000)).count().collect()
    assert len(cells) == 100 and all(abs(r["count"] - 10_000) < 600 for r in cells)


def test_permuted_is_one_to_one(spark):
    for n in (1, 2, 3, 10, 997):
        rows = spark.range(n).selectExpr("id", f"{n}L AS n", "123456789L AS key", "'x' AS `a.b`")
        got = [r.at for r in shards.permuted(rows, "id", "n", "key", "at").orderBy("id").collect()]
        assert sorted(got) == list(range(n)) and (n < 10 or got != list(range(n)))


def test_mixture_schedule(spark):
    own = frame(spark, [("a", s, 10) for s in (3, 5, 9)] + [("b", s, 20) for s in (0, 1)] + [("none", 0, 0), ("off", 0, 5)], "dataset string, shard_id long, size long")
    weights = frame(spark, [("a", 0.5), ("b", 0.5), ("none", 1.0), ("off", 0.0), ("unknown", 1.0)], "dataset string, weight double")
    rows = lambda *a, **k: sorted(tuple(r) for r in shards.mixture_schedule(own, weights, *a, **k).collect())
    whole = rows(3000, 1)
    assert [r[0] for r in whole] == list(range(3000)) and {r[1] for r in whole} == {"a", "b"}
    assert abs(sum(d == "a" for _, d, _ in whole) - 2000) < 150  # shares 2 to 1, as b's shards are twice as large
    for d, n in (("a", 3), ("b", 2)):
        mine = [s for _, k, s in whole if k == d]
        rounds = [tuple(mine[i : i + n]) for i in range(0, len(mine) - n + 1, n)]
        assert all(len(set(r)) == n for r in rounds) and len(set(rounds)) == (6 if n == 3 else 2)
    assert rows(700, 1, first=1100) == whole[1100:1800]
    assert rows(3000, 1, epoch=1) != whole and rows(0, 1) == []
    assert [tuple(r) for r in shards.every_shard(own).orderBy("position").collect()][:3] == [(0, "a", 3), (1, "a", 5), (2, "a", 9)]
    with pytest.raises(ValueError):
        shards.mixture_schedule(own.where("size = 0"), weights, 5, 1)


def test_merge(spark):
    def dataset(task, lengths):
        frames = [(e, i, 0, 0, [float(e), float(i)]) for e, n in enumerate(lengths) for i in range(n)]
        return {
            "frames": frame(spark, frames, "episode_index long, frame_index long, index long, task_index long, state array<double>"),
            "episodes": frame(spark, [(e, n) for e, n in enumerate(lengths)], "episode_index long, length long"),
            "tasks": frame(spark, [(0, task)], "task_index long, task string"),
        }

    out = etl.merged([dataset("grasp the mango", [2, 3]), dataset("grasp the rugby ball", [4])])
    rows = sorted(out["frames"].collect(), key=lambda r: r["index"])
    assert [r["index"] for r in rows] == list(range(9)) and out["episodes"].count() == 3 and out["tasks"].count() == 2
    assert [(r.episode_index, r.task_index, r["index"]) for r in rows[5:]] == [(2, 1, i) for i in range(5, 9)]
    a = {"codebase_version": "v2.1", "features": {"v": {"info": {"video.fps": 30}}}}
    b = {"codebase_version": "v2.1", "features": {"v": {"info": {"video.fps": 31}}}}
    assert etl.incompatible(a, b) == [] and etl.incompatible(a, {**b, "chunks_size": 5}) == ["chunks_size"]


def test_texts_of_subtasks(spark):
    f = frame(spark, [(0, i) for i in range(6)], "episode_index long, frame_index long")
    i = frame(spark, [(0, 3, 5, "grasp")], "episode_index long, start long, stop long, text string")
    got = {r.frame_index: r.text for r in etl.subtask_text(f, i, 4, 1).collect()}
    assert got == {0: "", 1: "grasp", 2: "grasp", 3: "grasp", 4: "grasp", 5: ""}


def test_consolidated_layout(spark):
    m = frame(spark, [(0, 0, 3, 1.0, [1.0], "x")], "episode_index long, dataset_from_index long, dataset_to_index long, `data/chunk` double, `stats/action/mean` array<double>, tasks string")
    assert etl.consolidated_episodes(m).first().length == 3 and "data/chunk" not in etl.consolidated_episodes(m).columns
    assert [tuple(r) for r in etl.unflattened_stats(m).collect()] == [(0, "action", "mean", [1.0])]


def test_numbers_and_sums_by_ranges(spark):
    """Equal to a window over all rows, with no single-partition exchange in the plan."""
    rows = [(i * 7919 % 5003, i % 13 if i % 17 else None, i % 3) for i in range(5003)]
    df = frame(spark, rows, "k long, v long, g int").repartition(5)
    out = ordering.numbered(df, [F.desc("k")], "n", {"before": "v"}, ranges=7)
    want, total = {}, 0
    for n, (k, v, _) in enumerate(sorted(rows, reverse=True)):
        want[k] = (n, total)
        total += v or 0
    assert {r.k: (r.n, r.before) for r in out.collect()} == want
    assert "SinglePartition" not in out._jdf.queryExecution().executedPlan().toString()
    assert ordering.numbered(df.where("false"), ["k"]).count() == 0


def test_group_numbers_and_quantiles_with_one_large_group(spark):
    rng = np.random.default_rng(3)
    rows = [(1, float(x)) for x in rng.integers(0, 50, 4000)] + [(2, 3.0), (3, None), (None, 5.0), (None, 7.0)]
    df = frame(spark, rows, "k int, v double").repartition(4)
    got = {r.k: r.q for r in ordering.group_quantile(df, ["k"], "v", 0.95, "q").collect()}
    assert got == {1: np.percentile([v for k, v in rows if k == 1], 95), 2: 3.0, None: pytest.approx(6.9)}
    numbers = ordering.group_numbers(df.where("k = 1").withColumn("id", F.monotonically_increasing_id()), ["k"], ["v", "id"])
    assert sorted(r.number for r in numbers.collect()) == list(range(4000)) and numbers.first()["size"] == 4000


def test_lag_blocks_say_the_same_at_any_size(spark, monkeypatch):
    rng = np.random.default_rng(5)
    t = np.arange(0, 6, 0.01)
    a = np.cumsum(rng.normal(size=len(t)))
    rows = [(k, int(x * 1e9), [float(p)], [float(q)]) for k in (1, 2) for x, p, q in zip(t, a, np.concatenate([a[:1].repeat(9), a[:-9]]))]
    both = frame(spark, rows, "e int, t long, a array<double>, s array<double>")
    rules = lags.LagRules(max_lag=0.2, rate=100.0, window=0.5)
    run = lambda: sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in lags.lag_audit(both.select("e", "t", F.col("a").alias("v")), both.select("e", "t", F.col("s").alias("v")), ["e"], rules=rules).collect())
    whole = run()
    monkeypatch.setattr(lags, "BLOCK_POINTS", 50)
    assert run() == whole and whole[0][2] == 0.09


def test_time_buckets_change_no_row(spark):
    """Angles, signs, runs, averages and numbers of one large key, some of null keys and empty values."""
    n = 20_000
    df = spark.range(n).select(F.when(F.col("id") % 50 == 7, None).otherwise(F.lit(1)).alias("k"), (F.col("id") * 3).alias("t"), F.pmod(F.hash("id"), F.lit(6283)).cast("double").alias("x"))
    df = df.withColumn("a", F.when(F.col("t") % 41 == 0, None).otherwise(F.col("x") / 1000 - 3.1)).withColumn("q", F.array(F.cos("x"), F.sin("x"), F.lit(0.1), F.lit(0.2))).drop("x")
    forms = {
        "unwrapped": lambda b: sequences.unwrapped(df, ["k"], ["t"], "a", "out", bucket=b),
        "signs": lambda b: sequences.sign_continuous(df, ["k"], ["t"], "q", "out", bucket=b).withColumn("out", F.col("out")[0]),
        "runs": lambda b: sequences.run_ids(df, ["k"], ["t"], F.col("a") > 3, "out", bucket=b),
        "ema": lambda b: sequences.ema(df, ["k"], ["t"], "a", 0.2, "out", bucket=b),
        "before": lambda b: scans.previous(df, ["k"], ["t"], "a", "out", bucket=b),
    }
    for name, form in forms.items():
        whole, cut = (form(b).select("t", F.round("out", 6).alias("out")) for b in (None, 1000))
        assert whole.exceptAll(cut).isEmpty() and cut.exceptAll(whole).isEmpty(), name
