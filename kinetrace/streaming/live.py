"""Streaming forms of the stateful operators; each gives the rows of its batch form.

All state is keyed, bounded, and kept by Structured Streaming's checkpoints.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

AUDIT = "episode long, stream string, n long, first_t long, last_t long, n_zero long, n_duplicate long, n_backward long, n_large_gap long"
AUDIT_STATE = "n long, first_t long, last_t long, prev long, n_zero long, n_duplicate long, n_backward long, n_large_gap long"


def _timeout(idle_ms: int | None) -> str:
    return GroupStateTimeout.ProcessingTimeTimeout if idle_ms else GroupStateTimeout.NoTimeout


def _gone(state: GroupState) -> bool:
    """Whether a key was idle for too long, in which case its state is removed."""
    if state.hasTimedOut:
        state.remove()
        return True
    return False


def running_audit(messages: DataFrame, max_gap: int, idle_ms: int | None = None) -> DataFrame:
    """Counts per (episode, stream) after each batch, of messages (episode, stream, seq, t) that come in
    arrival order from batch to batch. A stream without a message for idle_ms ends and its state goes.
    Output mode: update."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if _gone(state):
            return
        n, first, last, prev, zero, dup, back, gap = state.get if state.exists else (0, None, None, None, 0, 0, 0, 0)
        parts = [(b["seq"].to_numpy(), b["t"].to_numpy(np.int64)) for b in batches]
        seq, t = parts[0] if len(parts) == 1 else (np.concatenate(c) for c in zip(*parts))
        t = t[np.argsort(seq, kind="stable")]
        dt = np.diff(t if prev is None else np.concatenate([[prev], t]))
        n, zero = n + len(t), zero + int((t == 0).sum())
        dup, back, gap = dup + int((dt == 0).sum()), back + int((dt < 0).sum()), gap + int((dt > max_gap).sum())
        first = int(t.min()) if first is None else min(first, int(t.min()))
        last = int(t.max()) if last is None else max(last, int(t.max()))
        state.update((n, first, last, int(t[-1]), zero, dup, back, gap))
        if idle_ms:
            state.setTimeoutDuration(idle_ms)
        yield pd.DataFrame([(*key, n, first, last, zero, dup, back, gap)], columns=[c.split()[0] for c in AUDIT.split(", ")])

    return messages.groupBy("episode", "stream").applyInPandasWithState(step, AUDIT, AUDIT_STATE, "update", _timeout(idle_ms))


def ema_values(x: np.ndarray, alpha: float, y: float | None) -> np.ndarray:
    """y = (1 - alpha) y + alpha x over x, from y on, or from the first value; a block at a time."""
    rest = 1.0 - alpha
    if not len(x) or rest == 0:
        return x.astype(float)
    size = max(1, min(512, int(600 / -math.log(rest))))
    out = np.empty(len(x))
    for i in range(0, len(x), size):
        part = x[i : i + size].astype(float)
        k = np.arange(len(part))
        weight = np.full(len(part), alpha)
        if y is None:
            weight[0], y = 1.0, 0.0
        out[i : i + size] = rest**k * np.cumsum(part * weight * (1 / rest) ** k) + rest ** (k + 1) * y
        y = float(out[i + len(part) - 1])
    return out


def running_ema(samples: DataFrame, alpha: float, idle_ms: int | None = None) -> DataFrame:
    """(episode, t, ema) of samples (episode, t, value) in time order from batch to batch; an episode idle
    for idle_ms starts anew. Output mode: append."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if _gone(state):
            return
        rows = pd.concat(list(batches)).sort_values("t", kind="stable")
        out = ema_values(rows["value"].to_numpy(float), alpha, state.get[0] if state.exists else None)
        state.update((float(out[-1]),))
        if idle_ms:
            state.setTimeoutDuration(idle_ms)
        yield pd.DataFrame({"episode": key[0], "t": rows["t"].to_numpy(), "ema": out})

    return samples.groupBy("episode").applyInPandasWithState(step, "episode long, t long, ema double", "y double", "append", _timeout(idle_ms))


HOLD_STATE = "t long, value double, newest long, waiting_t array<long>, waiting_anchor array<boolean>, waiting_value array<double>"


def running_hold(rows: DataFrame, max_age: int, wait: int = 0, idle_ms: int | None = None) -> DataFrame:
    """Causal hold over one stream of anchors and commands (episode, t, kind, value): each anchor with
    the last command at or before it, unless older than max_age. Rows may come up to `wait` late: they
    are held back until newer ones have come, or the key is idle for idle_ms. Later ones are taken as
    they come. Output mode: append."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held_t, held_v, newest, *waiting = state.get if state.exists else (None, None, None, [], [], [])
        ended = state.hasTimedOut
        new = [] if ended else list(batches)
        t = np.concatenate([np.asarray(waiting[0], np.int64), *(b["t"].to_numpy(np.int64) for b in new)])
        anchor = np.concatenate([np.asarray(waiting[1], bool), *((b["kind"] == "anchor").to_numpy(bool) for b in new)])
        value = np.concatenate([np.asarray(waiting[2], float), *(b["value"].to_numpy(float) for b in new)])
        newest = max([newest or t.max(), t.max()]) if len(t) else newest
        order = np.lexsort((anchor, t))
        t, anchor, value = t[order], anchor[order], value[order]
        ready = len(t) if ended or not wait else int(np.searchsorted(t, newest - wait, "right"))
        rest = (t[ready:], anchor[ready:], value[ready:])
        t, anchor, value = t[:ready], anchor[:ready], value[:ready]
        at = np.maximum.accumulate(np.where(anchor, -1, np.arange(ready))) if ready else np.zeros(0, int)
        known_t = np.where(at >= 0, t[at], held_t if held_t is not None else 0) if ready else t
        known_v = np.where(at >= 0, value[at], held_v if held_v is not None else np.nan) if ready else value
        some = (at >= 0) | (held_t is not None)
        if ready and at[-1] >= 0:
            held_t, held_v = int(t[at[-1]]), float(value[at[-1]])
        if ended:
            state.remove()
        else:
            state.update((held_t, held_v, int(newest), rest[0].tolist(), rest[1].tolist(), rest[2].tolist()))
            if idle_ms:
                state.setTimeoutDuration(idle_ms)
        age = t - known_t
        out = pd.DataFrame({"episode": key[0], "t": t, "value": np.where(some & (age <= max_age), known_v, np.nan), "age": pd.array(np.where(some, age, 0), "Int64")})
        out.loc[~some, "age"] = pd.NA
        out["value"] = out["value"].astype(object).where(out["value"].notna(), None)
        yield out[anchor].astype({"value": "Float64"})

    return rows.groupBy("episode").applyInPandasWithState(step, "episode long, t long, value double, age long", HOLD_STATE, "append", _timeout(idle_ms))


def held_at(t: np.ndarray, anchor: np.ndarray, value: np.ndarray, held: tuple[int, float] | None) -> tuple[np.ndarray, np.ndarray, tuple[int, float] | None]:
    """For each row in order the time and value of the last command up to it, and the last one of all; the
    time is -1 where there is none. held is the last command before these rows."""
    past = (-1, math.nan) if held is None else held
    times, values = np.append(past[0], t), np.append(past[1], value)
    at = np.maximum.accumulate(np.append(0, np.where(anchor, 0, np.arange(1, len(t) + 1))))
    last = (int(times[at[-1]]), float(values[at[-1]]))
    return times[at[1:]], values[at[1:]], None if last[0] < 0 else last


class OrderedHold(StatefulProcessor):
    """State of `ordered_hold`: the last command given out, and the rows that the watermark hasn't passed."""

    def __init__(self, max_age: int, idle: int | None):
        self.max_age, self.idle = max_age, idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "t long, value double")
        self.waiting = handle.getListState("waiting", "t long, anchor boolean, value double")

    def wake(self, t: int) -> None:
        """Call back once the watermark, in milliseconds, has passed t."""
        self.handle.registerTimer(-(-t // 1000))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows))
        self.waiting.appendList([(int(t), bool(a), None if pd.isna(v) else float(v)) for t, a, v in zip(new["t"], new["anchor"], new["value"])])
        self.wake(int(new["t"].min()))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = sorted((tuple(r) for r in self.waiting.get()), key=lambda r: (r[0], r[1])) if self.waiting.exists() else []
        ready, rest = [r for r in waiting if r[0] <= passed], [r for r in waiting if r[0] > passed]
        held = tuple(self.held.get()) if self.held.exists() else None
        if ready:
            t, anchor = np.array([r[0] for r in ready], np.int64), np.array([r[1] for r in ready], bool)
            known, value, held = held_at(t, anchor, np.array([math.nan if r[2] is None else r[2] for r in ready]), held)
            if held is not None:
                self.held.update(held)
            if rest:
                self.waiting.put(rest)
            else:
                self.waiting.clear()
        if rest:
            self.wake(rest[0][0])
        if held is not None and self.idle is not None:
            if held[0] + self.idle < passed:
                self.held.clear()
            else:
                self.wake(held[0] + self.idle + 1000)
        if ready and anchor.any():
            out = pd.DataFrame({"episode": key[0], "t": t, "value": pd.array(value, "Float64"), "age": pd.array(t - known, "Int64")})
            gone = known < 0 if self.idle is None else (known < 0) | (t - known > self.idle)
            out.loc[gone, ["value", "age"]] = pd.NA
            out.loc[(t - known > self.max_age) | np.isnan(value), "value"] = pd.NA
            yield out[anchor]

    def close(self) -> None:
        pass


def ordered_hold(rows: DataFrame, max_age: int, delay: str, idle: int | None = None) -> DataFrame:
    """Causal hold over one stream of anchors and commands (episode, t in microseconds from 0, kind, value),
    which may come in any order within `delay`: an event-time timer gives each anchor out once the watermark
    has passed it, with the last command at or before it, unless older than max_age. Rows behind the
    watermark are dropped. With `idle`, a command counts no longer than that, and its state goes.
    Output mode: append; needs `rocksdb_state`."""
    timed = rows.select("episode", "t", (F.col("kind") == "anchor").alias("anchor"), F.col("value").cast("double").alias("value"), F.timestamp_micros("t").alias("ts"))
    return timed.withWatermark("ts", delay).groupBy("episode").transformWithStateInPandas(OrderedHold(max_age, idle), "episode long, t long, value double, age long", "Append", "EventTime")


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams started in here keep their state in RocksDB, which timers need."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def windowed_counts(events: DataFrame, ts: str, by: list[str], width: str, slide: str | None = None, late: str | None = None) -> DataFrame:
    """Counts and sums per tumbling or sliding window; events later than `late` are dropped."""
    df = events.withColumn(ts, F.col(ts).cast("timestamp"))
    if late:
        df = df.withWatermark(ts, late)
    window = F.window(ts, width, slide) if slide else F.window(ts, width)
    return df.groupBy(window.alias("window"), *by).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select("window.start", "window.end", *by, "n", "total")


def session_counts(events: DataFrame, ts: str, by: list[str], gap: str, late: str) -> DataFrame:
    df = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    return df.groupBy(F.session_window(ts, gap).alias("session"), *by).agg(F.count("*").alias("n")).select("session.start", "session.end", *by, "n")


def distinct_events(events: DataFrame, ts: str, keys: list[str], late: str) -> DataFrame:
    """Each key once within the watermark's delay."""
    return events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)
