"""Event-time sort per sensor, value correction and moving average in one
stateful streaming operator (``applyInPandasWithState``).

Per sensor the state buffers rows not yet released. A row is dropped as
late when its millisecond time is before the current watermark; buffered
rows are released in (time, arrival) order once their millisecond time is
before the watermark, which equals the reference's ``t <= watermark`` for
its watermark one millisecond lower. Released rows get their position in
the sensor's sequence and the moving average (first row only seeds it).
An event-time timeout wakes a sensor without new rows: at the row's own
time (``round_to_ms = None``) or at the end of its ``round_to_ms`` bucket
(coalesced timers). Sensors share the state rows of ``shards``, and a call
works on all sensors of one at once, each as if it had a state row and a
timeout of its own. Sort, correction and average share one operator, so
the stream is shuffled once, by sensor.

State lives in the stream's state store, checkpointed with the query;
nothing is lost when an executor is.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from ..functions.correct import apply_corrections
from ..functions.decode import decode_measurements
from ..operators.ordered import MovingAverage
from ..schema import OUT_OF_ORDERNESS_MS, ROUND_TIMER_TO_MS
from . import shards
from .shards import timeout_ms as _timeout_ms  # noqa: F401
from .windows import with_event_time

# Python works on epoch micros (``ts_us``), never on session-zone datetimes.
OUTPUT = T.StructType([
    T.StructField("sensor_id", T.IntegerType()),
    T.StructField("event_id", T.LongType()),
    T.StructField("ts_us", T.LongType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("pos", T.LongType()),
    T.StructField("ema", T.DoubleType()),
])

def release_ms(ts: str = "ts", round_to_ms: int | None = ROUND_TIMER_TO_MS) -> Column:
    """The timer of a row in epoch ms: its own time, or the end of its ``round_to_ms`` bucket (always after the row). The
    sort releases the row once the watermark passes its time and this timer, or new rows of its sensor come."""
    ms = F.unix_millis(F.col(ts))
    return ms if not round_to_ms else ms - F.pmod(ms, F.lit(round_to_ms)) + F.lit(round_to_ms)


def _late(us: np.ndarray, wm: int) -> np.ndarray:
    """Rows whose millisecond time is before the watermark."""
    return us // 1000 < wm


class _Released:
    """A sensor's buffered rows split at the watermark: ``frame`` holds those released (None if there are none),
    ``rest`` the others, ``progress`` the average, whether there is one, and the position after them."""

    def __init__(self, kernel: MovingAverage, sensor: int, rows: tuple[np.ndarray, np.ndarray, np.ndarray], wm: int, progress):
        us, tie, val = rows
        order = np.lexsort((tie, us))
        us, tie, val = us[order], tie[order], val[order]
        avg, seen, seq = progress
        n = int(np.searchsorted(us // 1000, wm, side="left"))
        self.rest, self.progress, self.frame = (us[n:], tie[n:], val[n:]), progress, None
        if n:
            states, outs = kernel.fold({"value": val[:n]}, np.array([0]), avg if seen else None, n)
            self.frame = pd.DataFrame({
                "sensor_id": np.full(n, sensor, dtype=np.int32),
                "event_id": tie[:n],
                "ts_us": us[:n],
                "value": val[:n],
                "pos": np.arange(seq + 1, seq + 1 + n, dtype=np.int64),
                "ema": pd.arrays.FloatingArray(np.asarray(states, dtype=np.float64), mask=~outs["_emit"]),
            })
            self.progress = (float(states[-1]), True, int(seq + n))


def make_sort_ema(round_to_ms: int | None = ROUND_TIMER_TO_MS, alpha: float = 0.5):
    kernel = MovingAverage("value", alpha)

    def sort_ema(key, pdfs, state):
        import warnings
        # pandas notice raised inside PySpark's state serializer, per batch
        warnings.filterwarnings("ignore", category=FutureWarning)
        wm = state.getCurrentWatermarkMs()
        # buffered rows; sensors seen, each with its average and position
        held, (known, avg, seq) = shards.load(state) or ((np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)),
                                                         (np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)))
        parts = [held]
        if not state.hasTimedOut:
            parts += [tuple(pdf[c].to_numpy(k) for c, k in (("sensor_id", np.int64), ("ts_us", np.int64), ("event_id", np.int64), ("value", np.float64)))
                      for pdf in pdfs]
        rows = [np.concatenate(c) for c in zip(*parts, strict=True)]
        split = shards.Split([rows[0]], rows[1], rows[2], np.arange(len(rows[0])) >= len(held[0]), wm, round_to_ms)
        rows = [c[split.order] for c in rows]
        sensor, us, tie, val = (c[split.released] for c in rows)
        n = len(sensor)
        if n:
            starts = shards.run_starts([sensor])
            ends = np.append(starts[1:], n)
            known, at = np.unique(np.concatenate([known, sensor[starts]]), return_inverse=True)
            new_avg, new_seq = np.zeros(len(known)), np.zeros(len(known), np.int64)
            new_avg[at[:len(avg)]], new_seq[at[:len(seq)]] = avg, seq
            avg, seq, at = new_avg, new_seq, at[len(at) - len(starts):]
            states, outs = kernel.fold_runs({"value": val}, starts, avg[at], seq[at] > 0, n)
            yield pd.DataFrame({
                "sensor_id": sensor.astype(np.int32),
                "event_id": tie,
                "ts_us": us,
                "value": val,
                "pos": np.repeat(seq[at] - starts, ends - starts) + np.arange(1, n + 1, dtype=np.int64),
                "ema": pd.arrays.FloatingArray(np.asarray(states, dtype=np.float64), mask=~outs["_emit"]),
            })
            avg[at] = states[ends - 1]
            seq[at] += ends - starts
        shards.save(state, (tuple(c[split.rest] for c in rows), (known, avg, seq)))
        if split.next is not None:
            state.setTimeoutTimestamp(split.next)

    return sort_ema


class SortEmaProcessor(StatefulProcessor):
    """The same operator on ``transformWithStateInPandas``: list state for
    the buffered rows, value state for the average, one event-time timer per
    row (``round_to_ms = None``, fires once the watermark passes the row) or
    per ``round_to_ms`` bucket (coalesced). A key drained at a watermark skips
    the other timers firing at that watermark, so bursts cost O(buffer), not
    O(buffer x timers)."""

    def __init__(self, round_to_ms: int | None = ROUND_TIMER_TO_MS, alpha: float = 0.5):
        self.round_to_ms = round_to_ms
        self.alpha = alpha

    def init(self, handle) -> None:
        self.handle = handle
        self.kernel = MovingAverage("value", self.alpha)
        self.unreleased = handle.getListState("unreleased", "ts_us long, tie long, value double")
        self.released = handle.getValueState("released", "avg double, seen boolean, seq long, drained long")

    def _timer(self, ts_ms: int) -> int:
        # a Spark event-time timer t fires once watermark >= t
        if not self.round_to_ms:
            return ts_ms + 1
        return ts_ms // self.round_to_ms * self.round_to_ms + self.round_to_ms

    def handleInputRows(self, key, rows, timerValues):
        wm = timerValues.getCurrentWatermarkInMs()
        kept, timers = [], set()
        for pdf in rows:
            us = pdf["ts_us"].to_numpy(np.int64)
            keep = ~_late(us, wm)
            us = us[keep]
            kept.extend(zip(us.tolist(), pdf["event_id"].to_numpy(np.int64)[keep].tolist(), pdf["value"].to_numpy(np.float64)[keep].tolist(), strict=True))
            timers.update(self._timer(int(t)) for t in np.unique(us // 1000).tolist())
        if kept:
            self.unreleased.appendList(kept)
            for t in sorted(timers):
                self.handle.registerTimer(t)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        wm = timerValues.getCurrentWatermarkInMs()
        *progress, drained = self.released.get() if self.released.exists() else (None, False, 0, None)
        if drained == wm:
            return iter([])
        held = list(self.unreleased.get()) if self.unreleased.exists() else []
        rows = tuple(np.array(c, k) for c, k in zip(zip(*held, strict=True), (np.int64, np.int64, np.float64), strict=True)) if held else \
            (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        out = _Released(self.kernel, int(key[0]), rows, wm, tuple(progress))
        if out.frame is not None:
            rest = list(zip(*(c.tolist() for c in out.rest), strict=True))
            if rest:
                self.unreleased.put(rest)
            else:
                self.unreleased.clear()
        self.released.update((*out.progress, wm))
        return iter([] if out.frame is None else [out.frame])

    def close(self) -> None:
        pass


def _state_api_ready(spark) -> bool:
    """transformWithState needs Unix-socket state access (else Python opens
    a loopback TCP port) and the RocksDB state store."""
    conf = spark.sparkContext.getConf()
    uds = conf.get("spark.python.unix.domain.socket.enabled", "false").lower() == "true"
    provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass", "")
    return uds and "RocksDB" in provider


def sort_correct_ema(raw: DataFrame, corrections=None, delay_ms: int = OUT_OF_ORDERNESS_MS,
                     round_to_ms: int | None = ROUND_TIMER_TO_MS, alpha: float = 0.5,
                     engine: str = "group_state") -> DataFrame:
    """Raw record stream -> decoded -> corrected -> sorted per sensor -> EMA.

    Output rows: ``sensor_id, event_id, ts, value, pos, ema`` (``ema`` NULL
    on a sensor's first row). ``event_id`` is the record offset, the tie
    break for equal times. ``engine``: ``"group_state"``
    (``applyInPandasWithState``, one timeout per shard of sensors; works in
    any session), ``"state_api"`` (``transformWithStateInPandas``, list/value
    state and timers per row or bucket), or ``"auto"`` (the state API when
    the session is set up for it). Both release the same rows in the same
    order.
    """
    meas = decode_measurements(with_event_time(raw, delay_ms), keep=("offset",)) \
        .withColumnRenamed("offset", "event_id")
    if corrections:
        meas = apply_corrections(meas, corrections)
    # ``ts`` carries the watermark (required for event-time timeouts); the
    # function itself reads ``ts_us``
    rows = meas.select("sensor_id", "event_id", "ts", F.unix_micros("ts").alias("ts_us"), "value")
    use_state_api = engine == "state_api" or (engine == "auto" and _state_api_ready(raw.sparkSession))
    if use_state_api:
        out = rows.groupBy("sensor_id").transformWithStateInPandas(
            SortEmaProcessor(round_to_ms, alpha), OUTPUT, "append", "eventTime")
    else:
        out = shards.by_shard(rows, "sensor_id").applyInPandasWithState(
            make_sort_ema(round_to_ms, alpha), OUTPUT, shards.STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return out.select("sensor_id", "event_id", F.timestamp_micros("ts_us").alias("ts"), "value", "pos", "ema")


def run_available(df: DataFrame, sink: str, checkpoint: str, fmt: str = "parquet"):
    """Process everything available now, then stop; returns the query."""
    q = (df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start(sink))
    q.awaitTermination()
    return q
