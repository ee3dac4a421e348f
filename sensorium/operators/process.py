"""Keyed process functions: user code with state and event-time timers, on tables and on streams.

A :class:`KeyedProcess` sees each key's rows in (time, tie) order and its timers between them: a timer
at ``t`` fires before the first row whose millisecond time is after ``t``. On a table (``keyed_process``) time ends after the last
row and pending timers fire; on a stream (``keyed_process_stream``) rows and timers run as far as the watermark.

User code is sequential, so a key is one task, through which its rows stream in sorted order with bounded memory. A function
that forgets a key after ``horizon_ms`` without rows (no timer and no state is left then) can say so, and a
hot key is cut wherever it pauses that long: the cuts are found on first and last times per (key, time bucket).

A null key is a key of its own, rows that repeat are rows of their own, rows without a time are left out, an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import pickle
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from ..streaming import shards
from .folds import key_again, key_columns, run_bounds


class Context:
    """What user code sees of a key: ``key``, ``state`` (any picklable value; None at first), ``time_ms``, timers and ``emit``."""

    def __init__(self, key, state=None, timers: Sequence[int] = (), horizon_ms: int | None = None):
        self.key, self.state, self.timers, self.horizon_ms = key, state, list(timers), horizon_ms
        self.time_ms: int | None = None
        self.out: list[tuple] = []

    def register_timer(self, ms: int) -> None:
        """A timer at ``ms``; one already set for that time stays one."""
        if self.horizon_ms is not None and self.time_ms is not None and ms > self.time_ms + self.horizon_ms:
            raise ValueError("a timer lies beyond the horizon")
        at = bisect.bisect_left(self.timers, ms)
        if at == len(self.timers) or self.timers[at] != ms:
            self.timers.insert(at, int(ms))

    def delete_timer(self, ms: int) -> None:
        at = bisect.bisect_left(self.timers, ms)
        if at < len(self.timers) and self.timers[at] == ms:
            del self.timers[at]

    def emit(self, *values) -> None:
        self.out.append(values)


class KeyedProcess:
    """User code. ``inputs`` are the columns of a row, ``output`` the fields that ``emit`` takes (the key comes before them)."""

    inputs: Sequence[str] = ("value",)
    output: str = ""

    def on_row(self, ctx: Context, row: dict) -> None:
        """``row`` holds ``us`` (epoch microseconds), ``tie`` and the inputs."""
        raise NotImplementedError

    def on_timer(self, ctx: Context, ms: int) -> None:
        pass


def _fire(fn: KeyedProcess, ctx: Context, before_ms: int) -> None:
    while ctx.timers and ctx.timers[0] < before_ms:
        ctx.time_ms = ctx.timers.pop(0)
        fn.on_timer(ctx, ctx.time_ms)


def _finish(fn: KeyedProcess, ctx: Context) -> None:
    """The end of the input: pending timers fire in order; those they set fire only within a horizon."""
    if ctx.horizon_ms is not None:
        _fire(fn, ctx, (ctx.time_ms or 0) + ctx.horizon_ms + 1)
        if ctx.timers or ctx.state is not None:
            raise ValueError("state or a timer outlives the horizon")
        return
    for ms in list(ctx.timers):
        if ms in ctx.timers:
            ctx.delete_timer(ms)
            ctx.time_ms = ms
            fn.on_timer(ctx, ms)


def _feed(fn: KeyedProcess, ctx: Context, names: Sequence[str], columns: list[list]) -> None:
    for values in zip(*columns, strict=True):
        row = dict(zip(names, values, strict=True))
        ms = row["us"] // 1000
        _fire(fn, ctx, ms)
        ctx.time_ms = ms
        fn.on_row(ctx, row)


def _segments(rows: DataFrame, horizon_ms: int) -> DataFrame:
    """``rows`` with ``_segment``: rows of a key with no pause above the horizon between them share one."""
    # a pause above the horizon can't lie within a bucket as long as it
    rows = rows.withColumns({"_ms": F.floor(F.col("us") / F.lit(1000)).cast("long")}).withColumn("_bucket", F.floor(F.col("_ms") / F.lit(horizon_ms)).cast("long"))
    key = ["_k", "_null"]
    runs = rows.groupBy(*key, "_bucket").agg(F.min("_ms").alias("_lo"), F.max("_ms").alias("_hi"))
    order = Window.partitionBy(*key).orderBy("_bucket")
    before = F.lag("_hi").over(order)
    start = F.when(before.isNull() | (F.col("_lo") - before > horizon_ms), F.col("_lo"))
    runs = runs.withColumn("_start", start).select(*key, "_bucket", F.last("_start", ignorenulls=True).over(order).alias("_segment"))
    return rows.drop("_ms").join(runs, [*key, "_bucket"]).drop("_bucket")


def _make_run(fn: KeyedProcess, names: Sequence[str], schema: pa.Schema, horizon_ms: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, ctx = None, None
        done: list[tuple] = []

        def batch() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True))
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        def drain() -> None:
            done.extend((*open_[:2], *row) for row in ctx.out)
            ctx.out = []

        for b in batches:
            k, null, segment = (b.column(c).to_numpy(zero_copy_only=False) for c in ("_k", "_null", "_segment"))
            bounds = run_bounds(k, null, segment)
            for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                group = (k[lo], bool(null[lo]), int(segment[lo]))
                if group != open_:
                    if open_ is not None:
                        _finish(fn, ctx)
                        drain()
                    open_, ctx = group, Context(None if group[1] else group[0], horizon_ms=horizon_ms)
                _feed(fn, ctx, names, [b.column(n).slice(lo, hi - lo).to_pylist() for n in names])
                drain()
            if done:
                yield batch()
        if open_ is not None:
            _finish(fn, ctx)
            drain()
            if done:
                yield batch()

    return run


def keyed_process(df: DataFrame, fn: KeyedProcess, key: str, ts: str = "ts", tie: str = "event_id", horizon_ms: int | None = None) -> DataFrame:
    """``fn`` over a table: the key and the emitted fields. ``ctx.key`` is the key as text."""
    from pyspark.sql.pandas.types import to_arrow_schema

    rows = df.filter(F.col(ts).isNotNull()).select(*key_columns(F.col(key)), F.unix_micros(F.col(ts)).alias("us"), F.col(tie).alias("tie"), *fn.inputs)
    rows = _segments(rows, horizon_ms) if horizon_ms is not None else rows.withColumn("_segment", F.lit(0).cast("long"))
    out = T.StructType([T.StructField("_k", T.StringType()), T.StructField("_null", T.BooleanType()), *T.StructType.fromDDL(fn.output).fields])
    group = ["_k", "_null", "_segment"]
    done = rows.repartition(*group).sortWithinPartitions(*group, "us", "tie") \
        .mapInArrow(_make_run(fn, ["us", "tie", *fn.inputs], to_arrow_schema(out), horizon_ms), out)
    return done.select(key_again(df.schema[key].dataType).alias(key), *out.names[2:])


def _make_stream_run(fn: KeyedProcess, names: Sequence[str], out_names: Sequence[str]):
    def advance(k, null, buffered: list[tuple], packed: bytes | None, wm: int, out: list[tuple]):
        """One key up to the watermark: its emitted rows go to ``out``; returns what is kept of it, and when it is due again."""
        ctx = Context(None if null else k)
        if packed is not None:
            ctx.state, ctx.timers = pickle.loads(packed)
        buffered.sort(key=lambda r: r[:2])
        n = bisect.bisect_left(buffered, wm, key=lambda r: r[0] // 1000)
        _feed(fn, ctx, names, [list(c) for c in zip(*buffered[:n], strict=True)] or [[] for _ in names])
        _fire(fn, ctx, wm)
        rest = buffered[n:]
        out += [(k, null, *row) for row in ctx.out]
        if not (rest or ctx.timers or ctx.state is not None):
            return None
        due = [t for t in (rest[0][0] // 1000 if rest else None, ctx.timers[0] if ctx.timers else None) if t is not None]
        return rest, pickle.dumps((ctx.state, ctx.timers)), max(min(due), wm) if due else None

    def run(key, pdfs: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        import warnings
        warnings.filterwarnings("ignore", category=FutureWarning)  # a pandas notice raised inside PySpark's state serializer
        wm = state.getCurrentWatermarkMs()
        keys = shards.load(state) or {}  # key -> buffered rows, packed state and timers, when it is due
        fresh: dict[tuple, list[tuple]] = {}
        if not state.hasTimedOut:
            for pdf in pdfs:
                late = pdf["us"].to_numpy(np.int64) // 1000 < wm
                for k, null, gone, *r in zip(pdf["_k"].tolist(), pdf["_null"].tolist(), late.tolist(),
                                             *(pdf[n].astype(object).tolist() for n in names), strict=True):
                    rows = fresh.setdefault((k, null), [])
                    if not gone:
                        rows.append(tuple(None if v is None or v is pd.NA or v != v else v for v in r))
        woken = [*fresh, *(k for k, (_, _, due) in keys.items() if k not in fresh and due is not None and due < wm)]
        out: list[tuple] = []
        for k in woken:
            buffered, packed, _ = keys.pop(k, ([], None, None))
            kept = advance(*k, buffered + fresh.get(k, []), packed, wm, out)
            if kept is not None:
                keys[k] = kept
        if keys:
            shards.save(state, keys)
            due = [t for _, _, t in keys.values() if t is not None]
            if due:
                state.setTimeoutTimestamp(min(due))
        elif state.exists:
            state.remove()
        if out:
            yield pd.DataFrame(out, columns=["_k", "_null", *out_names])

    return run


def keyed_process_stream(rows: DataFrame, fn: KeyedProcess, key: str, ts: str = "ts", tie: str = "event_id") -> DataFrame:
    """``fn`` over a stream with a watermark on ``ts``: the rows and timers that a table gives, as far as the watermark.

    Late rows (before the watermark) are dropped; the others wait in the key's state until the watermark passes them. Keys share the
    state rows of ``streaming.shards``: a call advances the keys of one that have rows or whose timer is due.
    Timers fire once the watermark passes them. State and timers are the query's, checkpointed with it. A null or NaN input is None."""
    data = rows.select(*key_columns(F.col(key)), F.col(ts), F.unix_micros(F.col(ts)).alias("us"), F.col(tie).alias("tie"), *fn.inputs)
    names = ["us", "tie", *fn.inputs]
    fields = T.StructType.fromDDL(fn.output).fields
    out = T.StructType([T.StructField("_k", T.StringType()), T.StructField("_null", T.BooleanType()), *fields])
    done = shards.by_shard(data, "_k", "_null").applyInPandasWithState(
        _make_stream_run(fn, names, [f.name for f in fields]), out, shards.STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return done.select(key_again(rows.schema[key].dataType).alias(key), *[f.name for f in fields])


class Sessions(KeyedProcess):
    """Sessions: rows of a key that follow each other within ``gap_ms``; emitted once the gap has passed."""

    inputs = ("value",)
    output = "start_us long, end_us long, n long, total double"

    def __init__(self, gap_ms: int):
        self.gap_ms = gap_ms

    def on_row(self, ctx, row):
        start, last, n, total = ctx.state or (row["us"], None, 0, 0.0)
        if last is not None:
            ctx.delete_timer(last // 1000 + self.gap_ms)
        ctx.state = (start, row["us"], n + 1, total + (row["value"] or 0.0))
        ctx.register_timer(row["us"] // 1000 + self.gap_ms)

    def on_timer(self, ctx, ms):
        start, last, n, total = ctx.state
        ctx.emit(start, last, n, total)
        ctx.state = None
