"""User aggregates and user folds over event-time windows, without a window's rows ever being in one place.

An :class:`Accumulator` says how rows become a state, how states merge and what a state
results in. Windows are made of panes (``gcd(size, slide)``), so every row is added once, whatever the overlap:

* ``aggregate_windows`` (order doesn't matter): each task adds its rows to a state per (key, pane)
  before any shuffle, so a hot window costs a state per task.
* ``fold_windows`` (order matters): a range sort on (key, time, tie) spreads a hot key over tasks; each
  folds its runs of a pane in order, across Arrow batches, and emits a state per run.

Then states, not rows, are expanded to the windows of their pane, shuffled by (key, window), sorted by pane and task
and merged in order as they stream by.

A null key is a key of its own; rows without a time are in no window; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import DEFAULT_SLIDE_SECONDS, WINDOW_SIZE_SECONDS
from .windows import assign_windows

#: States that a task holds before it passes them on.
HELD = 1 << 16


class Accumulator:
    """A user aggregate. States and results are tuples of the declared fields; ``None`` is allowed in both.

    ``rows`` maps ``us`` (epoch microseconds), ``tie`` if one is named and every name of ``inputs`` to
    arrays of equal length.
    """

    inputs: Sequence[str] = ("value",)
    state: str = ""  # as "n long, low double"
    output: str = ""

    def create(self) -> tuple:
        raise NotImplementedError

    def add(self, state: tuple, rows: dict[str, np.ndarray]) -> tuple:
        raise NotImplementedError

    def merge(self, first: tuple, second: tuple) -> tuple:
        """The state of the rows of both; in a fold those of ``first`` come first."""
        raise NotImplementedError

    def result(self, state: tuple) -> tuple:
        return state


class RowAccumulator(Accumulator):
    """A user aggregate given row by row: ``step(state, row)`` instead of ``add``."""

    def step(self, state: tuple, row: dict) -> tuple:
        raise NotImplementedError

    def add(self, state, rows):
        names = list(rows)
        for values in zip(*(rows[n].tolist() for n in names), strict=True):
            state = self.step(state, dict(zip(names, values, strict=True)))
        return state


def _fields(ddl: str) -> list[T.StructField]:
    return T.StructType.fromDDL(ddl).fields if ddl else []


def key_columns(key: Column) -> list[Column]:
    """A key as text and a flag, which group and compare alike in Spark and Python."""
    return [F.coalesce(key.cast("string"), F.lit("")).alias("_k"), key.isNull().alias("_null")]


def key_again(kind: T.DataType) -> Column:
    return F.when(~F.col("_null"), F.col("_k").cast(kind))


def run_bounds(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal values start, and the end."""
    n = len(columns[0])
    if not n:
        return np.zeros(1, np.int64)
    new = np.ones(n, bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.append(np.flatnonzero(new), n)


def _arrays(b: pa.RecordBatch, names: Sequence[str]) -> dict[str, np.ndarray]:
    return {n: b.column(n).to_numpy(zero_copy_only=False) for n in names}


class _Partials:
    """Collects (key, null, pane, sequence, state) rows as Arrow batches."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows = schema, []

    def add(self, key, pane: int, seq: int, state: tuple) -> None:
        self.rows.append((*key, pane, seq, *state))

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) if self.rows else [()] * len(self.schema)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema, strict=True)], schema=self.schema)


def _arrow(fields: Sequence[T.StructField]) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(T.StructType(list(fields)))


_HEAD = [T.StructField("_k", T.StringType()), T.StructField("_null", T.BooleanType()), T.StructField("_pane", T.LongType()), T.StructField("_seq", T.LongType())]


def _make_aggregate(acc: Accumulator, schema: pa.Schema, names: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple] = {}
        out = _Partials(schema)

        def flush() -> pa.RecordBatch:
            for (k, null, pane), state in held.items():
                out.add((k, null), pane, 0, state)
            held.clear()
            return out.batch()

        for b in batches:
            k, null, pane = (b.column(c).to_numpy(zero_copy_only=False) for c in ("_k", "_null", "_pane"))
            codes = np.unique(k.astype(object), return_inverse=True)[1] * 2 + null
            order = np.lexsort((pane, codes))
            rows = {n: v[order] for n, v in _arrays(b, names).items()}
            k, null, pane = k[order], null[order], pane[order]
            bounds = run_bounds(codes[order], pane)
            for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                group = (k[lo], bool(null[lo]), int(pane[lo]))
                held[group] = acc.add(held[group] if group in held else acc.create(), {n: v[lo:hi] for n, v in rows.items()})
            if len(held) >= HELD:
                yield flush()
        if held:
            yield flush()

    return run


def _make_fold(acc: Accumulator, schema: pa.Schema, names: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Partials(schema)
        open_, state, seq = None, None, 0
        for b in batches:
            k, null, pane = (b.column(c).to_numpy(zero_copy_only=False) for c in ("_k", "_null", "_pane"))
            if not len(k):
                continue
            seq = int(b.column("_pid")[0].as_py())
            rows = _arrays(b, names)
            bounds = run_bounds(k, null, pane)
            for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                group = (k[lo], bool(null[lo]), int(pane[lo]))
                if group != open_:
                    if open_ is not None:
                        out.add(open_[:2], open_[2], seq, state)
                    open_, state = group, acc.create()
                state = acc.add(state, {n: v[lo:hi] for n, v in rows.items()})
            if out.rows:
                yield out.batch()
        if open_ is not None:
            out.add(open_[:2], open_[2], seq, state)
            yield out.batch()

    return run


def _make_merge(acc: Accumulator, schema: pa.Schema, n_state: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, state, done = None, None, []

        def batch() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True))
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        for b in batches:
            for k, null, start, end, *fields in zip(*(c.to_pylist() for c in b.columns), strict=True):
                part = tuple(fields[:n_state])
                if (k, null, start) == (open_[:3] if open_ else None):
                    state = acc.merge(state, part)
                    continue
                if open_:
                    done.append((*open_, *acc.result(state)))
                open_, state = (k, null, start, end), part
            if done:
                yield batch()
        if open_:
            done.append((*open_, *acc.result(state)))
            yield batch()

    return run


def _windows(df: DataFrame, acc: Accumulator, size_s: float, slide_s: float, key: str, ts: str, tie: str | None, ordered: bool,
             num_partitions: int | None) -> DataFrame:
    pane_us = math.gcd(round(size_s * 1000), round(slide_s * 1000)) * 1000
    us = F.unix_micros(F.col(ts))
    names = ["us", *(["tie"] if tie else []), *acc.inputs]
    rows = df.filter(F.col(ts).isNotNull()).select(*key_columns(F.col(key)), (us - F.pmod(us, F.lit(pane_us))).alias("_pane"), us.alias("us"),
                                                   *([F.col(tie).alias("tie")] if tie else []), *acc.inputs)
    fields = _fields(acc.state)
    partial = T.StructType(_HEAD + fields)
    if ordered:
        order = ["_k", "_null", "us"] + (["tie"] if tie else [])
        rows = rows.repartitionByRange(num_partitions, *order).sortWithinPartitions(*order) if num_partitions else rows.orderBy(*order)
        parts = rows.withColumn("_pid", F.spark_partition_id()).mapInArrow(_make_fold(acc, _arrow(partial.fields), names), partial)
    else:
        parts = rows.mapInArrow(_make_aggregate(acc, _arrow(partial.fields), names), partial)
    spread = assign_windows(parts.withColumn("_at", F.timestamp_micros("_pane")), size_s, slide_s, "_at") \
        .select("_k", "_null", F.unix_micros("window_start").alias("_start"), F.unix_micros("window_end").alias("_end"),
                *[f.name for f in fields], "_pane", "_seq")
    merged = T.StructType(_HEAD[:2] + [T.StructField("_start", T.LongType()), T.StructField("_end", T.LongType())] + _fields(acc.output))
    out = spread.repartition("_k", "_null", "_start").sortWithinPartitions("_k", "_null", "_start", "_pane", "_seq") \
        .mapInArrow(_make_merge(acc, _arrow(merged.fields), len(fields)), merged)
    return out.select(F.timestamp_micros("_start").alias("window_start"), F.timestamp_micros("_end").alias("window_end"),
                      key_again(df.schema[key].dataType).alias(key), *[f.name for f in _fields(acc.output)])


def aggregate_windows(df: DataFrame, acc: Accumulator, size_s: float = WINDOW_SIZE_SECONDS, slide_s: float = DEFAULT_SLIDE_SECONDS,
                      key: str = "location", ts: str = "ts", tie: str | None = None) -> DataFrame:
    """``acc`` per key and window, for aggregates that don't depend on the order of rows."""
    return _windows(df, acc, size_s, slide_s, key, ts, tie, False, None)


def fold_windows(df: DataFrame, acc: Accumulator, size_s: float = WINDOW_SIZE_SECONDS, slide_s: float = DEFAULT_SLIDE_SECONDS,
                 key: str = "location", ts: str = "ts", tie: str | None = None, num_partitions: int | None = None) -> DataFrame:
    """``acc`` per key and window over the window's rows in (ts, tie) order: ``add`` sees rows, and ``merge`` states, in order."""
    return _windows(df, acc, size_s, slide_s, key, ts, tie, True, num_partitions)


class CountSum(Accumulator):
    """Count and sum of a column (a null value makes the sum NaN, as Arrow hands it over)."""

    state = output = "events_per_window long, sum_per_window double"

    def __init__(self, value: str = "value"):
        self.inputs = (value,)

    def create(self):
        return 0, 0.0

    def add(self, state, rows):
        v = rows[self.inputs[0]]
        return state[0] + len(v), state[1] + float(np.sum(v))

    def merge(self, first, second):
        return first[0] + second[0], first[1] + second[1]


class Extremes(Accumulator):
    """Number of rows, lowest and highest value, and the value of the first row by (time, tie)."""

    state = "n long, low double, high double, us long, tie long, value double"
    output = "n long, low double, high double, first_value double"

    def create(self):
        return 0, None, None, None, None, None

    def add(self, state, rows):
        v = rows["value"]
        at = np.lexsort((rows["tie"], rows["us"]))[0]
        return self.merge(state, (len(v), float(v.min()), float(v.max()), int(rows["us"][at]), int(rows["tie"][at]), float(v[at])))

    def merge(self, first, second):
        if not first[0] or not second[0]:
            return second if not first[0] else first
        early = first if first[3:5] <= second[3:5] else second
        return (first[0] + second[0], min(first[1], second[1]), max(first[2], second[2]), *early[3:])

    def result(self, state):
        return *state[:3], state[5]


class Variation(Accumulator):
    """How a value moves through a window, in order: rows, rises, total change either way, first and last value."""

    state = "n long, rises long, path double, head double, tail double"
    output = "n long, rises long, path double, first_value double, last_value double"

    def create(self):
        return 0, 0, 0.0, None, None

    def add(self, state, rows):
        v = rows["value"]
        steps = np.diff(v)
        return self.merge(state, (len(v), int((steps > 0).sum()), float(np.abs(steps).sum()), float(v[0]), float(v[-1])))

    def merge(self, first, second):
        if not first[0] or not second[0]:
            return second if not first[0] else first
        step = second[3] - first[4]
        return first[0] + second[0], first[1] + second[1] + int(step > 0), first[2] + second[2] + abs(step), first[3], second[4]
