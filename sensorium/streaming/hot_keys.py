"""Ordered folds over a stream whose keys may be hot.

``sort_ema`` keeps a key's rows in one state row, so one sensor is one task. Here the
state is keyed by (key, time bucket), and a fold (moving average, TTL cache, position) is put
together from its buckets in three steps:

1. ``release`` (stateful, by key and bucket): late rows are dropped and the others buffered
   by the rule of ``sort_ema``. What the watermark passed leaves in order as a *chunk*; its
   first row carries the chunk's summary: row count, end state of a fresh fold, carry map.
2. ``carries`` (stateful, by key): reads the summaries only, one row per chunk, composes
   them in order and gives each chunk the state it starts from.
3. ``result`` (no state): brings each chunk's carry before its rows by one sort on (key, bucket, chunk) and folds each
   chunk from its carry, so results equal the sequential fold bit by bit.

Steps 1 and 2 are two streaming queries with a table between them, each with its own
checkpoint; step 3 is a view over their two tables. A key with a third of all rows is so spread by its
buckets (choose ``bucket_ms`` below the trigger interval). Buckets are dealt to the state rows of ``shards``: a call holds the
buffered rows of a shard's buckets, which it works on at once, or their summaries, one per chunk. A chunk's carry map holds the values that a fold still depends on
(for an average with alpha 0.5 about a thousand at most, for a TTL cache one step per distinct time of a TTL span).

All chunks of a micro-batch lie between its watermark and the one before, so a later batch never
releases a row before one already released: step 2 may take any number of released batches at a time.

Nulls in the key form a key of their own. Rows that repeat are rows of their own; equal times go by ``tie``.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from ..operators.folds import key_again, key_columns
from ..operators.ordered import Kernel, _state_of
from ..schema import ROUND_TIMER_TO_MS
from . import shards

RELEASED, CARRIES = "released", "carries"


@dataclass
class HotKeyFold:
    """A fold of ``kernel`` along each key's rows in (ts, tie) order; ``keep`` names further columns of the result."""

    kernel: Kernel
    key: str = "sensor_id"
    ts: str = "ts"
    tie: str = "event_id"
    keep: Sequence[str] = ()
    bucket_ms: int = 1000
    round_to_ms: int | None = ROUND_TIMER_TO_MS

    def _columns(self) -> list[str]:
        return list(dict.fromkeys([c for c in (*self.kernel.inputs, *self.keep) if c not in ("_us", self.key, self.ts, self.tie)]))

    def release(self, rows: DataFrame) -> DataFrame:
        """Step 1: a stream of measurements with a watermark on ``ts`` -> released rows, chunk by chunk."""
        columns = self._columns()
        ms = F.unix_millis(F.col(self.ts))
        data = rows.select(*key_columns(F.col(self.key)), F.floor(ms / F.lit(self.bucket_ms)).cast("long").alias("_bucket"), self.ts,
                           F.unix_micros(F.col(self.ts)).alias("_us"), F.col(self.tie).cast("long").alias("_tie"), *columns)
        body = [T.StructField("_bucket", T.LongType()), T.StructField("_chunk", T.LongType()), T.StructField("_idx", T.LongType()),
                T.StructField("_us", T.LongType()), T.StructField("_tie", T.LongType()), *[T.StructField(c, data.schema[c].dataType) for c in columns],
                T.StructField("_n", T.LongType()), T.StructField("_held", T.LongType()),
                T.StructField("_end", self.kernel.state_type), T.StructField("_map", T.BinaryType())]
        out = T.StructType([T.StructField("_k", T.StringType()), T.StructField("_null", T.BooleanType()), *body])
        fn = _make_release(self.kernel, ["_k", "_null", "_bucket", "_us", "_tie", *columns], self.round_to_ms)
        done = shards.by_shard(data, "_k", "_null", "_bucket").applyInPandasWithState(
            fn, out, shards.STATE, "append", GroupStateTimeout.EventTimeTimeout)
        return done.select(key_again(rows.schema[self.key].dataType).alias("_key"), *[f.name for f in body])

    def carries(self, released: DataFrame) -> DataFrame:
        """Step 2: the stream of released rows -> (_key, _bucket, _chunk, _carried, _carry, _start) per chunk."""
        heads = released.filter(F.col("_n").isNotNull()).select(*key_columns(F.col("_key")), "_bucket", "_chunk", "_us", "_tie", "_n", "_end", "_map")
        body = [T.StructField("_bucket", T.LongType()), T.StructField("_chunk", T.LongType()), T.StructField("_carried", T.BooleanType()),
                T.StructField("_carry", self.kernel.state_type), T.StructField("_start", T.LongType())]
        out = T.StructType([T.StructField("_k", T.StringType()), T.StructField("_null", T.BooleanType()), *body])
        done = shards.by_shard(heads, "_k", "_null").applyInPandasWithState(
            _make_carries(self.kernel), out, shards.STATE, "append", GroupStateTimeout.NoTimeout)
        return done.select(key_again(released.schema["_key"].dataType).alias("_key"), *[f.name for f in body])

    def result(self, released: DataFrame, carries: DataFrame) -> DataFrame:
        """Step 3: ``key, tie, ts``, the kept columns, ``pos`` (1-based in the key's order), the kernel's outputs and ``_state``."""
        from pyspark.sql.pandas.types import to_arrow_schema

        kernel, columns = self.kernel, self._columns()
        outputs = [(n, t) for n, t in kernel.outputs if n != "pos"]
        on = ["_k", "_null", "_bucket", "_chunk"]
        rows = released.select(*key_columns(F.col("_key")), "_bucket", "_chunk", "_idx", "_us", "_tie", *columns)
        zero = F.lit(0).cast("long")
        # a chunk's carry comes before its rows
        heads = carries.select(*key_columns(F.col("_key")), "_bucket", "_chunk", (zero - 1).alias("_idx"), zero.alias("_us"), zero.alias("_tie"),
                               "_carried", "_carry", "_start")
        every = rows.unionByName(heads, allowMissingColumns=True)
        fields = [rows.schema[c] for c in ("_k", "_null", "_us", "_tie", *columns)] + [T.StructField("pos", T.LongType())] + \
            [T.StructField(n, t) for n, t in outputs] + [T.StructField("_state", kernel.state_type)]
        schema = T.StructType(fields)
        done = every.repartition(*on).sortWithinPartitions(*on, "_idx") \
            .mapInArrow(_make_fold(kernel, ["_k", "_null", "_us", "_tie", *columns], outputs, to_arrow_schema(schema)), schema)
        return done.select(key_again(released.schema["_key"].dataType).alias(self.key), F.col("_tie").alias(self.tie), F.timestamp_micros("_us").alias(self.ts),
                           *[c for c in self.keep if c in columns], "pos", *[n for n, _ in outputs], "_state")

    def start(self, rows: DataFrame, root: str, **trigger):
        """Start both queries on tables under ``root``; read the result with ``read``. ``trigger`` goes to ``DataStreamWriter.trigger``."""
        released = self.release(rows)
        first = _write(released, f"{root}/{RELEASED}", **trigger)
        if trigger.get("availableNow"):
            first.awaitTermination()
        return first, self.start_carries(rows.sparkSession, f"{root}/{RELEASED}", released.schema, root, **trigger)

    def start_carries(self, spark: SparkSession, folder: str, schema: T.StructType, root: str, **trigger):
        return _write(self.carries(spark.readStream.schema(schema).parquet(folder)), f"{root}/{CARRIES}", **trigger)

    def read(self, spark: SparkSession, root: str) -> DataFrame:
        """All rows whose chunk has its carry by now."""
        return self.result(*(spark.read.parquet(f"{root}/{t}") for t in (RELEASED, CARRIES)))


def _write(df: DataFrame, path: str, **trigger):
    w = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{path}-checkpoint")
    return (w.trigger(**trigger) if trigger else w).start(path)


def _make_release(kernel: Kernel, names: list[str], round_to_ms: int | None):
    def release(key, pdfs: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        import warnings
        warnings.filterwarnings("ignore", category=FutureWarning)  # a pandas notice raised inside PySpark's state serializer
        wm = state.getCurrentWatermarkMs()
        kept = shards.load(state)
        parts, old = ([], 0) if kept is None else ([kept], len(kept))
        if not state.hasTimedOut:
            parts += [pdf[names] for pdf in pdfs if len(pdf)]
        if not parts:
            return
        held = pd.concat(parts, ignore_index=True) if len(parts) > 1 else parts[0].reset_index(drop=True)
        null, bucket = held["_null"].to_numpy(bool), held["_bucket"].to_numpy(np.int64)
        code = pd.factorize(held["_k"])[0] * 2 + null
        split = shards.Split([code, bucket], held["_us"].to_numpy(np.int64), held["_tie"].to_numpy(), np.arange(len(held)) >= old, wm, round_to_ms)
        at = split.order[split.released]
        n = len(at)
        if n:
            out = held.iloc[at].reset_index(drop=True)
            starts = shards.run_starts([code[at], bucket[at]])
            ends = np.append(starts[1:], n)
            cols = {c: out[c].to_numpy() for c in kernel.inputs}
            fresh = np.zeros(len(starts))
            states, _ = kernel.fold_runs(cols, starts, fresh, fresh > 0, n)
            out["_chunk"] = int(wm)
            out["_idx"] = np.arange(n, dtype=np.int64) - np.repeat(starts, ends - starts)
            head = np.ones(n, bool)  # every row but the first of its chunk
            head[starts] = False

            def first(values, kind):
                filled = np.zeros(n, kind)
                filled[starts] = values
                return filled

            out["_n"] = pd.arrays.IntegerArray(first(ends - starts, np.int64), mask=head)
            out["_held"] = pd.arrays.IntegerArray(first(split.held, np.int64), mask=head)
            of = (pd.arrays.IntegerArray, np.int64) if isinstance(kernel.state_type, T.LongType) else (pd.arrays.FloatingArray, np.float64)
            out["_end"] = of[0](first(states[ends - 1], of[1]), mask=head)
            packed = np.full(n, None, dtype=object)
            for i, m in zip(starts.tolist(), kernel.maps(cols, starts, states), strict=True):
                packed[i] = pickle.dumps(m)
            out["_map"] = packed
            yield out
        if split.next is not None:
            shards.save(state, held.iloc[split.order[split.rest]].reset_index(drop=True))
            state.setTimeoutTimestamp(split.next)
        elif state.exists:
            state.remove()

    return release


def _make_carries(kernel: Kernel):
    def carries(key, pdfs: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        import warnings
        warnings.filterwarnings("ignore", category=FutureWarning)
        heads = pd.concat(list(pdfs), ignore_index=True).sort_values(["_null", "_k", "_us", "_tie", "_bucket", "_chunk"])
        ends = shards.load(state) or {}  # key -> state and number of rows after its last chunk
        rows = []
        for k, null, bucket, chunk, n, end, packed in zip(*(heads[c].tolist() for c in ("_k", "_null", "_bucket", "_chunk", "_n", "_end", "_map")), strict=True):
            carry, seq = ends.get((k, null), (None, 0))
            carried = (k, null) in ends
            rows.append((k, null, bucket, chunk, carried, carry, seq))
            ends[k, null] = (kernel.apply(pickle.loads(packed), carry) if carried else _state_of(end, kernel)), seq + n
        shards.save(state, ends)
        out = pd.DataFrame(rows, columns=["_k", "_null", "_bucket", "_chunk", "_carried", "_carry", "_start"])
        out["_carry"] = out["_carry"].astype("Int64" if isinstance(kernel.state_type, T.LongType) else "float64")
        yield out

    return carries


def _make_fold(kernel: Kernel, passed: list[str], outputs: list[tuple[str, T.DataType]], schema: pa.Schema):
    """Over rows sorted by (chunk, index), where a row with a chunk's carry (index -1) comes before the chunk's: every chunk folded from its carry.
    Rows of a chunk without one are left out. A chunk may run over several Arrow batches."""
    kind = np.int64 if isinstance(kernel.state_type, T.LongType) else np.float64

    def values(b: pa.RecordBatch, name: str, null) -> np.ndarray:
        return b.column(name).fill_null(null).to_numpy(zero_copy_only=False)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the open chunk, whether its carry was there, whether it starts its key, state, rows of the key before it
        for b in batches:
            if not b.num_rows:
                continue
            text = pd.factorize(b.column("_k").to_numpy(zero_copy_only=False))[0]
            on = [text, *(values(b, c, z) for c, z in (("_null", False), ("_bucket", 0), ("_chunk", 0)))]
            idx = values(b, "_idx", 0)
            starts = shards.run_starts(on)
            named = lambda i: tuple(b.column(c)[i].as_py() for c in ("_k", "_null", "_bucket", "_chunk"))  # noqa: B023, E731
            told = idx[starts] < 0
            carried, carry, begin = (values(b, c, z)[starts] for c, z in (("_carried", False), ("_carry", 0 if kind is np.int64 else float("nan")), ("_start", 0)))
            carry = carry.astype(kind)
            if last is not None and not told[0] and last[0] == named(0):
                told[0], carried[0], carry[0], begin[0] = last[1:]
            size = np.diff(np.append(starts, b.num_rows))
            take = np.repeat(told, size) & (idx >= 0)
            rows = np.add.reduceat(take, starts, dtype=np.int64)
            some = rows > 0
            n = int(rows.sum())
            end = carried[-1], carry[-1]
            if n:
                found = b.filter(pa.array(take))
                runs = np.cumsum(rows[some]) - rows[some]
                cols = {c: found.column(c).to_numpy(zero_copy_only=False) for c in kernel.inputs}
                states, outs = kernel.fold_runs(cols, runs, carry[some], carried[some], n)
                if some[-1]:
                    end = True, states[-1]
                made = [found.column(c) for c in passed] + [pa.array(np.repeat(begin[some], rows[some]) + 1 + idx[take])] + \
                    [pa.array(outs[name]) for name, _ in outputs] + [pa.array(states, from_pandas=True)]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(made, schema, strict=True)], schema=schema)
            last = (named(b.num_rows - 1), bool(told[-1]), *end, begin[-1])

    return fold
