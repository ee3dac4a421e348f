"""Ordered per-key scans: a state carried along each key's rows in event-time
order (moving average, TTL-cache fold, position in the sorted sequence).

Why not ``groupBy(key).applyInPandas`` or ``repartition(key)``: both put one
key in one task, and a single sensor or location may hold a third of all
rows. Instead:

1. **Range sort** on ``(key, ts, tie)`` (``orderBy``). Spark's range
   partitioner samples the composite sort key, so a hot key is spread over
   many balanced partitions; memory per task stays bounded (external sort,
   Arrow batches).
2. **Local fold** (``mapInPandas``): every partition folds its key runs
   from a fresh start, carrying state across Arrow batches, and adds one
   summary row: first and last key, last state and, where one key fills the
   partition, the *carry map* from an incoming state to the end state. The
   result is checkpointed to the session's shared checkpoint folder (survives
   lost executors; keeps the partitioning of step 1).
3. **Carry resolution** as a two-level scan on executors: blocks of about
   sqrt(#partitions) neighbouring summaries compose their maps, one task runs
   over the block summaries, and each block then gives its partitions their
   carries. The number of jobs is the same for any number of partitions.
4. **Final pass** (``mapInPandas`` on the checkpoint, no shuffle): each
   partition with a carry refolds its first run from the carry until the
   state equals the local fold again (or the run ends); every other row
   keeps its local result.

Carry maps stay small: an average forgets its carry (folds from the extreme
carries meet the local one; values are kept only until then), a TTL cache has one
step per distinct time within the first TTL span, and positions are shifts.

All results are exact: a fold's outputs equal the sequential fold over each
key's full, ordered row sequence.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.arrow import micros_as_timestamps, timestamps_as_micros
from ..session import ensure_checkpoint_dir


def _run_starts(keys: np.ndarray) -> np.ndarray:
    n = len(keys)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    brk = np.ones(n, dtype=bool)
    if n > 1:
        brk[1:] = keys[1:] != keys[:-1]
    return np.flatnonzero(brk)


def _run_ids(starts: np.ndarray, n: int) -> np.ndarray:
    return np.repeat(np.arange(len(starts)), np.diff(np.append(starts, n)))


def _same(a, b) -> bool:
    """Key equality as grouping sees it (None groups with None)."""
    if a is None or b is None:
        return a is None and b is None
    return a == b


def _matches(keys: np.ndarray, key) -> np.ndarray:
    """Vectorised ``_same(k, key)`` over a key array."""
    if key is None:
        return pd.isna(keys)
    return np.asarray(keys == key, dtype=bool)


def _eq_states(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    if a.dtype.kind == "f":
        return (a == b) | (np.isnan(a) & np.isnan(b))
    return a == b


class Kernel:
    """A fold over the rows of each key in order.

    ``fold`` works on consecutive runs of one Arrow batch; run 0 continues
    from ``carry`` (``None`` = the key starts here).
    """

    inputs: tuple[str, ...] = ()
    state_type: T.DataType = T.DoubleType()
    outputs: tuple[tuple[str, T.DataType], ...] = ()
    def fold(self, cols: dict[str, np.ndarray], starts: np.ndarray, carry, n: int):
        raise NotImplementedError

    def fold_runs(self, cols: dict[str, np.ndarray], starts: np.ndarray, carries: np.ndarray, carried: np.ndarray, n: int):
        """``fold`` where every run has a carry of its own, used where ``carried``."""
        if not carried.any():
            return self.fold(cols, starts, None, n)
        done = [self.fold({c: v[a:b] for c, v in cols.items()}, np.array([0]), carry if told else None, b - a)
                for a, b, carry, told in zip(starts.tolist(), np.append(starts[1:], n).tolist(), carries.tolist(), carried.tolist(), strict=True)]
        return np.concatenate([st for st, _ in done]), {c: np.concatenate([out[c] for _, out in done]) for c, _ in self.outputs}

    def maps(self, cols: dict[str, np.ndarray], starts: np.ndarray, states: np.ndarray) -> list:
        """The carry map of every run."""
        out = []
        for a, b in zip(starts.tolist(), np.append(starts[1:], len(states)).tolist(), strict=True):
            probe = self.probe()
            probe.add({c: v[a:b] for c, v in cols.items()}, states[a:b])
            out.append(probe.result())
        return out

    # True: the state with a carry never equals the local one again
    always_shifted = False

    def probe(self):
        """Gathers the carry map of a partition's first run: ``add(cols, states)``
        per batch, then ``result()``."""
        raise NotImplementedError

    def apply(self, carry_map, carry):
        """The end state of rows with this map, reached from ``carry``."""
        raise NotImplementedError

    def compose(self, first, second):
        """The map of the rows of ``first`` followed by those of ``second``."""
        raise NotImplementedError


class MovingAverage(Kernel):
    """``avg = (1 - alpha) * avg + alpha * v``; the first value of a key only
    seeds the average and is not emitted (alpha = 0.5 is ``(avg + v) / 2``).
    A NaN value makes the average NaN from there on, and an infinite one infinite.

    Carry map: (values, end, kinds). ``values`` are the rows whose fold still
    depends on a finite carry, None once folds from the extreme carries met
    the local one, whose ``end`` then holds; ``kinds`` tells which of NaN, +inf
    and -inf occur, all that a non-finite carry depends on.
    """

    #: Folds are monotone in the carry, and every finite average lies between these.
    EXTREME = 2.0 ** 1022

    def __init__(self, value: str = "value", alpha: float = 0.5):
        self.inputs = (value,)
        self.value = value
        self.alpha = float(alpha)
        self.state_type = T.DoubleType()
        self.outputs = (("_emit", T.BooleanType()),)

    def _ewm(self, v: np.ndarray, run_ids: np.ndarray) -> np.ndarray:
        if len(v) == 0:
            return v.astype("float64")
        odd = ~np.isfinite(v)  # pandas would skip these
        s = pd.Series(np.where(odd, 0.0, v), dtype="float64")
        if run_ids[-1] == 0:
            out = s.ewm(alpha=self.alpha, adjust=False).mean().to_numpy()
        else:
            out = (s.groupby(run_ids, sort=False).ewm(alpha=self.alpha, adjust=False).mean()
                   .reset_index(level=0, drop=True).sort_index().to_numpy())
        if odd.any():
            nan, up, down = (pd.Series(f.astype(np.int8)).groupby(run_ids).cummax().to_numpy() > 0
                             for f in (np.isnan(v), np.isposinf(v), np.isneginf(v)))
            out = np.where(nan | (up & down), np.nan, np.where(up, np.inf, np.where(down, -np.inf, out)))
        return out

    def fold(self, cols, starts, carry, n):
        v = cols[self.value].astype("float64")
        n = len(v)
        rid = _run_ids(starts, n)
        emit = np.ones(n, dtype=bool)
        if carry is None:
            st = self._ewm(v, rid)
            emit[starts] = False
        else:
            vv = np.concatenate([[float(carry)], v])
            st = self._ewm(vv, np.concatenate([[0], rid]))[1:]
            emit[starts[1:]] = False
        return st, {"_emit": emit}

    #: Runs longer than this are averaged one by one, shorter ones side by side.
    LONG_RUN = 256

    def _ewm_runs(self, v: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """``_ewm`` for many runs: the k-th rows of all short runs in one step, with the arithmetic of pandas."""
        size = np.diff(np.append(starts, len(v)))
        if not np.isfinite(v).all():
            return self._ewm(v, _run_ids(starts, len(v)))
        out = v.copy()
        for a, n in zip(starts[size > self.LONG_RUN].tolist(), size[size > self.LONG_RUN].tolist(), strict=True):
            out[a:a + n] = self._ewm(v[a:a + n], np.zeros(n, np.int64))
        short = np.flatnonzero(size <= self.LONG_RUN)
        short = short[np.argsort(-size[short], kind="stable")]
        at, left = starts[short], size[short]
        avg, old, new = v[at], 1.0 - self.alpha, self.alpha
        for k in range(1, int(left[0]) if len(left) else 0):
            m = int(np.searchsorted(-left, -k, side="left"))  # runs of more than k rows
            avg, x = avg[:m], v[at[:m] + k]
            avg = np.where(avg == x, avg, (old * avg + new * x) / (old + new))
            out[at[:m] + k] = avg
        return out

    def fold_runs(self, cols, starts, carries, carried, n):
        v = cols[self.value].astype("float64")
        emit = np.ones(len(v), dtype=bool)
        emit[starts[~carried]] = False
        seeded = np.insert(v, starts[carried], carries[carried])
        begin = starts + np.cumsum(carried) - carried
        return np.delete(self._ewm_runs(seeded, begin), begin[carried]), {"_emit": emit}

    def maps(self, cols, starts, states):
        v, all_ = cols[self.value].astype("float64"), np.ones(len(starts), bool)
        if not len(v):
            return []
        low, high = (self.fold_runs(cols, starts, np.full(len(starts), c), all_, len(v))[0] for c in (-self.EXTREME, self.EXTREME))
        met = np.logical_or.reduceat(_eq_states(low, high), starts)
        finite, none = np.isfinite(v).all(), np.zeros(3, dtype=bool)
        return [(None if m else v[a:b].copy(), float(states[b - 1]) if m else None, none if finite else self._kinds(v[a:b]))
                for a, b, m in zip(starts.tolist(), np.append(starts[1:], len(v)).tolist(), met.tolist(), strict=True)]

    def from_carry(self, carry: float, v: np.ndarray) -> np.ndarray:
        return self._ewm(np.concatenate([[carry], v]), np.zeros(len(v) + 1, dtype=np.int64))[1:]

    def _meet(self, low: float, high: float, v: np.ndarray):
        """Folds from both carries, and whether they became equal."""
        lo, hi = self.from_carry(low, v), self.from_carry(high, v)
        return lo, hi, bool(_eq_states(lo, hi).any())

    def probe(self):
        return _AverageProbe(self)

    @staticmethod
    def _kinds(v: np.ndarray) -> np.ndarray:
        return np.array([np.isnan(v).any(), np.isposinf(v).any(), np.isneginf(v).any()])

    def apply(self, carry_map, carry):
        values, end, (nan, up, down) = carry_map
        if not np.isfinite(carry):
            return float("nan") if np.isnan(carry) or nan or (up and carry < 0) or (down and carry > 0) else carry
        if values is None:
            return end
        if len(values) <= self.LONG_RUN and not (nan or up or down):
            old, new = 1.0 - self.alpha, self.alpha
            for x in values.tolist():  # a few values: as pandas would, without its overhead
                if carry != x:
                    carry = (old * carry + new * x) / (old + new)
            return float(carry)
        return float(self.from_carry(carry, values)[-1]) if len(values) else carry

    def compose(self, first, second):
        kinds = first[2] | second[2]
        if second[0] is None:
            return None, second[1], kinds
        if first[0] is None:
            return None, self.apply(second, first[1]), kinds
        values = np.concatenate([first[0], second[0]])
        lo, _, met = self._meet(-self.EXTREME, self.EXTREME, values)
        return (None, float(lo[-1]), kinds) if met else (values, None, kinds)


class _AverageProbe:
    def __init__(self, kernel: MovingAverage):
        self.kernel = kernel
        self.low, self.high, self.met = -kernel.EXTREME, kernel.EXTREME, False
        self.values: list[np.ndarray] = []
        self.kinds = np.zeros(3, dtype=bool)
        self.end = None

    def add(self, cols, states) -> None:
        v = cols[self.kernel.value].astype("float64")
        if not len(v):
            return
        self.kinds |= self.kernel._kinds(v)
        self.end = float(states[-1])
        if not self.met:
            lo, hi, self.met = self.kernel._meet(self.low, self.high, v)
            self.low, self.high = float(lo[-1]), float(hi[-1])
            self.values = [] if self.met else [*self.values, v]

    def result(self):
        if self.met:
            return None, self.end, self.kinds
        return np.concatenate(self.values) if self.values else np.zeros(0), None, self.kinds


class TtlRefresh(Kernel):
    """Event-time TTL cache per key: an entry fetched at ``s`` serves rows
    with ``t - s <= ttl``; the first row after that refetches (``s = t``).
    State = fetch time (µs) of the entry that served the row."""

    def __init__(self, time_us: str = "_us", ttl_us: int = 1_000_000):
        self.inputs = (time_us,)
        self.time = time_us
        self.ttl = int(ttl_us)
        self.state_type = T.LongType()
        self.outputs = (("served_from_cache", T.BooleanType()),)

    def fold(self, cols, starts, carry, n):
        x = cols[self.time].astype("int64")
        n = len(x)
        st = np.empty(n, dtype=np.int64)
        miss = np.zeros(n, dtype=bool)
        bounds = np.append(starts, n)
        ttl = self.ttl
        for r in range(len(starts)):
            a, b = int(bounds[r]), int(bounds[r + 1])
            xs = x[a:b]
            s = int(carry) if (r == 0 and carry is not None) else None
            i = 0
            while i < b - a:
                if s is None or int(xs[i]) - s > ttl:
                    s = int(xs[i])
                    miss[a + i] = True
                j = max(int(np.searchsorted(xs, s + ttl, side="right")), i + 1)
                st[a + i:a + j] = s
                i = j
        return st, {"served_from_cache": ~miss}

    # Carry map: (limits, ends) of a step function: a carry below limits[i]
    # (and not below the one before) ends at ends[i]; a carry beyond all
    # limits serves every row and stays.

    def probe(self):
        return _TtlProbe(self)

    def apply(self, carry_map, carry):
        limits, ends = carry_map
        i = int(np.searchsorted(limits, carry, side="right"))
        return int(ends[i]) if i < len(ends) else int(carry)

    def compose(self, first, second):
        limits, ends = first
        i = int(np.searchsorted(second[0], limits[-1], side="right")) if len(limits) else 0
        at = np.searchsorted(second[0], ends, side="right")
        through = np.where(at < len(second[1]), np.append(second[1], 0)[at], ends)
        return _steps(np.concatenate([limits, second[0][i:]]), np.concatenate([through, second[1][i:]]))


def _steps(limits: np.ndarray, ends: np.ndarray):
    """Neighbouring steps with one end are one step."""
    keep = np.ones(len(ends), dtype=bool)
    keep[:-1] = ends[1:] != ends[:-1]
    return limits[keep], ends[keep]


class _TtlProbe:
    """Follows the fetches from every row of the first TTL span that could be a carry's first miss."""

    def __init__(self, kernel: TtlRefresh):
        self.kernel = kernel
        self.entries: list[np.ndarray] = []  # distinct times that may be fetched first
        self.first = None
        self.open = True  # no row beyond the first TTL span yet
        self.fetched = np.zeros(0, dtype=np.int64)  # distinct fetch times that are current
        self.at = np.zeros(0, dtype=np.int64)  # which of them each entry has reached

    def add(self, cols, states) -> None:
        x, ttl = cols[self.kernel.time].astype("int64"), self.kernel.ttl
        if not len(x):
            return
        self.first = int(x[0]) if self.first is None else self.first
        new = np.zeros(0, dtype=np.int64)
        if self.open:
            stop = int(np.searchsorted(x, self.first + ttl, side="right"))
            self.open = stop == len(x)
            new = np.unique(x[:stop + 1])
            if self.entries:
                new = new[new > self.entries[-1][-1]]
            if len(new):
                self.entries.append(new)
        self.fetched, which = np.unique(np.concatenate([self.fetched, new]), return_inverse=True)
        self.at = which[np.concatenate([self.at, np.arange(len(which) - len(new), len(which))])]
        while True:
            j = np.searchsorted(x, self.fetched + ttl, side="right")
            due = j < len(x)
            if not due.any():
                return
            moved = np.where(due, x[np.minimum(j, len(x) - 1)], self.fetched)
            self.fetched, which = np.unique(moved, return_inverse=True)
            self.at = which[self.at]

    def result(self):
        times = np.concatenate(self.entries) if self.entries else np.zeros(0, dtype=np.int64)
        return _steps(times - self.kernel.ttl, self.fetched[self.at])


class Position(Kernel):
    """1-based position of each row in its key's ordered sequence. Carry map: the number of rows."""

    always_shifted = True

    def __init__(self):
        self.inputs = ()
        self.state_type = T.LongType()
        self.outputs = (("pos", T.LongType()),)

    def fold(self, cols, starts, carry, n):
        idx = np.arange(n, dtype=np.int64)
        st = idx - np.repeat(starts, np.diff(np.append(starts, n))) + 1
        if carry is not None and len(starts):
            first_end = starts[1] if len(starts) > 1 else n
            st[:first_end] += int(carry)
        return st, {"pos": st}

    def probe(self):
        return _CountProbe()

    def apply(self, carry_map, carry):
        return int(carry) + carry_map

    def compose(self, first, second):
        return first + second


class _CountProbe:
    def __init__(self):
        self.n = 0

    def add(self, cols, states) -> None:
        self.n += len(states)

    def result(self):
        return self.n


# --------------------------------------------------------------------------

_SUMMARY_FIELDS = ("_kind", "_first_key", "_single", "_map")


def _local_schema(base: T.StructType, key: str, kernel: Kernel) -> T.StructType:
    key_type = base[key].dataType
    # the summary row leaves data columns NULL, so every field is nullable
    fields = [T.StructField(f.name, f.dataType, True) for f in base.fields] + [
        T.StructField("_pid", T.IntegerType()),
        T.StructField("_idx", T.LongType()),
        T.StructField("_state", kernel.state_type),
    ] + [T.StructField(n, t) for n, t in kernel.outputs] + [
        T.StructField("_kind", T.ByteType()),
        T.StructField("_first_key", key_type),
        T.StructField("_single", T.BooleanType()),
        T.StructField("_map", T.BinaryType()),
    ]
    return T.StructType(fields)


def _make_local_pass(base_cols: Sequence[str], key: str, kernel: Kernel):
    inputs = list(kernel.inputs)
    out_names = [n for n, _ in kernel.outputs]

    def local_pass(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pid = None
        idx = 0
        prev_key, prev_state, have_prev = None, None, False
        first_key, first_run_open = None, True
        probe = kernel.probe()
        for pdf in batches:
            n = len(pdf)
            if n == 0:
                continue
            if pid is None:
                pid = int(pdf["_pid"].iloc[0])
                first_key = pdf[key].iloc[0]
            keys = pdf[key].to_numpy()
            starts = _run_starts(keys)
            carry = prev_state if (have_prev and _same(keys[0], prev_key)) else None
            cols = {c: pdf[c].to_numpy() for c in inputs}
            states, outs = kernel.fold(cols, starts, carry, n)
            out = pdf.drop(columns=["_pid"])
            out["_pid"] = pid
            out["_idx"] = np.arange(idx, idx + n, dtype=np.int64)
            out["_state"] = states
            for c in out_names:
                out[c] = outs[c]
            out["_kind"] = np.int8(0)
            for c in ("_first_key", "_single", "_map"):
                out[c] = None
            # the carry map matters only while one key fills the partition
            if first_run_open:
                first_run_open = len(starts) == 1 and _same(keys[0], first_key)
                if first_run_open:
                    probe.add(cols, states)
            idx += n
            prev_key, prev_state, have_prev = keys[-1], states[-1], True
            yield out
        if pid is None:
            return
        summary = {c: [None] for c in base_cols}
        summary[key] = [prev_key]
        summary.update({"_pid": [pid], "_idx": [None], "_state": [prev_state]})
        for c in out_names:
            summary[c] = [None]
        summary.update({"_kind": [np.int8(1)], "_first_key": [first_key], "_single": [first_run_open],
                        "_map": [pickle.dumps(probe.result()) if first_run_open else None]})
        yield pd.DataFrame(summary)

    return local_pass


def _make_final_pass(key: str, kernel: Kernel, carry_in):
    """``carry_in``: dict pid -> carry, or a broadcast variable holding one."""
    inputs = list(kernel.inputs)
    out_names = [n for n, _ in kernel.outputs]

    def final_pass(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        active = False
        state = None
        first_key = None
        started = False
        for pdf in batches:
            if len(pdf) == 0:
                continue
            if not started:
                started = True
                pid = int(pdf["_pid"].iloc[0])
                carries = carry_in.value if hasattr(carry_in, "value") else carry_in
                if pid in carries:
                    active, state = True, carries[pid]
                    first_key = pdf[key].iloc[0]
            if active:
                keys = pdf[key].to_numpy()
                same = _matches(keys, first_key)
                run_end = int(np.argmin(same)) if not same.all() else len(pdf)
                cols = {c: pdf[c].to_numpy()[:run_end] for c in inputs}
                if run_end:
                    st, outs = kernel.fold(cols, np.array([0]), state, run_end)
                    local = pdf["_state"].to_numpy()[:run_end]
                    if kernel.always_shifted:
                        stop = run_end
                    else:
                        eq = np.flatnonzero(_eq_states(np.asarray(st), local))
                        stop = int(eq[0]) + 1 if len(eq) else run_end
                    pdf = pdf.copy()
                    new_state = pdf["_state"].to_numpy().copy()
                    new_state[:stop] = np.asarray(st)[:stop]
                    pdf["_state"] = new_state
                    for c in out_names:
                        col = pdf[c].to_numpy().copy()
                        col[:stop] = np.asarray(outs[c])[:stop]
                        pdf[c] = col
                    if stop < run_end or run_end < len(pdf):
                        active = False
                    else:
                        state = st[-1]
                else:
                    active = False
            yield pdf

    return final_pass


def _state_of(value, kernel: Kernel):
    # Arrow turns NaN into NULL; a state is never NULL
    if isinstance(kernel.state_type, T.DoubleType):
        return float("nan") if value is None or pd.isna(value) else float(value)
    return int(value)


def _chain(rows, kernel: Kernel, prev=None):
    """Carries along summaries ``(id, first_key, last_key, state, single, map)`` in order.

    ``prev`` is the (last key, end state) before them. Yields ``(id, carry or
    None, end)``: a carry enters where the first key continues the last one.
    """
    for i, first_key, last_key, state, single, carry_map in rows:
        carry = prev[1] if prev is not None and _same(first_key, prev[0]) else None
        end = kernel.apply(carry_map, carry) if carry is not None and single else state
        yield i, carry, end
        prev = (last_key, end)


def _summaries(pdf: pd.DataFrame, kernel: Kernel, id_col: str) -> list[tuple]:
    pdf = pdf.sort_values(id_col)
    return [(int(i), f, k, _state_of(s, kernel), bool(one), pickle.loads(m) if m is not None else None)
            for i, f, k, s, one, m in zip(pdf[id_col], pdf["_first_key"].astype(object), pdf["_last_key"].astype(object),
                                          pdf["_state"], pdf["_single"], pdf["_map"])]


def _carries(ck: DataFrame, key: str, kernel: Kernel, partitions: int) -> DataFrame:
    """``_pid, _carry`` of the partitions whose first run continues: a two-level scan over
    one summary row per partition, whatever the data."""
    size = max(1, math.isqrt(partitions))
    s = ck.filter(F.col("_kind") == 1).select("_pid", "_first_key", F.col(key).alias("_last_key"), "_state", "_single", "_map",
                                              F.floor(F.col("_pid") / F.lit(size)).cast("long").alias("_block"))
    key_type, state_type = s.schema["_last_key"].dataType, kernel.state_type
    block_schema = T.StructType([T.StructField("_block", T.LongType()), T.StructField("_first_key", key_type),
                                 T.StructField("_last_key", key_type), T.StructField("_state", state_type),
                                 T.StructField("_single", T.BooleanType()), T.StructField("_map", T.BinaryType())])

    def compose(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = _summaries(pdf, kernel, "_pid")
        single = all(r[4] and _same(r[1], rows[0][1]) for r in rows)
        carry_map = None
        if single:
            for r in rows:
                carry_map = r[5] if carry_map is None else kernel.compose(carry_map, r[5])
        end = list(_chain(rows, kernel))[-1][2]
        return pd.DataFrame({"_block": [int(pdf["_block"].iloc[0])], "_first_key": [rows[0][1]], "_last_key": [rows[-1][2]],
                             "_state": [end], "_single": [single], "_map": [pickle.dumps(carry_map) if single else None]})

    def enter(pdf: pd.DataFrame) -> pd.DataFrame:
        """What the block before each block ends with."""
        rows = _summaries(pdf, kernel, "_block")
        ends = [e for _, _, e in _chain(rows, kernel)]
        return pd.DataFrame({"_block": [r[0] for r in rows[1:]], "_before_key": pd.Series([r[2] for r in rows[:-1]], dtype=object),
                             "_before": ends[:-1]})

    def deal(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = _summaries(pdf, kernel, "_pid")
        prev = (pdf["_before_key"].astype(object).iloc[0], _state_of(pdf["_before"].iloc[0], kernel)) if pdf["_entered"].notna().iloc[0] else None
        got = [(i, c) for i, c, _ in _chain(rows, kernel, prev) if c is not None]
        return pd.DataFrame({"_pid": pd.Series([i for i, _ in got], dtype="int32"),
                             "_carry": pd.Series([c for _, c in got], dtype="float64" if isinstance(state_type, T.DoubleType) else "int64")})

    blocks = s.groupBy("_block").applyInPandas(compose, block_schema)
    before = blocks.withColumn("_all", F.lit(0)).groupBy("_all").applyInPandas(enter, T.StructType([
        T.StructField("_block", T.LongType()), T.StructField("_before_key", key_type), T.StructField("_before", state_type)]))
    return s.join(before.withColumn("_entered", F.lit(1)), "_block", "left").groupBy("_block").applyInPandas(
        deal, T.StructType([T.StructField("_pid", T.IntegerType()), T.StructField("_carry", state_type)]))


def ordered_scan(df: DataFrame, key: str, order: Sequence[str], kernel: Kernel,
                 keep: Sequence[str] = (), num_partitions: int | None = None) -> DataFrame:
    """Run ``kernel`` along each ``key``'s rows ordered by ``order``.

    Returns ``keep`` columns (plus key/order/inputs as listed) and the
    kernel's outputs; rows with ``_emit = false`` are dropped.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    cols: list[str] = []
    for c in [key, *order, *kernel.inputs, *keep]:
        if c not in cols:
            cols.append(c)
    # Python sees epoch micros, never session-zone wall clocks (same order)
    base, ts_cols = timestamps_as_micros(df.select(*cols))
    if num_partitions:
        srt = base.repartitionByRange(num_partitions, key, *order).sortWithinPartitions(key, *order)
    else:
        srt = base.orderBy(key, *order)
    srt = srt.withColumn("_pid", F.spark_partition_id())
    schema = _local_schema(base.schema, key, kernel)
    local = srt.mapInPandas(_make_local_pass(cols, key, kernel), schema)
    ck = local.checkpoint(eager=True)
    data = ck.filter(F.col("_kind") == 0).drop(*_SUMMARY_FIELDS)
    # one number per partition: shipped once per executor, not per task closure
    found = _carries(ck, key, kernel, ck.rdd.getNumPartitions()).collect()
    carries = spark.sparkContext.broadcast({r["_pid"]: _state_of(r["_carry"], kernel) for r in found})
    out = data.mapInPandas(_make_final_pass(key, kernel, carries), data.schema)
    out_names = [n for n, _ in kernel.outputs]
    if "_emit" in out_names:
        out = out.filter(F.col("_emit"))
    final_cols = [c for c in cols if c not in kernel.inputs or c in keep or c in (key, *order)]
    out = out.select(*final_cols, *[n for n in out_names if n != "_emit"], "_state")
    return micros_as_timestamps(out, ts_cols)


# --- public operators ------------------------------------------------------

def moving_average(df: DataFrame, key: str = "sensor_id", ts: str = "ts", tie: str | None = "event_id",
                   value: str = "value", alpha: float = 0.5, keep: Sequence[str] = (),
                   num_partitions: int | None = None) -> DataFrame:
    """Exponential moving average per key in event-time order.

    Output ``key, ema, ts`` (+``keep``): one row per input row except each
    key's first, which only seeds the average (the reference's rule).
    """
    order = [ts] + ([tie] if tie else [])
    out = ordered_scan(df, key, order, MovingAverage(value, alpha), keep=keep, num_partitions=num_partitions)
    # Arrow turns a NaN average into NULL; the average is never NULL otherwise
    ema = F.when(F.col("_state").isNull(), F.lit(float("nan"))).otherwise(F.col("_state"))
    return out.select(key, ema.alias("ema"), ts, *[k for k in keep if k not in (key, ts)])


def ttl_cache_hits(df: DataFrame, key: str = "location", ts: str = "ts", tie: str | None = "event_id",
                   ttl_ms: int = 1000, keep: Sequence[str] = ("event_id",),
                   num_partitions: int | None = None) -> DataFrame:
    """Which rows a per-key cache with event-time TTL would serve.

    The entry for a key is fetched on a miss and serves later rows whose
    time is at most ``ttl_ms`` after the fetch (inclusive).
    """
    order = [ts] + ([tie] if tie else [])
    d = df.withColumn("_us", F.unix_micros(F.col(ts)))
    out = ordered_scan(d, key, order, TtlRefresh("_us", int(ttl_ms) * 1000), keep=keep,
                       num_partitions=num_partitions)
    return out.select(*keep, key, "served_from_cache",
                      F.timestamp_micros(F.col("_state")).alias("fetched_at"))


def ttl_cache_stats(hits: DataFrame, key: str = "location") -> DataFrame:
    """Cache counters per key: rows served from cache, lookups (misses), and
    the entries the cache holds in the end (one per key ever fetched; sum it for the whole cache)."""
    return hits.groupBy(key).agg(
        F.count(F.when(F.col("served_from_cache"), 1)).alias("served_from_cache"),
        F.count(F.when(~F.col("served_from_cache"), 1)).alias("lookups"),
        F.max(F.when(~F.col("served_from_cache"), 1).otherwise(0)).cast("long").alias("cache_size"))


def sorted_positions(df: DataFrame, key: str = "sensor_id", ts: str = "ts", tie: str | None = "event_id",
                     keep: Sequence[str] = ("event_id",), num_partitions: int | None = None) -> DataFrame:
    """Each row's 1-based position in its key's event-time order."""
    order = [ts] + ([tie] if tie else [])
    out = ordered_scan(df, key, order, Position(), keep=keep, num_partitions=num_partitions)
    return out.select(key, *[k for k in keep if k != key], "pos")
