"""State shared by many keys of a stream.

A group of ``applyInPandasWithState`` costs some milliseconds of Python, whatever its rows. Sparse keys (sensors, or a sensor's days)
so share state: keys are dealt to ``SHARDS`` groups by their hash, and one call works on all keys of a shard at once. What a key gives, and
when, is as if it had a group of its own.
"""

from __future__ import annotations

import pickle

import numpy as np
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Groups that all keys of a stream share, so a call holds about the buffered rows divided by this.
SHARDS = 256

#: A shard's state: one pickled value.
STATE = T.StructType([T.StructField("packed", T.BinaryType())])


def by_shard(rows: DataFrame, *key: str) -> GroupedData:
    """``rows`` grouped by the shard of their key, column ``_shard``."""
    return rows.withColumn("_shard", F.pmod(F.xxhash64(*key), F.lit(SHARDS)).cast("int")).groupBy("_shard")


def load(state):
    """The value that ``save`` stored, None at first."""
    return pickle.loads(state.get[0]) if state.exists else None


def save(state, value) -> None:
    state.update((pickle.dumps(value, pickle.HIGHEST_PROTOCOL),))


def timeout_ms(ms, round_to_ms: int | None):
    """The time-out of a row (a time, or an array of them); it fires once the watermark is after it."""
    if not round_to_ms:
        return ms
    return ms // round_to_ms * round_to_ms + round_to_ms - 1


class Split:
    """A shard's rows by key at the watermark. ``order`` sorts them by key, time and tie; of the rows in that order ``released`` and ``rest``
    tell those that leave and those that stay (late ones do neither); ``held`` is their number and ``next`` the earliest time-out of the
    rest, if any.

    ``keys`` are arrays that tell the keys apart; ``fresh`` tells rows of this call, not from the state. A key is due if the call has rows of
    it, late ones too, or if the watermark passed the time-out of its first row; the others keep all their rows."""

    def __init__(self, keys, us: np.ndarray, tie: np.ndarray, fresh: np.ndarray, wm: int, round_to_ms: int | None):
        self.order = np.lexsort((tie, us, *reversed(keys)))
        ms, fresh = us[self.order] // 1000, fresh[self.order]
        starts = run_starts([k[self.order] for k in keys])
        if not len(starts):
            self.released = self.rest = np.zeros(0, bool)
            self.held, self.next = 0, None
            return
        size = np.diff(np.append(starts, len(ms)))
        due = np.logical_or.reduceat(fresh, starts) | (timeout_ms(ms[starts], round_to_ms) < wm)
        before = ms < wm
        self.released = np.repeat(due, size) & before & ~fresh
        self.rest = ~(fresh & before) & ~self.released
        self.held = int((self.rest | self.released).sum())
        self.next = int(timeout_ms(ms[self.rest], round_to_ms).min()) if self.rest.any() else None


def run_starts(keys) -> np.ndarray:
    """Where runs of equal keys start."""
    n = len(keys[0])
    new = np.ones(n, bool)
    if n:
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(new)
