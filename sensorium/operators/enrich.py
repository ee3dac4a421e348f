"""Enrichment of measurements with per-location information.

* :func:`enrich_join` — the Spark-first form: a left join to a location
  dimension, broadcast by the planner while it is small, so the measurement
  side is not shuffled. Row count is preserved (a key with two rows is an error).
* :func:`enrich_lookup` — for a real lookup service that cannot be read as
  a table: ``mapInPandas`` over Arrow batches; only distinct keys missing
  from the task's TTL cache are fetched, concurrently, by a user-supplied
  client, while later batches pass. No shuffle; output order is not kept.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from concurrent.futures import ALL_COMPLETED, FIRST_COMPLETED, ThreadPoolExecutor, wait

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import ASYNC_CAPACITY, CACHE_TTL_MS
from ..functions.arrow import micros_as_timestamps, timestamps_as_micros

#: Rows of a task that wait for lookups at a time.
MAX_WAITING = 50_000
#: How long a batch's lookups may take before the next batch is read.
LINGER_S = 0.02


def unique_dimension(dim: DataFrame, key: str, value: str, as_key: str, as_value: str) -> DataFrame:
    """``dim`` as (as_key, as_value); a key with several rows is an error, never a silent pick."""
    one = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.concat(F.lit(f"several rows for {key} "), F.col(key).cast("string"))))
    return dim.filter(F.col(key).isNotNull()).groupBy(key).agg(one.otherwise(F.first(value)).alias(as_value)).withColumnRenamed(key, as_key)


def enrich_join(meas: DataFrame, dim: DataFrame, key: str = "location",
                info: str = "location_info") -> DataFrame:
    """Left join of measurements to ``dim(key, info)`` (one row per key, checked).

    The planner broadcasts the dimension while its size is below the
    session's broadcast threshold, and joins by shuffle beyond it."""
    d = unique_dimension(dim, key, info, "_dim_key", info)
    return meas.join(d, F.col(key) == F.col("_dim_key"), "left").drop("_dim_key")


def _now_ms() -> int:
    return int(time.time() * 1000)


class _InFlight:
    """Lookups under way, and the rows that wait for each."""

    def __init__(self, timeout_s: float | None, on_error: str):
        self.timeout_s, self.on_error = timeout_s, on_error
        self.futures: dict = {}  # key -> (future, started)
        self.rows: dict = {}  # key -> frames in order
        self.size = 0

    def add(self, key, rows: pd.DataFrame) -> None:
        self.rows.setdefault(key, []).append(rows)
        self.size += len(rows)

    def _overdue(self, key) -> bool:
        return self.timeout_s is not None and time.monotonic() - self.futures[key][1] >= self.timeout_s

    def settle(self, wait_s: float | None, first: bool, found: Callable) -> list[pd.DataFrame]:
        """The rows of every lookup that is back, failed or overdue after waiting for at most ``wait_s`` (for the ``first`` one only).
        ``found(key, value)`` is told what came back; what failed is an error, or NULL by ``on_error="null"``."""
        if self.timeout_s is not None and self.futures:
            left = max(0.0, min(t for _, t in self.futures.values()) + self.timeout_s - time.monotonic())
            wait_s = left if wait_s is None else min(wait_s, left)
        wait([f for f, _ in self.futures.values()], wait_s, FIRST_COMPLETED if first else ALL_COMPLETED)
        out = []
        for key in [k for k, (f, _) in self.futures.items() if f.done() or self._overdue(k)]:
            future, value = self.futures.pop(key)[0], None
            try:
                value = future.result(timeout=0)
            except Exception:  # noqa: BLE001 - whatever the client raises, or the time limit
                if self.on_error != "null":
                    raise
                future.cancel()
            else:
                found(key, value)
            for rows in self.rows.pop(key):
                self.size -= len(rows)
                out.append(rows.assign(**{self.info: pd.Series([value] * len(rows), index=rows.index, dtype=object)}))
        return out


def _lookup_batches(batches, client_factory, key, info, ttl_ms, capacity, timeout_s, flag=None, on_error="raise", max_waiting=MAX_WAITING):
    """Rows served from the cache go out at once. Rows of a key that is being looked up wait while later batches pass, at most
    ``max_waiting`` of them; each key is asked for once. The cache is this task's alone: another query, or another
    client, cannot see its entries, and expired ones leave it with every batch."""
    client = client_factory()
    cache: dict = {}  # key -> (fetched_at_ms, info)
    flight = _InFlight(timeout_s, on_error)
    flight.info = info
    names: list[str] = []

    def frame(parts: list[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if parts:
            yield pd.concat(parts)[names] if len(parts) > 1 else parts[0][names]

    def found(k, value):
        cache[k] = (_now_ms(), value)

    pool = ThreadPoolExecutor(max_workers=capacity)
    try:
        for pdf in batches:
            names = [*pdf.columns, info] + ([flag] if flag else [])
            now = _now_ms()
            for k in [k for k, (t, _) in cache.items() if now - t > ttl_ms]:
                del cache[k]
            null = pdf[key].isna()  # a null key is never asked for
            hit = pdf[key].isin(list(cache)) & ~null
            ready = pdf[hit | null]
            if len(ready):
                ready = ready.assign(**{info: ready[key].map({k: v for k, (_, v) in cache.items()}).astype(object).where(hit[ready.index], None)})
                yield (ready.assign(**{flag: hit[ready.index]}) if flag else ready)[names]
            for k, rows in pdf[~(hit | null)].groupby(key, sort=False):
                asked = k in flight.futures
                if not asked:
                    flight.futures[k] = (pool.submit(client, k), time.monotonic())
                # of the rows that wait for one lookup, the first missed
                flight.add(k, rows.assign(**{flag: asked | (np.arange(len(rows)) > 0)}) if flag else rows)
            if flight.futures:
                yield from frame(flight.settle(LINGER_S, False, found))
            while flight.size > max_waiting:
                yield from frame(flight.settle(None, True, found))
        while flight.futures:
            yield from frame(flight.settle(None, True, found))
    finally:
        pool.shutdown(wait=False, cancel_futures=True)


def enrich_lookup(meas: DataFrame, client_factory: Callable[[], Callable[[str], str]],
                  key: str = "location", info: str = "location_info",
                  ttl_ms: int = CACHE_TTL_MS, capacity: int = ASYNC_CAPACITY,
                  timeout_s: float | None = None, flag: str | None = None,
                  on_error: str = "raise", max_waiting: int = MAX_WAITING) -> DataFrame:
    """Enrich each row through ``client(key) -> info`` with a TTL cache.

    ``client_factory`` is called once per task to build the client (it must
    be picklable). Up to ``capacity`` lookups run at once; ``timeout_s=None``
    waits without limit (the reference's timeout 0). ``flag`` names an
    optional boolean column: the row was served from the cache (sum it with
    ``observe`` for the reference's served-from-cache counter).

    A row with a NULL key gets NULL and no lookup. A lookup that fails or takes longer than ``timeout_s`` fails the
    task (``on_error="raise"``) or leaves its rows NULL, uncached (``"null"``). Rows may wait for
    their lookup while later batches pass, at most ``max_waiting`` of them in a task.
    """
    if on_error not in ("raise", "null"):
        raise ValueError("on_error is 'raise' or 'null'")
    meas, ts_cols = timestamps_as_micros(meas)
    schema = T.StructType(list(meas.schema.fields) + [T.StructField(info, T.StringType())]
                          + ([T.StructField(flag, T.BooleanType())] if flag else []))

    def run(batches):
        return _lookup_batches(batches, client_factory, key, info, ttl_ms, capacity, timeout_s, flag, on_error, max_waiting)

    return micros_as_timestamps(meas.mapInPandas(run, schema), ts_cols)
