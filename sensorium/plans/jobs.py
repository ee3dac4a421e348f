"""The reference's jobs as composed DataFrame pipelines.

Each function takes a raw record DataFrame (Kafka-shaped: ``timestamp,
key, value, partition, offset``; static or streaming) and returns the job's
output DataFrame; the caller picks the sink (``write_kafka``, parquet,
``noop``). Streams get a watermark on the record time before decoding.

| reference job                  | function                                   |
| ------------------------------ | ------------------------------------------ |
| windowing (incremental)        | ``windowing_job(raw)``                     |
| windowing (no aggregation)     | ``windowing_job(raw, buffered=True)``      |
| enriching, sync lookup         | ``enriching_job(raw, dim=...)``            |
| enriching, async lookup        | ``enriching_job(raw, client_factory=...)`` |
| sorting, one timer per event   | ``sorting_job(raw, round_to_ms=None)``     |
| sorting, coalesced timers      | ``sorting_job(raw, round_to_ms=100)``      |
| ingesting                      | ``ingesting_job(measurements)``            |
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.correct import apply_corrections
from ..functions.decode import decode_measurements
from ..operators import enrich, ordered, windows
from ..schema import (CACHE_TTL_MS, DEFAULT_CORRECTIONS, DEFAULT_SLIDE_SECONDS, OUT_OF_ORDERNESS_MS,
                      ROUND_TIMER_TO_MS, WINDOW_SIZE_SECONDS)
from ..sources.kafka import serialize_measurements
from ..streaming.sort_ema import sort_correct_ema
from ..streaming.windows import with_event_time


def _decoded(raw: DataFrame, delay_ms: int) -> DataFrame:
    src = with_event_time(raw, delay_ms) if raw.isStreaming else raw
    return decode_measurements(src, keep=("offset",))


def windowing_job(raw: DataFrame, slide_s: int = DEFAULT_SLIDE_SECONDS, delay_ms: int = OUT_OF_ORDERNESS_MS,
                  buffered: bool = False) -> DataFrame:
    """Count and sum per location over 1-minute windows sliding by
    ``slide_s`` seconds. ``buffered`` folds whole window buffers instead of
    aggregating incrementally, on tables and streams."""
    m = _decoded(raw, delay_ms)
    if buffered and raw.isStreaming:
        return windows.buffered_windows(m, WINDOW_SIZE_SECONDS, slide_s, tie="offset")
    if buffered:
        return windows.sliding_full_buffer(m, WINDOW_SIZE_SECONDS, slide_s, tie="offset")
    return windows.sliding_count_sum(m, WINDOW_SIZE_SECONDS, slide_s)


def enriching_job(raw: DataFrame, dim: DataFrame | None = None, client_factory=None,
                  delay_ms: int = OUT_OF_ORDERNESS_MS, ttl_ms: int = CACHE_TTL_MS) -> DataFrame:
    """Every measurement with its location information: from a dimension
    table (broadcast join) or a lookup client (cached, concurrent)."""
    m = _decoded(raw, delay_ms)
    if dim is not None:
        return enrich.enrich_join(m, dim)
    if client_factory is None:
        raise ValueError("give a dimension table or a lookup client factory")
    return enrich.enrich_lookup(m, client_factory, ttl_ms=ttl_ms)


def sorting_job(raw: DataFrame, corrections: Mapping[str, float] | DataFrame | None = None,
                round_to_ms: int | None = ROUND_TIMER_TO_MS, delay_ms: int = OUT_OF_ORDERNESS_MS,
                alpha: float = 0.5) -> DataFrame:
    """Per sensor: event-time order, location correction, moving average.

    Stream: one stateful operator (late rows dropped, rows released once the
    watermark passes them). Batch: the exact ordered scan over the whole
    table (no row is late in a table). Output ``sensor_id, ema, ts``.
    """
    corrections = DEFAULT_CORRECTIONS if corrections is None else corrections
    if raw.isStreaming:
        out = sort_correct_ema(raw, corrections, delay_ms, round_to_ms, alpha)
        return out.filter(F.col("ema").isNotNull()).select("sensor_id", "ema", "ts")
    m = apply_corrections(_decoded(raw, delay_ms).withColumnRenamed("offset", "event_id"), corrections)
    return ordered.moving_average(m, key="sensor_id", ts="ts", tie="event_id", alpha=alpha)


def ingesting_job(measurements: DataFrame, topic: str | None = None) -> DataFrame:
    """Producer records (null key, JSON value) for the measurement topic."""
    return serialize_measurements(measurements, topic)
