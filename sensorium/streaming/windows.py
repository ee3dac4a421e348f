"""Streaming sliding-window aggregation with a bounded-out-of-orderness
watermark (the reference's windowing job, in Structured Streaming)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.decode import decode_measurements
from ..operators.windows import sliding_count_sum
from ..schema import DEFAULT_SLIDE_SECONDS, OUT_OF_ORDERNESS_MS, WINDOW_SIZE_SECONDS


def with_event_time(raw: DataFrame, delay_ms: int = OUT_OF_ORDERNESS_MS, ts: str = "timestamp") -> DataFrame:
    """Watermark on the record time, set *before* decoding, so undecodable
    records still advance event time (decode is a generator, which nothing pushes below it)."""
    return raw.withWatermark(ts, f"{int(delay_ms)} milliseconds")


def sliding_stream(raw: DataFrame, size_s: int = WINDOW_SIZE_SECONDS, slide_s: int = DEFAULT_SLIDE_SECONDS,
                   delay_ms: int = OUT_OF_ORDERNESS_MS) -> DataFrame:
    """Count/sum per location and sliding window of a raw record stream.

    Append mode emits each (window, location) once, when the watermark
    passes the window end; state holds partial (count, sum) only.
    """
    meas = decode_measurements(with_event_time(raw, delay_ms))
    return sliding_count_sum(meas, size_s, slide_s)
