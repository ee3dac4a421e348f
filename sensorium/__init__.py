"""sensorium — event-time analytics on sensor measurements, written against
the PySpark DataFrame / Structured Streaming API.

Every public function takes and returns a ``DataFrame`` (batch or stream
where Spark allows) and keeps no hidden session state.
"""

from .functions.correct import apply_corrections
from .functions.decode import dead_letter_counts, dead_letters, decode_measurements
from .operators.enrich import enrich_join, enrich_lookup
from .operators.metrics import lag_stats, observe_lag, processing_lag_ms, window_lag_stats
from .operators.ordered import moving_average, ordered_scan, sorted_positions, ttl_cache_hits, ttl_cache_stats
from .operators.windows import buffered_windows, sliding_count_sum, sliding_full_buffer
from .plans.jobs import enriching_job, ingesting_job, sorting_job, windowing_job
from .sources.kafka import read_kafka, write_kafka
from .streaming.sort_ema import sort_correct_ema
from .streaming.windows import sliding_stream, with_event_time

__version__ = "0.1.0"

__all__ = [
    "apply_corrections", "dead_letter_counts", "dead_letters", "decode_measurements",
    "enrich_join", "enrich_lookup", "lag_stats", "processing_lag_ms",
    "observe_lag", "window_lag_stats", "moving_average", "ordered_scan", "sorted_positions", "ttl_cache_hits",
    "ttl_cache_stats", "buffered_windows", "sliding_count_sum", "sliding_full_buffer", "enriching_job", "ingesting_job",
    "sorting_job", "windowing_job", "read_kafka", "write_kafka", "sort_correct_ema", "sliding_stream",
    "with_event_time",
]
