"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame
whose columns and types match the oracle SQL of the same name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import decode
from ..functions.correct import apply_corrections
from ..operators import enrich, folds, metrics, ordered, process, windows
from ..sources import kafka, tables
from ..session import scratch_path
from ..sources.replay import assign_batches, run_replay
from ..sources.tables import to_oracle_ts
from ..streaming import delivery, monitor
from ..streaming.hot_keys import HotKeyFold
from ..streaming.sort_ema import release_ms, sort_correct_ema
from ..streaming.windows import sliding_stream, with_event_time

# Fixture parameters (FIXTURES.md): correction table, cache TTL for rows
# minutes apart, replay geometry.
CORRECTIONS = {"NATION_7": 1.0}
TTL_MS = 3_600_000
CLOCK_PLUS_MS = 3_600_000
REPLAY_BATCHES = 6
LATE_EVERY = 50
LATE = {0: 2, 1: 1}  # id % LATE_EVERY -> batches later
REPLAY_DELAY_MS = 86_400_000


def _decoded(spark: SparkSession, sf: str) -> DataFrame:
    """Measurements after a JSON round trip (serialise -> decode)."""
    raw = tables.raw_records(spark, sf)
    return decode.decode_measurements(raw, keep=("offset",)).withColumnRenamed("offset", "event_id")


def _round_sum(df: DataFrame) -> DataFrame:
    return to_oracle_ts(df.withColumn("sum_per_window", F.round("sum_per_window", 6)),
                        "window_start", "window_end")


def raw_record_projection(spark, sf):
    raw = kafka.raw_records(tables.raw_records(spark, sf))
    return to_oracle_ts(raw.withColumns({c: F.col(c).cast("string") for c in ("key", "value")}), "timestamp")


def location_list(spark, sf):
    return tables.location_list(spark, sf)


def ingest_roundtrip(spark, sf):
    d = _decoded(spark, sf)
    return to_oracle_ts(d.select("event_id", "sensor_id", "value", "location", "measurement_information", "ts"), "ts")


def decode_drop_malformed(spark, sf):
    raw = tables.malformed_records(spark, sf)
    d = decode.decode_measurements(raw, keep=("offset",)).withColumnRenamed("offset", "event_id")
    return to_oracle_ts(d.select("event_id", "sensor_id", "value", "location", "measurement_information", "ts"), "ts")


def dead_letter_counts(spark, sf):
    return decode.dead_letter_counts(tables.malformed_records(spark, sf))


def sensor_correction(spark, sf):
    m = tables.measurements(spark, sf)
    return apply_corrections(m, CORRECTIONS).select("event_id", "value")


def sliding_count_sum(spark, sf):
    return _round_sum(windows.sliding_count_sum(_decoded(spark, sf), 60, 10))


def sliding_full_buffer(spark, sf):
    return _round_sum(windows.sliding_full_buffer(_decoded(spark, sf), 60, 10, tie="event_id"))


def sliding_count_sum_wide(spark, sf):
    return _round_sum(windows.sliding_count_sum(_decoded(spark, sf), 86_400, 14_400))


def sampling_window(spark, sf):
    return _round_sum(windows.sliding_count_sum(_decoded(spark, sf), 60, 90))


def location_enrich(spark, sf):
    m = tables.measurements(spark, sf)
    e = enrich.enrich_join(m, tables.location_dimension(spark, sf))
    return e.select("event_id", "location", "location_info")


def _digest_service():
    """A lookup service that answers with a digest of the key."""
    import hashlib
    return lambda location: hashlib.md5(location.encode()).hexdigest()


def location_enrich_async(spark, sf):
    m = tables.measurements(spark, sf)
    return enrich.enrich_lookup(m.select("event_id", "location"), _digest_service)


def ttl_cache_hits(spark, sf):
    h = ordered.ttl_cache_hits(tables.measurements(spark, sf), key="location", ttl_ms=TTL_MS)
    return h.select("event_id", "location", "served_from_cache")


def ttl_cache_stats(spark, sf):
    h = ordered.ttl_cache_hits(tables.measurements(spark, sf), key="location", ttl_ms=TTL_MS)
    return ordered.ttl_cache_stats(h, "location")


def sorted_stream(spark, sf):
    return ordered.sorted_positions(tables.measurements(spark, sf), key="sensor_id")


def ema(spark, sf):
    e = ordered.moving_average(_decoded(spark, sf), key="sensor_id")
    return to_oracle_ts(e, "ts")


def ema_corrected(spark, sf):
    d = apply_corrections(_decoded(spark, sf), CORRECTIONS)
    return to_oracle_ts(ordered.moving_average(d, key="sensor_id"), "ts")


def _lag(spark, sf, group):
    m = tables.measurements(spark, sf)
    now = metrics.clock_after_max(m, "ts", CLOCK_PLUS_MS)
    return metrics.lag_stats(m, group, "ts", now)


def sort_lag_stats(spark, sf):
    return _lag(spark, sf, "sensor_id")


def enrich_delay_stats(spark, sf):
    return _lag(spark, sf, "location")


def window_lag_stats(spark, sf):
    d = _decoded(spark, sf)
    now = metrics.clock_after_max(d, "ts", CLOCK_PLUS_MS)
    w = windows.sliding_count_sum(d, 60, 10)
    return metrics.window_lag_stats(w, "location", now)


def _replayed(spark, sf, build):
    """The stream ``build(raw)`` over the raw records: REPLAY_BATCHES micro-batches in offset
    order, some records out of order (one batch later) or late (two batches later)."""
    raw = assign_batches(tables.raw_records(spark, sf), REPLAY_BATCHES, "offset", LATE, LATE_EVERY)
    return run_replay(raw, build)


def sliding_stream_final(spark, sf):
    return _round_sum(_replayed(spark, sf, lambda raw: sliding_stream(raw, 60, 10, REPLAY_DELAY_MS)))


def late_window_drop(spark, sf):
    """Windows as long as the delay: late rows still count in windows that are open."""
    return _round_sum(_replayed(spark, sf, lambda raw: sliding_stream(raw, 86_400, 86_400, REPLAY_DELAY_MS)))


def sampling_stream_final(spark, sf):
    return _round_sum(_replayed(spark, sf, lambda raw: sliding_stream(raw, 60, 90, REPLAY_DELAY_MS)))


def _first_and_last(buffer):
    """A fold that needs the buffer's order."""
    return {"n": F.size(buffer).cast("long"), "first_value": buffer[0]["value"], "last_value": F.element_at(buffer, -1)["value"]}


def buffer_stream_final(spark, sf):
    def build(raw):
        m = decode.decode_measurements(with_event_time(raw, REPLAY_DELAY_MS), keep=("offset",))
        return windows.buffered_windows(m, 14_400, 3_600, tie="offset", fold=_first_and_last)
    return to_oracle_ts(_replayed(spark, sf, build), "window_start", "window_end")


def _sorted_stream_output(spark, sf):
    return _replayed(spark, sf, lambda raw: sort_correct_ema(raw, None, REPLAY_DELAY_MS, 100))


def ema_stream_final(spark, sf):
    out = _sorted_stream_output(spark, sf)
    return to_oracle_ts(out.filter(F.col("ema").isNotNull()).select("sensor_id", "ema", "ts"), "ts")


def sorted_stream_final(spark, sf):
    return _sorted_stream_output(spark, sf).select("sensor_id", "event_id", "pos")


def sort_ema_per_event(spark, sf):
    """The stateful sort with a timer per event instead of one per 100 ms bucket."""
    out = _replayed(spark, sf, lambda raw: sort_correct_ema(raw, CORRECTIONS, REPLAY_DELAY_MS, None))
    return out.select("sensor_id", "event_id", "pos", "ema")


def _hot_sensor_records(spark, sf):
    """Raw records of which every third comes from one sensor."""
    m = tables.measurements(spark, sf)
    hot = F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("sensor_id"))
    raw = tables.raw_records_from(m.withColumn("sensor_id", hot))
    return assign_batches(raw, REPLAY_BATCHES, "offset", LATE, LATE_EVERY)


def _hot_replayed(spark, raw, fold: HotKeyFold):
    """Both queries of a hot-key fold over the replay, and their result."""
    root = scratch_path(spark, "hot")

    def build(stream):
        rows = decode.decode_measurements(with_event_time(stream, REPLAY_DELAY_MS), keep=("offset",))
        return fold.release(rows.withColumnRenamed("offset", "event_id"))

    released = run_replay(raw, build, root=root)
    fold.start_carries(spark, f"{root}/out", released.schema, root, availableNow=True).awaitTermination()
    return fold.result(released, spark.read.parquet(f"{root}/carries"))


def ema_hot_stream_final(spark, sf):
    """The streaming moving average with a third of all rows on one sensor, its state split by day."""
    fold = HotKeyFold(ordered.MovingAverage(), bucket_ms=86_400_000)
    out = _hot_replayed(spark, _hot_sensor_records(spark, sf), fold)
    return to_oracle_ts(out.filter("_emit").select("sensor_id", "event_id", "pos", F.col("_state").alias("ema"), "ts"), "ts")


def sort_release_bucket(spark, sf):
    """The coalesced timer of each row."""
    return tables.measurements(spark, sf).select("event_id", "sensor_id", release_ms("ts", 100).alias("release_ms"))


def release_watermarks(spark, sf):
    """The watermark at which the stateful sort released each row of the replay."""
    fold = HotKeyFold(ordered.Position(), bucket_ms=86_400_000)
    raw = assign_batches(tables.raw_records(spark, sf), REPLAY_BATCHES, "offset", LATE, LATE_EVERY)

    def build(stream):
        rows = decode.decode_measurements(with_event_time(stream, REPLAY_DELAY_MS), keep=("offset",))
        return fold.release(rows.withColumnRenamed("offset", "event_id"))
    return run_replay(raw, build).select(F.col("_key").alias("sensor_id"), F.col("_tie").alias("event_id"), F.col("_chunk").alias("watermark_ms"))


def ttl_stream_final(spark, sf):
    """The event-time TTL cache on a stream, with its counters per location."""
    fold = HotKeyFold(ordered.TtlRefresh("_us", TTL_MS * 1000), key="location", bucket_ms=86_400_000)
    raw = assign_batches(tables.raw_records(spark, sf), REPLAY_BATCHES, "offset", LATE, LATE_EVERY)
    return ordered.ttl_cache_stats(_hot_replayed(spark, raw, fold), "location")


def user_aggregate_windows(spark, sf):
    """A user aggregate (lowest, highest and first value) over sliding windows."""
    w = folds.aggregate_windows(_decoded(spark, sf), folds.Extremes(), 14_400, 3_600, tie="event_id")
    return to_oracle_ts(w, "window_start", "window_end")


def buffer_fold_split(spark, sf):
    """A user fold that needs the order of a window's rows, with a third of all rows at one location."""
    hot = F.when(F.col("event_id") % 3 == 0, F.lit("NATION_0")).otherwise(F.col("location"))
    w = folds.fold_windows(_decoded(spark, sf).withColumn("location", hot), folds.Variation(), 86_400, 21_600, tie="event_id")
    return to_oracle_ts(w.withColumn("path", F.round("path", 6)), "window_start", "window_end")


SESSION_GAP_MS = 28_800_000


def _sessions(df):
    named = df.select("sensor_id", F.timestamp_micros("start_us").alias("session_start"), F.timestamp_micros("end_us").alias("session_end"), "n",
                      F.round("total", 6).alias("total"))
    return to_oracle_ts(named, "session_start", "session_end")


def session_gap_process(spark, sf):
    """A user process function with state and timers: sessions per sensor."""
    return _sessions(process.keyed_process(_decoded(spark, sf), process.Sessions(SESSION_GAP_MS), "sensor_id", horizon_ms=SESSION_GAP_MS))


def session_stream_final(spark, sf):
    """The same function on a stream with late rows."""
    def build(raw):
        m = decode.decode_measurements(with_event_time(raw, REPLAY_DELAY_MS), keep=("offset",)).withColumnRenamed("offset", "event_id")
        return process.keyed_process_stream(m, process.Sessions(SESSION_GAP_MS), "sensor_id")
    return _sessions(_replayed(spark, sf, build))


def _failing_service():
    """The digest service, which one place breaks."""
    digest = _digest_service()

    def lookup(location):
        if location == "NATION_3":
            raise LookupError(location)
        return digest(location)
    return lookup


def location_enrich_failures(spark, sf):
    """Lookups with rows that have no location, and a location whose lookup fails: both get NULL."""
    m = tables.measurements(spark, sf).select("event_id", F.when(F.col("event_id") % 11 != 0, F.col("location")).alias("location"))
    return enrich.enrich_lookup(m, _failing_service, on_error="null")


LAG_SAMPLES = 100


def lag_stream_final(spark, sf):
    """Lag over each location's latest samples, kept in the stream's state."""
    now = tables.measurements(spark, sf).agg(F.max(F.unix_millis("ts"))).first()[0]

    def build(raw):
        m = decode.decode_measurements(raw, keep=("offset",)).withColumnRenamed("offset", "event_id")
        return monitor.latest_lag(m, "location", F.lit(now + CLOCK_PLUS_MS), samples=LAG_SAMPLES)
    out = monitor.current(_replayed(spark, sf, build), "location")
    return out.select("location", "n", "min_lag", "max_lag", *[F.round(c, 3).alias(c) for c in ("avg_lag", "stddev_lag", "p50", "p99")])


def _redelivered(raw):
    """Records of which every tenth comes again, one batch later."""
    b = assign_batches(raw, REPLAY_BATCHES, "offset", LATE, LATE_EVERY)
    return b.union(b.filter(F.col("offset") % 10 == 3).withColumn("batch", F.col("batch") + 1))


def redelivered_stream_final(spark, sf):
    """At-least-once delivery: repeats are removed, late records dropped."""
    def build(raw):
        return decode.decode_measurements(delivery.drop_redelivered(raw, REPLAY_DELAY_MS), keep=("offset",))
    return run_replay(_redelivered(tables.raw_records(spark, sf)), build).select(F.col("offset").alias("event_id"), "sensor_id", "value")


def stream_counters(spark, sf):
    """Counters of every micro-batch of a stream with repeated, late and malformed records."""
    progress: list = []

    def build(raw):
        return decode.split_records(delivery.drop_redelivered(raw, REPLAY_DELAY_MS), keep=("offset",), metrics="decode")
    run_replay(_redelivered(tables.malformed_records(spark, sf)), build, partition_by="kind", progress=progress)
    found = monitor.counters(spark, progress).filter("input_rows > 0")
    return found.select("batch_id", "input_rows", "late", F.col("metrics")["decode.n_records"].alias("records"), F.col("metrics")["decode.n_bad"].alias("bad"))


def dead_letter_stream_final(spark, sf):
    """Measurements and dead letters of one stream, side by side in one sink."""
    raw = assign_batches(tables.malformed_records(spark, sf), REPLAY_BATCHES, "offset", LATE, LATE_EVERY)
    out = run_replay(raw, lambda r: decode.split_records(r, keep=("offset",)), partition_by="kind")
    return out.select("kind", F.col("offset").alias("event_id"), "sensor_id", "value")


SKEW_DELAY_MS = 3_600_000


def skewed_partitions_stream(spark, sf):
    """Hourly windows of a stream one of whose partitions is two batches behind the others, with a watermark per partition."""
    raw = assign_batches(tables.raw_records(spark, sf), REPLAY_BATCHES, "offset")
    behind = F.least(F.col("batch") + 2, F.lit(REPLAY_BATCHES - 1))
    raw = raw.withColumn("batch", F.when(F.col("partition") == 2, behind).otherwise(F.col("batch")))

    def build(stream):
        timed = delivery.with_partition_event_time(stream, range(tables.N_RAW_PARTITIONS), SKEW_DELAY_MS)
        return windows.sliding_count_sum(decode.decode_measurements(timed), 3_600, 3_600)
    return _round_sum(run_replay(raw, build))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "raw_record_projection": raw_record_projection,
    "location_list": location_list,
    "ingest_roundtrip": ingest_roundtrip,
    "decode_drop_malformed": decode_drop_malformed,
    "dead_letter_counts": dead_letter_counts,
    "sensor_correction": sensor_correction,
    "sliding_count_sum": sliding_count_sum,
    "sliding_full_buffer": sliding_full_buffer,
    "sliding_count_sum_wide": sliding_count_sum_wide,
    "sampling_window": sampling_window,
    "location_enrich": location_enrich,
    "location_enrich_async": location_enrich_async,
    "ttl_cache_hits": ttl_cache_hits,
    "ttl_cache_stats": ttl_cache_stats,
    "sorted_stream": sorted_stream,
    "ema": ema,
    "ema_corrected": ema_corrected,
    "sort_lag_stats": sort_lag_stats,
    "enrich_delay_stats": enrich_delay_stats,
    "window_lag_stats": window_lag_stats,
    "sliding_stream_final": sliding_stream_final,
    "late_window_drop": late_window_drop,
    "sampling_stream_final": sampling_stream_final,
    "buffer_stream_final": buffer_stream_final,
    "ema_stream_final": ema_stream_final,
    "sorted_stream_final": sorted_stream_final,
    "sort_ema_per_event": sort_ema_per_event,
    "ema_hot_stream_final": ema_hot_stream_final,
    "ttl_stream_final": ttl_stream_final,
    "sort_release_bucket": sort_release_bucket,
    "release_watermarks": release_watermarks,
    "user_aggregate_windows": user_aggregate_windows,
    "buffer_fold_split": buffer_fold_split,
    "session_gap_process": session_gap_process,
    "session_stream_final": session_stream_final,
    "location_enrich_failures": location_enrich_failures,
    "lag_stream_final": lag_stream_final,
    "redelivered_stream_final": redelivered_stream_final,
    "stream_counters": stream_counters,
    "dead_letter_stream_final": dead_letter_stream_final,
    "skewed_partitions_stream": skewed_partitions_stream,
}
