"""Streams over fixed micro-batches (FIXTURES §4): late rows, watermark
timing, stream = batch on finalised output."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorium.schema import RAW_RECORD
from sensorium.sources.replay import assign_batches, run_replay
from sensorium.streaming.sort_ema import sort_correct_ema
from sensorium.streaming.windows import sliding_stream

T0 = datetime(2024, 1, 1)
# boundary table: millisecond offsets per micro-batch, delay 250 ms
BOUNDARY = [[1000], [749, 750, 751, 2000], [740, 750, 760, 1750, 2500], [1700, 1760, 2251, 5000]]


def _boundary(spark):
    rows, off = [], 0
    for b, batch in enumerate(BOUNDARY):
        for ms in batch:
            off += 1
            js = f'{{"sensorId": 1, "value": {float(ms)}, "location": "L", "measurementInformation": "i"}}'
            rows.append((T0 + timedelta(milliseconds=ms), None, bytearray(js.encode()), 0, off, b))
    return spark.createDataFrame(rows, T.StructType(RAW_RECORD.fields + [T.StructField("batch", T.IntegerType())]))


def test_tumbling_500ms_late_rows(spark):
    got = run_replay(_boundary(spark), lambda raw: sliding_stream(raw, 0.5, 0.5, 250))
    got = {int((r.window_start - T0).total_seconds() * 1000): r.events_per_window for r in got.collect()}
    assert got == {500: 6, 1000: 1, 1500: 3, 2000: 2, 2500: 1}


@pytest.mark.parametrize("engine", ["group_state", "state_api"])
def test_sort_drops_late_rows_and_releases_in_order(spark, engine):
    got = run_replay(_boundary(spark), lambda raw: sort_correct_ema(raw, None, 250, 100, engine=engine)).orderBy("pos").collect()
    times = [int((r.ts - T0).total_seconds() * 1000) for r in got]
    # wm(b) = max(ms of earlier batches) - 250 = -, 750, 1750, 2250; a row is
    # late when ms < wm(b): 749 | 740 750 760 | 1700 1760. Final wm 4750:
    # 5000 stays buffered.
    assert times == [750, 751, 1000, 1750, 2000, 2251, 2500]
    assert [r.pos for r in got] == list(range(1, 8))
    assert got[0].ema is None and got[1].ema == (750.0 + 751.0) / 2


def _raw(spark, late=None):
    from sensorium.sources import tables

    from .conftest import SF001
    return assign_batches(tables.raw_records(spark, SF001), 3, "offset", late)


def test_jobs_on_a_stream(spark):
    """The composed jobs run unchanged on a stream; finalised windows equal the batch
    job, in the incremental and the buffered form, and enrichment keeps every row."""
    from sensorium.plans import jobs
    from sensorium.sources import tables

    from .conftest import SF001
    raw = _raw(spark)
    final_wm = raw.agg(F.max(F.unix_millis("timestamp"))).first()[0] - 250
    rounded = lambda d: d.withColumn("s", F.round("sum_per_window", 6)).drop("sum_per_window")
    exp = rounded(jobs.windowing_job(raw.drop("batch")).filter(F.unix_millis("window_end") <= final_wm))
    for buffered in (False, True):
        got = rounded(run_replay(raw, lambda r, b=buffered: jobs.windowing_job(r, buffered=b)))
        assert got.count() == exp.count() > 0 and got.exceptAll(exp).count() == 0
    dim = tables.location_dimension(spark, SF001)
    e = run_replay(raw, lambda r: jobs.enriching_job(r, dim=dim))
    assert e.filter("location_info IS NOT NULL").count() == raw.count()


def test_lookup_and_lag_are_observed_per_micro_batch(spark, tmp_path):
    from sensorium.functions.decode import decode_measurements
    from sensorium.operators.enrich import enrich_lookup
    from sensorium.operators.metrics import observe_lag
    from sensorium.sources.replay import replay_stream
    from sensorium.streaming.windows import with_event_time

    raw = _raw(spark).drop("batch")
    raw.write.parquet(str(tmp_path / "in"))
    m = decode_measurements(with_event_time(replay_stream(spark, str(tmp_path / "in"), raw.schema)))
    a = enrich_lookup(m, lambda: str.lower, ttl_ms=3_600_000, flag="hit")
    a = observe_lag(a.observe("cache", F.sum(F.col("hit").cast("long")).alias("hits"), F.count(F.lit(1)).alias("n")), "lag")
    q = a.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    seen = [p["observedMetrics"] for p in q.recentProgress if "cache" in p.get("observedMetrics", {})]
    assert sum(o["cache"]["n"] for o in seen) == raw.count() == sum(o["lag"]["n"] for o in seen)
    assert 0 < sum(o["cache"]["hits"] for o in seen) < raw.count()
    assert all(o["lag"]["min_lag"] <= o["lag"]["p50"] <= o["lag"]["p99"] <= o["lag"]["max_lag"] for o in seen if o["lag"]["n"])


def test_timers_and_engines_release_the_same(spark):
    """Timers per event or rounded to 100 ms, and both stateful engines, differ only in when
    rows are released; each run restarts from its checkpoint after every batch."""
    from sensorium.streaming.sort_ema import _state_api_ready

    assert _state_api_ready(spark)
    raw = _raw(spark, {0: 1})
    outs = [run_replay(raw, lambda r, e=e, t=t: sort_correct_ema(r, {"NATION_7": 1.0}, 86_400_000, t, engine=e))
            for e, t in (("group_state", None), ("group_state", 100), ("state_api", 100))]
    first = sorted(map(tuple, outs[0].collect()))
    assert len(first) > 0 and all(sorted(map(tuple, o.collect())) == first for o in outs[1:])
