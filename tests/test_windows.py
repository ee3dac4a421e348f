"""Sliding / tumbling / sampling windows against a brute-force count, and
the incremental and full-buffer variants against each other."""

import pytest
from pyspark.sql import functions as F

from sensorium.operators import windows
from sensorium.sources import tables

from .conftest import SF001


def _brute(pdf, size_s, slide_s):
    out = {}
    for loc, ts, v in zip(pdf["location"], pdf["ts"], pdf["value"]):
        us = int(ts.value // 1000)
        size, slide = size_s * 1_000_000, slide_s * 1_000_000
        last = us - us % slide
        start = last
        while start > us - size:
            if us < start + size:
                k = (start, loc)
                n, s = out.get(k, (0, 0.0))
                out[k] = (n + 1, s + v)
            start -= slide
    return out


@pytest.mark.parametrize("size_s,slide_s", [(60, 10), (60, 25), (60, 60), (60, 90), (3600, 600)])
def test_windows_match_brute_force(spark, size_s, slide_s):
    m = tables.measurements(spark, SF001)
    got = windows.sliding_count_sum(m, size_s, slide_s, strategy="direct").withColumn("us", F.unix_micros("window_start")).collect()
    got = {(r.us, r.location): (r.events_per_window, round(r.sum_per_window, 6)) for r in got}
    exp = {k: (n, round(s, 6)) for k, (n, s) in _brute(m.select("location", "ts", "value").toPandas(),
                                                         size_s, slide_s).items()}
    assert got == exp


@pytest.mark.parametrize("size_s,slide_s", [(60, 10), (60, 25), (3600, 600)])
def test_panes_match_brute_force(spark, size_s, slide_s):
    m = tables.measurements(spark, SF001)
    got = windows.sliding_count_sum(m, size_s, slide_s, strategy="panes") \
        .withColumn("us", F.unix_micros("window_start")).collect()
    got = {(r.us, r.location): (r.events_per_window, round(r.sum_per_window, 6)) for r in got}
    exp = {k: (n, round(s, 6)) for k, (n, s) in _brute(m.select("location", "ts", "value").toPandas(),
                                                         size_s, slide_s).items()}
    assert got == exp


def test_full_buffer_equals_incremental(spark):
    m = tables.measurements(spark, SF001)
    a = windows.sliding_count_sum(m, 3600, 600).withColumn("s", F.round("sum_per_window", 6)).drop("sum_per_window")
    b = (windows.sliding_full_buffer(m, 3600, 600, tie="event_id", num_partitions=7)
         .withColumn("s", F.round("sum_per_window", 6)).drop("sum_per_window"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_each_row_in_size_over_slide_windows(spark):
    m = tables.measurements(spark, SF001)
    w = windows.assign_windows(m, 60, 10)
    per_row = w.groupBy("event_id").count().select(F.min("count"), F.max("count")).first()
    assert tuple(per_row) == (6, 6)


def test_slide_greater_than_size_leaves_gaps(spark):
    m = tables.measurements(spark, SF001)
    w = windows.assign_windows(m, 60, 90)
    assert w.filter(F.unix_micros("ts") >= F.unix_micros("window_end")).count() == 0
    assert w.groupBy("event_id").count().filter("count > 1").count() == 0


@pytest.mark.parametrize("size_s,slide_s", [(60, 10), (60, 25), (3600, 600)])
def test_panes_equal_direct(spark, size_s, slide_s):
    m = tables.measurements(spark, "/root/testdata/sf0.01")
    r = lambda d: d.withColumn("s", F.round("sum_per_window", 6)).drop("sum_per_window")
    a = r(windows.sliding_count_sum(m, size_s, slide_s))
    b = r(windows.sliding_count_sum_panes(m, size_s, slide_s))
    a = r(windows.sliding_count_sum(m, size_s, slide_s, strategy="direct"))
    assert a.count() == b.count() and a.exceptAll(b).count() == 0


@pytest.mark.parametrize("strategy", ["direct", "panes"])
def test_windows_pre_aggregate_before_every_shuffle(spark, strategy):
    """Each hash exchange of the window aggregate is fed by a partial
    aggregate: a hot location ships one partial row per task, never rows."""
    m = tables.measurements(spark, SF001)
    plan = windows.sliding_count_sum(m, 60, 10, strategy=strategy)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    shuffles = [i for i, ln in enumerate(lines) if "Exchange hashpartitioning" in ln]
    assert shuffles
    for i in shuffles:
        assert "partial_" in lines[i + 1]
