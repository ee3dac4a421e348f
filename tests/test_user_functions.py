"""User aggregates, ordered folds and process functions against plain Python, with a hot key over many partitions."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorium.operators import folds, process
from sensorium.sources.replay import run_replay

T0 = datetime(2024, 1, 1)
SCHEMA = "k int, event_id long, ts timestamp, value double"


def _ms(t):
    return (t - T0) // timedelta(milliseconds=1)


def _rows(n=1200, seed=2):
    rng = np.random.default_rng(seed)
    keys = np.where(rng.random(n) < 0.4, 7, rng.integers(0, 5, n))  # one key holds most
    out = [(None if k == 4 else int(k), i, T0 + timedelta(milliseconds=int(t) // 50 * 50), float(rng.normal()))
           for i, (k, t) in enumerate(zip(keys, rng.integers(0, 60_000, n), strict=True))]
    return out + [(1, n, None, 1.0)]


def _windows(rows, size, slide):
    out = {}
    for r in sorted((r for r in rows if r[2] is not None), key=lambda r: (r[2], r[1])):
        ms = _ms(r[2])
        start = ms // slide * slide
        while start > ms - size:
            if ms < start + size:
                out.setdefault((start, r[0]), []).append(r)
            start -= slide
    return out


def _got(df):
    return {(_ms(r[0]), r[2]): tuple(r[3:]) for r in df.collect()}


class Text(folds.RowAccumulator):
    """Row by row, order-dependent, with a text state: the last digits of the tie, in order."""

    state = output = "s string"

    def create(self):
        return ("",)

    def step(self, state, row):
        return (state[0] + str(row["tie"] % 10),)

    def merge(self, first, second):
        return (first[0] + second[0],)


@pytest.mark.parametrize("size,slide", [(10, 2), (6, 4), (5, 5), (2, 3)])
def test_windows(spark, size, slide):
    rows = _rows()
    df = spark.createDataFrame(rows, SCHEMA)
    want = _windows(rows, size * 1000, slide * 1000)
    fold = _got(folds.fold_windows(df, Text(), size, slide, "k", tie="event_id", num_partitions=23))
    assert fold == {w: ("".join(str(r[1] % 10) for r in part),) for w, part in want.items()}
    got = _got(folds.aggregate_windows(df.repartition(7), folds.Extremes(), size, slide, "k", tie="event_id"))
    assert got == {w: (len(p), min(r[3] for r in p), max(r[3] for r in p), p[0][3]) for w, p in want.items()}


def test_fold_over_batches_and_flushes(spark, monkeypatch):
    rows = _rows()
    df = spark.createDataFrame(rows, SCHEMA)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        fold = _got(folds.fold_windows(df, folds.Variation(), 10, 2, "k", tie="event_id", num_partitions=5))
        got = _got(folds.aggregate_windows(df, folds.Extremes(), 10, 2, "k", tie="event_id"))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    for w, part in _windows(rows, 10_000, 2_000).items():
        v = [r[3] for r in part]
        n, rises, path, first, last = fold[w]
        assert (n, rises, first, last) == (len(v), sum(b > a for a, b in zip(v, v[1:])), v[0], v[-1])
        assert path == pytest.approx(sum(abs(b - a) for a, b in zip(v, v[1:])))
        assert got[w] == (len(v), min(v), max(v), v[0])
    assert folds.fold_windows(df.limit(0), folds.Variation(), 10, 2, "k").count() == 0


def test_hot_key_is_spread(spark):
    """The sort of a fold splits a key, and only states are shuffled by window."""
    df = spark.createDataFrame(_rows(), SCHEMA).filter("k = 7").repartition(4)
    rows = df.repartitionByRange(8, "k", "ts", "event_id")
    assert rows.select(F.spark_partition_id()).distinct().count() > 4
    plan = folds.fold_windows(df, folds.Variation(), 10, 2, "k", tie="event_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Exchange rangepartitioning") == 1


def _sessions(rows, gap, until=None):
    out = []
    for key in {r[0] for r in rows}:
        part = sorted((r for r in rows if r[0] == key and r[2] is not None), key=lambda r: (r[2], r[1]))
        open_ = []
        for r in part:
            if open_ and _ms(r[2]) - _ms(open_[-1][2]) > gap:
                out.append((key, open_))
                open_ = []
            open_.append(r)
        if open_ and (until is None or _ms(open_[-1][2]) + gap < until):
            out.append((key, open_))
    return sorted(((k, _ms(p[0][2]), _ms(p[-1][2]), len(p)) for k, p in out), key=str)


def _session_rows(df):
    us = lambda x: (x - int((T0 - datetime(1970, 1, 1)).total_seconds()) * 1_000_000) // 1000
    return sorted(((r.k, us(r.start_us), us(r.end_us), r.n) for r in df.collect()), key=str)


@pytest.mark.parametrize("horizon", [None, 150, 400])
def test_sessions_on_a_table(spark, horizon):
    rows = _rows()
    got = _session_rows(process.keyed_process(spark.createDataFrame(rows, SCHEMA).repartition(5), process.Sessions(150), "k", horizon_ms=horizon))
    assert got == _sessions(rows, 150) and len(got) > 50


def test_hot_key_is_cut_at_pauses(spark):
    rows = spark.createDataFrame(_rows(), SCHEMA).filter("k = 7").select(*folds.key_columns(F.col("k")), F.unix_micros("ts").alias("us"))
    assert process._segments(rows, 150).select("_segment").distinct().count() > 50


class Alarm(process.KeyedProcess):
    """Counts rows until a timer of the first one; sets a second timer from the first."""

    output = "at long, n long"

    def on_row(self, ctx, row):
        if ctx.state is None:
            ctx.state = 0
            ctx.register_timer(ctx.time_ms + 1000)
            ctx.register_timer(ctx.time_ms + 1000)
        ctx.state += 1

    def on_timer(self, ctx, ms):
        ctx.emit(ms, ctx.state)
        if ctx.state > 0:
            ctx.state = 0
            ctx.register_timer(ms + 500)
        else:
            ctx.state = None


class Beyond(Alarm):
    def on_row(self, ctx, row):
        ctx.register_timer(ctx.time_ms + 10_000)


def test_timers_and_horizon(spark):
    base = int((T0 - datetime(1970, 1, 1)).total_seconds()) * 1000
    rows = [(1, i, T0 + timedelta(milliseconds=t), 0.0) for i, t in enumerate((0, 400, 1000, 1001, 1400, 5000))]
    df = spark.createDataFrame(rows, SCHEMA)
    got = [(r.at - base, r.n) for r in process.keyed_process(df, Alarm(), "k").orderBy("at").collect()]
    assert got == [(1000, 3), (1500, 2), (2000, 0), (6000, 1)]  # at the end only pending timers fire
    with pytest.raises(Exception, match="horizon"):
        process.keyed_process(df, Beyond(), "k", horizon_ms=100).collect()


def test_sessions_on_a_stream(spark):
    rows = [r for r in _rows(500) if r[2] is not None]
    rows.sort(key=lambda r: (r[2], r[1]))
    n = len(rows)
    data = [(*r, min(2, i * 3 // n + (1 if i % 31 == 0 else 0))) for i, r in enumerate(rows)]
    out = run_replay(spark.createDataFrame(data, SCHEMA + ", batch int"),
                     lambda s: process.keyed_process_stream(s.withWatermark("ts", "2 seconds"), process.Sessions(150), "k"))
    kept, top = [], None
    for b in range(3):
        batch = [r for r in data if r[4] == b]
        kept += [r for r in batch if top is None or _ms(r[2]) >= top - 2000]
        top = max(_ms(r[2]) for r in batch) if top is None else max(top, *(_ms(r[2]) for r in batch))
    kept = [r for r in kept if _ms(r[2]) < top - 2000]
    got = _session_rows(out)
    assert got == _sessions(kept, 150, top - 2000) and len(got) > 30
