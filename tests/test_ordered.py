"""Ordered per-key scans against a sequential fold, with a hot key spread
over many range partitions and groups straddling Arrow batches."""

import pytest
import numpy as np
from pyspark.sql import functions as F

from sensorium.operators import ordered
from sensorium.sources import tables

from .conftest import SF01

SF1 = "/root/testdata/sf0.1"


def _skewed(spark, sf):
    """Measurements where sensor 7 holds a third of all rows."""
    m = tables.measurements(spark, sf)
    return m.withColumn("sensor_id", F.when(F.pmod("event_id", F.lit(3)) == 0, F.lit(7))
                        .otherwise(F.col("sensor_id")))


def _sequential(pdf, key, fold):
    out = {}
    for k, g in pdf.sort_values([key, "ts", "event_id"]).groupby(key, sort=False):
        out.update(fold(g))
    return out


def _ema_fold(g):
    res, avg = {}, None
    for eid, v in zip(g["event_id"], g["value"]):
        if avg is None:
            avg = v
        else:
            avg = (avg + v) / 2.0
            res[eid] = avg
    return res


def _ttl_fold(ttl_us):
    def fold(g):
        res, s = {}, None
        for eid, t in zip(g["event_id"], g["ts"].astype("datetime64[us]").astype("int64")):
            if s is None or t - s > ttl_us:
                s = t
                res[eid] = False
            else:
                res[eid] = True
        return res
    return fold


@pytest.mark.parametrize("sf,parts", [(SF01, 16), (SF1, 16)])
def test_moving_average_hot_key_exact(spark, sf, parts):
    df = _skewed(spark, sf)
    got = ordered.moving_average(df, key="sensor_id", keep=("event_id",), num_partitions=parts)
    got = {r["event_id"]: r["ema"] for r in got.select("event_id", "ema").collect()}
    exp = _sequential(df.select("sensor_id", "ts", "event_id", "value").toPandas(), "sensor_id", _ema_fold)
    assert got.keys() == exp.keys()
    bad = [k for k in exp if got[k] != exp[k]]
    assert not bad, f"{len(bad)} differ, e.g. {bad[:3]}"


def test_ttl_hits_hot_key_exact(spark):
    df = _skewed(spark, SF01)
    ttl_ms = 3_600_000
    got = ordered.ttl_cache_hits(df, key="sensor_id", ttl_ms=ttl_ms, num_partitions=16)
    got = {r["event_id"]: r["served_from_cache"] for r in got.collect()}
    exp = _sequential(df.select("sensor_id", "ts", "event_id").toPandas(), "sensor_id", _ttl_fold(ttl_ms * 1000))
    assert got == exp


def test_positions_hot_key_exact(spark):
    df = _skewed(spark, SF01)
    got = ordered.sorted_positions(df, key="sensor_id", num_partitions=16)
    got = {r["event_id"]: r["pos"] for r in got.collect()}
    pdf = df.select("sensor_id", "ts", "event_id").toPandas().sort_values(["sensor_id", "ts", "event_id"])
    pdf["pos"] = pdf.groupby("sensor_id").cumcount() + 1
    assert got == dict(zip(pdf["event_id"], pdf["pos"]))


def test_groups_straddle_arrow_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = _skewed(spark, "/root/testdata/sf0.001")
        got = ordered.moving_average(df, key="sensor_id", keep=("event_id",), num_partitions=5)
        got = {r["event_id"]: r["ema"] for r in got.select("event_id", "ema").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    exp = _sequential(df.select("sensor_id", "ts", "event_id", "value").toPandas(), "sensor_id", _ema_fold)
    assert got == exp


def test_first_row_only_seeds_and_single_row_key(spark):
    from datetime import datetime
    rows = [(1, datetime(2024, 1, 1, 0, 0, s), s, float(s)) for s in range(3)] + [(2, datetime(2024, 1, 1), 9, 5.0)]
    df = spark.createDataFrame(rows, "sensor_id int, ts timestamp, event_id long, value double")
    got = ordered.moving_average(df, keep=("event_id",)).orderBy("event_id").collect()
    assert [(r.sensor_id, r.event_id, r.ema) for r in got] == [(1, 1, 0.5), (1, 2, 1.25)]


def test_equal_times_keep_arrival_order(spark):
    from datetime import datetime
    t = datetime(2024, 1, 1)
    rows = [(1, t, 2, 4.0), (1, t, 1, 0.0), (1, t, 3, 8.0)]
    df = spark.createDataFrame(rows, "sensor_id int, ts timestamp, event_id long, value double")
    got = [r.ema for r in ordered.moving_average(df, keep=("event_id",)).orderBy("event_id").collect()]
    assert got == [2.0, 5.0]  # 0 -> (0+4)/2 -> (2+8)/2


def test_empty_input(spark):
    df = spark.createDataFrame([], "sensor_id int, ts timestamp, event_id long, value double")
    assert ordered.moving_average(df).count() == 0


def test_local_pass_has_one_exchange(spark):
    """Sort -> fold runs behind exactly one (range) exchange."""
    df = tables.measurements(spark, SF01)
    srt = df.select("sensor_id", "ts", "event_id", "value").orderBy("sensor_id", "ts", "event_id")
    plan = srt._jdf.queryExecution().executedPlan().toString()
    shuffles = [ln for ln in plan.splitlines() if "Exchange" in ln and "BroadcastExchange" not in ln]
    assert len(shuffles) == 1 and "rangepartitioning" in shuffles[0]


def test_nan_value_makes_the_average_nan(spark):
    from datetime import datetime, timedelta
    t = datetime(2024, 1, 1)
    vals = [1.0, 3.0, float("nan"), 5.0]
    rows = [(1, t + timedelta(seconds=i), i, v) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "sensor_id int, ts timestamp, event_id long, value double")
    got = [r.ema for r in ordered.moving_average(df, keep=("event_id",)).orderBy("event_id").collect()]
    assert got[0] == 2.0 and all(np.isnan(g) for g in got[1:])


def test_ttl_hot_key_dense_many_partitions(spark):
    """A hot key with rows 1 ms apart and a 50 ms TTL over many partitions:
    the partitions' fetch sequences merge, so no fallback is needed, and the
    result equals the sequential fold."""
    from datetime import datetime
    n = 20000
    base = spark.range(n).select(
        F.when(F.col("id") % 5 == 0, F.lit("b")).otherwise(F.lit("a")).alias("location"),
        F.timestamp_micros(F.lit(1_704_067_200_000_000) + F.col("id") * 1000 + (F.col("id") * 7919) % 1000)
        .alias("ts"), F.col("id").alias("event_id"))
    got = ordered.ttl_cache_hits(base, key="location", ttl_ms=50, num_partitions=12)
    got = {r["event_id"]: r["served_from_cache"] for r in got.collect()}
    exp = _sequential(base.toPandas(), "location", _ttl_fold(50_000))
    assert got == exp and datetime  # noqa: B018


def _jobs(spark, run):
    import uuid
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "count")
    run()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def _dense(spark, n, jitter):
    """One hot location, 1 ms apart (regular or not), and a second one with a NaN value."""
    us = F.lit(1_704_067_200_000_000) + F.col("id") * 1000 + (F.pmod(F.col("id") * 7919, F.lit(1000)) if jitter else F.lit(0))
    value = F.when(F.col("id") == 77, F.lit(float("nan"))).otherwise(F.pmod(F.col("id") * 31, F.lit(101)).cast("double"))
    return spark.range(n).select(F.when(F.col("id") % 50 == 27, F.lit("b")).otherwise(F.lit("a")).alias("location"),
                                 F.timestamp_micros(us).alias("ts"), F.col("id").alias("event_id"), value.alias("value"))


@pytest.mark.parametrize("jitter", [False, True])
def test_dense_hot_key_needs_no_more_jobs_with_more_partitions(spark, jitter):
    df = _dense(spark, 12_000, jitter).cache()
    pdf = df.toPandas()
    counts = set()
    for ttl in (50, 1000, 60_000):
        exp = _sequential(pdf, "location", _ttl_fold(ttl * 1000))
        for parts in (3, 12):
            got = {}
            counts.add(_jobs(spark, lambda t=ttl, p=parts, g=got: g.update(
                {r.event_id: r.served_from_cache for r in ordered.ttl_cache_hits(df, ttl_ms=t, num_partitions=p).collect()})))
            assert got == exp
    for parts in (3, 12):
        got = {}
        counts.add(_jobs(spark, lambda p=parts, g=got: g.update(
            {r.event_id: r.ema for r in ordered.moving_average(df, key="location", alpha=0.005, keep=("event_id",), num_partitions=p).collect()})))
        for k, d in pdf.sort_values(["location", "ts", "event_id"]).groupby("location"):
            v = d["value"].to_numpy()
            want = d["value"].ewm(alpha=0.005, adjust=False).mean().to_numpy()
            want = np.where(np.maximum.accumulate(np.isnan(v)), np.nan, want)
            assert np.array_equal([got[i] for i in d["event_id"].to_numpy()[1:]], want[1:], equal_nan=True)
    assert len(counts) == 1
    df.unpersist()


def test_infinite_and_nan_carries(spark):
    rows = [(1, i, v) for i, v in enumerate([1.0, float("inf"), 2.0, 3.0, float("-inf"), 4.0, 5.0, 6.0])]
    rows += [(2, 100 + i, v) for i, v in enumerate([1.0, float("inf"), 2.0, 3.0, 4.0, 5.0])] + [(3, 200 + i, v) for i, v in enumerate([float("nan"), 1.0, 2.0, 3.0])]
    df = spark.createDataFrame(rows, "sensor_id int, us long, value double").select("sensor_id", F.timestamp_micros("us").alias("ts"), F.col("us").alias("event_id"), "value")
    want = {r.event_id: r.ema for r in ordered.moving_average(df, keep=("event_id",), num_partitions=1).collect()}
    got = {r.event_id: r.ema for r in ordered.moving_average(df, keep=("event_id",), num_partitions=9).collect()}
    assert got.keys() == want.keys() and np.array_equal([got[k] for k in want], list(want.values()), equal_nan=True)


def test_many_tiny_partitions_resolve_exactly(spark):
    """Partitions of ~50 rows: most keys span several partitions whose runs are too
    short to forget a carry, so their values are composed."""
    df = tables.measurements(spark, SF01)
    got = ordered.moving_average(df, key="sensor_id", keep=("event_id",), num_partitions=60)
    got = {r["event_id"]: r["ema"] for r in got.select("event_id", "ema").collect()}
    exp = _sequential(df.select("sensor_id", "ts", "event_id", "value").toPandas(), "sensor_id", _ema_fold)
    assert got == exp
