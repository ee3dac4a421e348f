"""Two outputs of one stream, repeats after failures, watermarks per partition, lag over the latest samples, counters."""

import glob
import os
import shutil
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sensorium.functions import decode
from sensorium.sources import tables
from sensorium.sources.replay import assign_batches, replay_stream, run_replay
from sensorium.streaming import delivery, monitor
from sensorium.streaming.windows import sliding_stream

from .conftest import SF001

T0 = datetime(2024, 1, 1)


def _start(df, root, **more):
    w = df.writeStream.format("parquet").option("checkpointLocation", f"{root}/ck").trigger(availableNow=True)
    q = (w.partitionBy("kind") if more.get("split") else w).start(f"{root}/out")
    q.awaitTermination()
    return q


def test_split_output_after_a_failure_within_a_batch(spark, tmp_path):
    root, flag = str(tmp_path), str(tmp_path / "flag")
    raw = tables.malformed_records(spark, SF001).repartition(4, "offset")
    raw.write.parquet(f"{root}/in")
    open(flag, "w").close()

    def build():
        def fragile(batches):
            for k, b in enumerate(batches):
                yield b
                if os.path.exists(flag) and b.num_rows and b.column("offset")[0].as_py() % 2:
                    raise RuntimeError("the task is lost after its first rows")
        split = decode.split_records(replay_stream(spark, f"{root}/in", raw.schema), keep=("partition", "offset"))
        return split.mapInArrow(fragile, split.schema)

    with pytest.raises(Exception, match="task is lost"):
        _start(build(), root, split=True)
    os.remove(flag)
    _start(build(), root, split=True)
    got = [(r.kind, r.offset) for r in spark.read.parquet(f"{root}/out").collect()]
    want = [("dead_letter" if r.offset % 7 in (0, 1) else "measurement", r.offset) for r in raw.select("offset").collect()]
    assert sorted(got) == sorted(want)
    dead = spark.read.parquet(f"{root}/out").filter("kind = 'dead_letter'")
    assert dead.filter("raw IS NULL OR value IS NOT NULL").count() == 0
    assert sorted(r[0] for r in dead.select("offset").collect()) == sorted(r[0] for r in decode.dead_letters(raw).select("offset").collect())


def test_at_least_once_repeats_but_loses_nothing(spark, tmp_path):
    """A sink that forgets what it committed, as a broker does, gets a batch again when the query fails between write and commit."""
    root = str(tmp_path)
    raw = tables.raw_records(spark, SF001)
    n = raw.count()
    for k in range(3):
        raw.filter(F.col("offset") % 3 == k).coalesce(1).write.mode("append").parquet(f"{root}/in")
        _start(replay_stream(spark, f"{root}/in", raw.schema), root)
    os.remove(f"{root}/ck/commits/2")
    for f in glob.glob(f"{root}/ck/commits/.2.crc"):
        os.remove(f)
    shutil.rmtree(f"{root}/out/_spark_metadata")
    _start(replay_stream(spark, f"{root}/in", raw.schema), root)
    files = [f for f in glob.glob(f"{root}/out/*.parquet")]
    sunk = spark.read.parquet(*files)
    assert sunk.count() > n and sunk.select("offset").distinct().count() == n
    # a reader of the sink removes the repeats
    sunk.write.parquet(f"{root}/sunk")
    back = f"{root}/reader"
    _start(delivery.drop_redelivered(replay_stream(spark, f"{root}/sunk", raw.schema), 1000), back)
    assert sorted(r[0] for r in spark.read.parquet(f"{back}/out").select("offset").collect()) == sorted(r[0] for r in raw.select("offset").collect())


def test_partition_watermarks_keep_what_one_watermark_drops(spark):
    raw = assign_batches(tables.raw_records(spark, SF001), 4, "offset")
    raw = raw.withColumn("batch", F.when(F.col("partition") == 2, F.least(F.col("batch") + 2, F.lit(3))).otherwise(F.col("batch")))

    def mine(stream):
        from sensorium.operators.windows import sliding_count_sum
        return sliding_count_sum(decode.decode_measurements(delivery.with_partition_event_time(stream, [0, 1, 2], 60_000)), 3600, 3600)
    per = run_replay(raw, mine).agg(F.sum("events_per_window")).first()[0]
    one = run_replay(raw, lambda s: sliding_stream(s, 3600, 3600, 60_000)).agg(F.sum("events_per_window")).first()[0]
    top = raw.groupBy("partition").agg(F.max(F.unix_millis("timestamp")).alias("t")).agg(F.min("t")).first()[0] - 60_000
    closed = raw.filter(F.floor(F.unix_millis("timestamp") / 3_600_000) * 3_600_000 + 3_600_000 <= top).count()
    assert per == closed and one < 0.9 * closed
    spark.conf.set(delivery.POLICY, "max")
    try:
        with pytest.raises(ValueError, match="min"):
            delivery.with_partition_event_time(raw, [0])
    finally:
        spark.conf.unset(delivery.POLICY)


@pytest.mark.parametrize("held", [monitor.HELD, 40])
def test_latest_lag(spark, monkeypatch, held):
    monkeypatch.setattr(monitor, "HELD", held)
    rng = np.random.default_rng(6)
    rows = [("hot" if i % 3 else [None, "a", "b"][i % 9 // 3], i, T0 + timedelta(milliseconds=int(rng.integers(0, 5000))), i * 3 // 600) for i in range(600)]
    df = spark.createDataFrame(rows, "location string, event_id long, ts timestamp, batch int").repartition(3)
    now = int((T0 - datetime(1970, 1, 1)).total_seconds() * 1000) + 10_000
    out = run_replay(df, lambda s: monitor.latest_lag(s, "location", F.lit(now), samples=25))
    got = {r[0]: tuple(r[1:]) for r in monitor.current(out, "location").collect()}
    for key in ("hot", "a", "b", None):
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: (r[3], r[2], r[1]))[-25:]
        lag = pd.Series([10_000 - (r[2] - T0) // timedelta(milliseconds=1) for r in mine])
        assert got[key] == pytest.approx((len(lag), lag.min(), lag.max(), lag.mean(), lag.std(ddof=0), lag.median(), lag.quantile(0.99)))
    assert len(got) == 4 and out.filter("location = 'hot'").count() == 3


def test_counters_and_a_session_of_its_own(spark):
    raw = assign_batches(tables.malformed_records(spark, SF001), 2, "offset")
    progress, before = [], dict(spark.conf.getAll)
    seen = []

    def build(s):
        seen.append(dict(spark.conf.getAll))
        return decode.split_records(delivery.drop_redelivered(s, 1000), keep=("offset",), metrics="decode")
    run_replay(raw, build, partition_by="kind", progress=progress)
    assert all(s == before for s in seen)  # other streams of the session see no setting of the replay
    got = [tuple(r) for r in monitor.counters(spark, progress).filter("input_rows > 0").orderBy("batch_id").collect()]
    assert [r[0] for r in got] == [0, 1] and sum(r[1] for r in got) == raw.count() and all(r[2] == 0 for r in got)
    bad = raw.filter(F.col("offset") % 7 < 2).count()
    assert sum(r[3]["decode.n_records"] for r in got) == raw.count() and sum(r[3]["decode.n_bad"] for r in got) == bad
