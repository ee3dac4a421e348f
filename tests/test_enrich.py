"""Enrichment keeps every row; the lookup path agrees with the join; the
TTL cache counters add up."""

import pytest
from pyspark.sql import functions as F

from sensorium.functions.correct import apply_corrections
from sensorium.operators import enrich, ordered
from sensorium.sources import tables

from .conftest import SF001


def test_join_keeps_rows_and_is_broadcast(spark):
    m = tables.measurements(spark, SF001)
    e = enrich.enrich_join(m, tables.location_dimension(spark, SF001))
    assert e.count() == m.count()
    assert e.filter(F.col("location_info").isNull()).count() == 0
    assert "BroadcastHashJoin" in e._jdf.queryExecution().executedPlan().toString()


def test_a_key_with_several_dimension_rows_is_an_error(spark):
    m = tables.measurements(spark, SF001)
    dim = tables.location_dimension(spark, SF001)
    with pytest.raises(Exception, match="several rows for location"):
        enrich.enrich_join(m, dim.union(dim)).collect()
    deltas = spark.createDataFrame([("NATION_7", 1.0), ("NATION_7", 2.0)], "location string, delta double")
    with pytest.raises(Exception, match="several rows for location"):
        apply_corrections(m, deltas).collect()


def test_lookup_equals_join(spark):
    m = tables.measurements(spark, SF001).select("event_id", "location")
    dim = tables.location_dimension(spark, SF001)
    known = {r.location: r.location_info for r in dim.collect()}
    a = enrich.enrich_join(m, dim)
    b = enrich.enrich_lookup(m, lambda: known.get, capacity=4)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_clients_in_turn_never_see_each_other(spark):
    m = tables.measurements(spark, SF001).select("event_id", "location").coalesce(1)
    for i in range(25):
        got = enrich.enrich_lookup(m, lambda i=i: (lambda k: f"{k}-{i}"), ttl_ms=3_600_000)
        assert got.filter(F.col("location_info") != F.concat("location", F.lit(f"-{i}"))).count() == 0


def test_hits_go_out_before_misses_and_expired_entries_leave(monkeypatch):
    import threading

    import pandas as pd

    gate, asked, clock = threading.Event(), [], [0]
    monkeypatch.setattr(enrich, "_now_ms", lambda: clock[0])

    def client(k):
        asked.append(k)
        if k == "slow":
            assert gate.wait(20)
        return k.upper()
    batches = iter([pd.DataFrame({"k": ["a", "a"]}), pd.DataFrame({"k": ["slow", "a"]}), pd.DataFrame({"k": ["a"]})])
    out = enrich._lookup_batches(batches, lambda: client, "k", "info", 1000, 4, None, "hit")
    assert next(out)["hit"].tolist() == [False, True]
    assert next(out)["k"].tolist() == ["a"]  # while "slow" is still being looked up
    gate.set()
    assert next(out)["info"].tolist() == ["SLOW"]
    clock[0] = 1001
    assert next(out)["hit"].tolist() == [False] and asked == ["a", "slow", "a"]


def _frames(*batches):
    import pandas as pd
    return iter([pd.DataFrame({"k": b, "n": range(len(b))}) for b in batches])


def test_a_slow_key_does_not_hold_later_batches():
    import threading

    gate, asked = threading.Event(), []

    def client(k):
        asked.append(k)
        if k == "slow":
            assert gate.wait(20)
        return k.upper()
    out = enrich._lookup_batches(_frames(["slow", "a"], ["a", "slow", None], ["b", "a"]), lambda: client, "k", "info", 10_000, 4, None, "hit")
    seen = [next(out) for _ in range(4)]
    assert [f["k"].tolist() for f in seen] == [["a"], ["a", None], ["a"], ["b"]]
    assert seen[1]["info"].tolist() == ["A", None] and seen[1]["hit"].tolist() == [True, False]
    gate.set()
    rest = list(out)
    assert [f["info"].tolist() for f in rest] == [["SLOW", "SLOW"]] and rest[0]["hit"].tolist() == [False, True]
    assert asked == ["slow", "a", "b"]


def test_waiting_rows_are_bounded():
    import threading

    gate = threading.Event()
    timer = threading.Timer(0.3, gate.set)
    timer.start()
    out = enrich._lookup_batches(_frames(["slow"] * 5, ["slow"] * 5, ["x"]), lambda: lambda k: gate.wait(20) and k, "k", "info", 10_000, 2, None, None, "raise", 6)
    assert len(next(out)) == 10 and gate.is_set()  # the third batch isn't read before
    assert sum(len(f) for f in out) == 1


def test_failing_and_overdue_lookups():
    import time

    def client(k):
        if k == "bad":
            raise ValueError("no such place")
        if k == "slow":
            time.sleep(1.5)
        return k.upper()
    run = lambda rule: enrich._lookup_batches(_frames(["bad", "a", "slow"], ["bad", "a"]), lambda: client, "k", "info", 10_000, 4, 0.4, None, rule)
    import pandas as pd
    got = pd.concat(list(run("null")))
    assert sorted(zip(got["k"], got["info"], strict=True), key=str) == [("a", "A"), ("a", "A"), ("bad", None), ("bad", None), ("slow", None)]
    with pytest.raises(ValueError, match="no such place"):
        list(run("raise"))


def test_null_and_failing_keys_in_a_job(spark):
    def factory():
        def client(k):
            if k == "b":
                raise KeyError(k)
            return k * 2
        return client
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b"), (4, "a")], "event_id long, location string")
    got = {r.event_id: r.location_info for r in enrich.enrich_lookup(df, factory, on_error="null").collect()}
    assert got == {1: "aa", 2: None, 3: None, 4: "aa"}
    assert enrich.enrich_lookup(df.filter("event_id <> 3"), factory).filter("location_info is null").count() == 1
    with pytest.raises(Exception, match="KeyError"):
        enrich.enrich_lookup(df, factory).collect()
    assert enrich.enrich_lookup(df.limit(0), factory).count() == 0


def test_ttl_stats_add_up(spark):
    m = tables.measurements(spark, SF001)
    h = ordered.ttl_cache_hits(m, key="location", ttl_ms=3_600_000)
    st = ordered.ttl_cache_stats(h).agg(F.sum("served_from_cache"), F.sum("lookups"), F.sum("cache_size")).first()
    assert st[2] == m.select("location").distinct().count()
    assert st[0] + st[1] == m.count()
    # every location's first row is a lookup
    assert st[1] >= m.select("location").distinct().count()


def test_ttl_boundary_is_inclusive(spark):
    from datetime import datetime, timedelta
    t = datetime(2024, 1, 1)
    rows = [("a", t, 1), ("a", t + timedelta(seconds=1), 2), ("a", t + timedelta(seconds=1, microseconds=1), 3),
            ("a", t + timedelta(seconds=2), 4)]
    df = spark.createDataFrame(rows, "location string, ts timestamp, event_id long")
    got = {r.event_id: r.served_from_cache for r in ordered.ttl_cache_hits(df, ttl_ms=1000).collect()}
    assert got == {1: False, 2: True, 3: False, 4: True}
