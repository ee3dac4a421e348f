"""Streams whose keys share state rows: the calls are bounded, the results those of keys on their own."""

from datetime import datetime, timedelta

import numpy as np
import pytest

from sensorium.operators import process
from sensorium.operators.ordered import Kernel, MovingAverage, Position, TtlRefresh
from sensorium.sources.replay import run_replay
from sensorium.streaming import shards
from sensorium.streaming.hot_keys import HotKeyFold
from sensorium.streaming.sort_ema import sort_correct_ema

T0 = datetime(2024, 1, 1)


def _raw(spark):
    """60 sensors, ten records each, some late or repeated."""
    rows = []
    for i in range(600):
        js = f'{{"sensorId": {i * 7 % 60}, "value": {float(i % 13)}, "location": "L", "measurementInformation": "i"}}'
        rows.append((T0 + timedelta(milliseconds=i * 20), None, bytearray(js.encode()), 0, i - i % 9 // 8, min(2, i * 3 // 600 + (i % 37 == 0))))
    return spark.createDataFrame(rows, "timestamp timestamp, key binary, value binary, partition int, offset long, batch int").coalesce(1)


def _measured(raw):
    from sensorium.functions.decode import decode_measurements
    return decode_measurements(raw.withWatermark("timestamp", "2 seconds"), keep=("offset",)).withColumnRenamed("offset", "event_id")


BUILDS = {
    "sort": lambda raw: sort_correct_ema(raw, None, 2_000, 100),
    "sessions": lambda raw: process.keyed_process_stream(_measured(raw), process.Sessions(1_000), "sensor_id"),
    "hot": lambda raw: HotKeyFold(MovingAverage(), bucket_ms=500).release(_measured(raw)).drop("_held", "_map"),
}


@pytest.mark.parametrize("kind", list(BUILDS))
def test_state_rows_are_bounded(spark, monkeypatch, kind):
    found = []
    for n in (2, 100_000):  # two state rows for all keys, and about one for each
        monkeypatch.setattr(shards, "SHARDS", n)
        progress: list = []
        out = run_replay(_raw(spark), BUILDS[kind], progress=progress)
        found.append(sorted(map(repr, out.collect())))
        held = max(p["stateOperators"][0]["numRowsTotal"] for p in progress)
        assert held <= 2 if n == 2 else held > 50
    assert found[0] == found[1] and len(found[0]) > 50


@pytest.mark.parametrize("kernel", [MovingAverage(), MovingAverage(alpha=0.01), Position(), TtlRefresh("value", 40)])
def test_runs_are_folded_as_one_by_one(kernel):
    rng = np.random.default_rng(3)
    whole = isinstance(kernel, TtlRefresh)
    for n, m, odd in ((1, 1, False), (3000, 900, False), (3000, 3, False), (500, 90, True)):
        v = np.sort(rng.integers(0, 9_000, n)) if whole else rng.normal(size=n).round(2)
        if odd and not whole:
            v[rng.choice(n, 9, replace=False)] = [np.inf, -np.inf, np.nan] * 3
        starts = np.unique(np.append(0, rng.choice(n, m, replace=False)))
        carried = rng.random(len(starts)) < 0.5
        carries = (rng.normal(size=len(starts)) * 50).round().astype(v.dtype)
        cols = {"value": v}
        states, outs = kernel.fold_runs(cols, starts, carries, carried, n)
        for a, b, c, told in zip(starts, np.append(starts[1:], n), carries, carried, strict=True):
            st, o = kernel.fold({"value": v[a:b]}, np.array([0]), c if told else None, int(b - a))
            assert np.array_equal(states[a:b], st, equal_nan=not whole) and all(np.array_equal(outs[k][a:b], o[k]) for k in o)
        fresh, _ = kernel.fold(cols, starts, None, n)
        got, want = kernel.maps(cols, starts, fresh), Kernel.maps(kernel, cols, starts, fresh)
        assert list(map(repr, got)) == list(map(repr, want))
        if whole:  # its maps take carries of the order's own times only
            continue
        for carry_map, a, b, c in zip(got, starts, np.append(starts[1:], n), carries, strict=True):
            st, _ = kernel.fold({"value": v[a:b]}, np.array([0]), c, int(b - a))
            assert repr(float(kernel.apply(carry_map, c.item()))) == repr(float(st[-1]))
