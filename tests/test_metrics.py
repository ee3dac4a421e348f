"""Lag summaries over every row, against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorium.operators import metrics
from sensorium.sources import tables

from .conftest import SF01


@pytest.mark.parametrize("bin_ms", [metrics.BIN_MS, 3_600_000_000, 1])
def test_lag_stats_cover_every_row(spark, monkeypatch, bin_ms):
    monkeypatch.setattr(metrics, "BIN_MS", bin_ms)
    m = tables.measurements(spark, SF01).withColumn("location", F.when(F.col("location") != "NATION_3", F.col("location")))
    now = metrics.clock_after_max(m, "ts", 3_600_000)
    got = {r.location: tuple(r)[1:] for r in metrics.lag_stats(m, "location", "ts", now).collect()}
    pdf = m.select("location", (now - F.unix_millis("ts")).alias("lag")).toPandas()
    groups = dict(list(pdf.assign(location=pdf["location"].fillna("none")).groupby("location")))
    assert len(got) == len(groups)
    for k, d in groups.items():
        lag = d["lag"].to_numpy()
        want = (len(lag), lag.min(), lag.max(), lag.mean(), lag.std(), np.quantile(lag, 0.5), np.quantile(lag, 0.99))
        assert got[None if k == "none" else k] == pytest.approx(want, abs=2e-3)


def test_lag_of_nothing_and_of_one_row(spark):
    from datetime import datetime
    df = spark.createDataFrame([("a", datetime(2024, 1, 1))], "k string, ts timestamp")
    assert [tuple(r) for r in metrics.lag_stats(df, "k", "ts", F.unix_millis("ts") + 5).collect()] == [("a", 1, 5, 5, 5.0, 0.0, 5.0, 5.0)]
    assert metrics.lag_stats(df.limit(0), "k", "ts", F.lit(0)).count() == 0


def test_location_list_from_text(spark, tmp_path):
    names = tables.location_list(spark, "/root/testdata/sf0.001")
    path = str(tmp_path / "cities")
    names.coalesce(1).write.text(path)
    back = tables.location_list_from_text(spark, path)
    assert sorted(r.location for r in back.collect()) == sorted(r.location for r in names.collect())
