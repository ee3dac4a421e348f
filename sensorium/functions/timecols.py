"""Time column helpers (event time in milliseconds / microseconds)."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_ms(ts) -> Column:
    """Epoch milliseconds of a TIMESTAMP, truncated (as Java's long millis)."""
    return F.unix_millis(_col(ts))


def _session_tz(spark: SparkSession) -> str:
    return spark.conf.get("spark.sql.session.timeZone", "UTC")


def ntz_as_utc_instant(ts, spark: SparkSession) -> Column:
    """Read a TIMESTAMP_NTZ wall-clock value as a UTC instant (TIMESTAMP)."""
    tz = _session_tz(spark)
    c = _col(ts)
    if tz in ("UTC", "Etc/UTC", "Z", "+00:00", "GMT"):
        return c.cast("timestamp")
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), c).cast("timestamp")


def instant_as_utc_ntz(ts, spark: SparkSession) -> Column:
    """Inverse of :func:`ntz_as_utc_instant`: a UTC wall-clock TIMESTAMP_NTZ."""
    tz = _session_tz(spark)
    c = _col(ts).cast("timestamp_ntz")
    if tz in ("UTC", "Etc/UTC", "Z", "+00:00", "GMT"):
        return c
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), c)
