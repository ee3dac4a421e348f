"""Timestamps across the JVM/Python boundary.

PySpark hands ``TIMESTAMP`` values to pandas as wall-clock times in the
session time zone; comparing them with epoch-based watermarks, or sending
them back across a daylight-saving change, shifts or fails. Python-side
operators therefore see epoch microseconds (``BIGINT``) and the columns are
turned back into ``TIMESTAMP`` in the JVM.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def timestamps_as_micros(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """Replace every TIMESTAMP column by its epoch microseconds."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    if not cols:
        return df, cols
    return df.select(*[F.unix_micros(F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns]), cols


def micros_as_timestamps(df: DataFrame, cols) -> DataFrame:
    """Inverse of :func:`timestamps_as_micros` for the listed columns."""
    present = [c for c in cols if c in df.columns]
    if not present:
        return df
    return df.select(*[F.timestamp_micros(F.col(c)).alias(c) if c in present else F.col(c) for c in df.columns])
