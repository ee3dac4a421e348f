"""Records delivered more than once, and watermarks per source partition."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import OUT_OF_ORDERNESS_MS
from .windows import with_event_time

POLICY = "spark.sql.streaming.multipleWatermarkPolicy"


def drop_redelivered(raw: DataFrame, delay_ms: int = OUT_OF_ORDERNESS_MS, keys: Sequence[str] = ("partition", "offset")) -> DataFrame:
    """Raw records with repeats removed, for a source or sink that delivers at least once.

    A repeat has the same (partition, offset) and so the same time: it comes before the watermark passes that time
    by the delay, when state still knows the first, or after it, when it is late itself. State so holds the
    keys of a delay's records only, and is spread by key whatever the sensor. Sets the watermark.
    """
    return with_event_time(raw, delay_ms).dropDuplicatesWithinWatermark(list(keys))


def with_partition_event_time(raw: DataFrame, partitions: Sequence[int], delay_ms: int = OUT_OF_ORDERNESS_MS) -> DataFrame:
    """``raw`` with a watermark per source partition: event time is that of the slowest.

    One watermarked stream per partition and their union; Spark takes the least of several watermarks
    (setting ``spark.sql.streaming.multipleWatermarkPolicy``, checked here). A partition without
    any records yet holds event time back altogether, as there is no idle time-out. A file source is read once per partition with
    its filter pushed down; for Kafka read each partition by ``assign`` and union those streams in the same way.
    """
    if raw.sparkSession.conf.get(POLICY, "min") != "min":
        raise ValueError(f"{POLICY} has to be min")
    if not partitions:
        raise ValueError("no partitions")
    return reduce(DataFrame.union, [with_event_time(raw.filter(F.col("partition") == p), delay_ms) for p in partitions])
