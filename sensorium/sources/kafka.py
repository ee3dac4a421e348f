"""Kafka source/sink wiring and the record (de)serialisation around it.

The Kafka connector jar is not part of this environment, so the live
source and sink are built here but only their option maps are tested.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import JSON_FIELDS


def kafka_source_options(bootstrap: str = "localhost:9092", topic: str = "sensor-measurements",
                         group: str | None = None, starting: str = "latest") -> dict[str, str]:
    """Options of a Kafka stream that starts at the latest offset. Spark keeps the offsets
    itself; streams that share a ``group`` id may each read only part of the topic."""
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic, "startingOffsets": starting}
    if group:
        opts["kafka.group.id"] = group
    return opts


def read_kafka(spark: SparkSession, **kw) -> DataFrame:
    """Unbounded Kafka stream (default trigger = runs until stopped)."""
    return spark.readStream.format("kafka").options(**kafka_source_options(**kw)).load()


def raw_records(kafka_df: DataFrame) -> DataFrame:
    """The record fields the jobs use: time, key, value, partition (+offset
    as the arrival-order tie-break); topic and headers are dropped."""
    return kafka_df.select("timestamp", "key", "value", "partition", "offset")


def measurement_json(df: DataFrame, sensor_id="sensor_id", value="value", location="location",
                     info="measurement_information"):
    """JSON text of a measurement with the bean field names; nulls written."""
    s = F.struct(F.col(sensor_id).alias(JSON_FIELDS[0]), F.col(value).alias(JSON_FIELDS[1]),
                 F.col(location).alias(JSON_FIELDS[2]), F.col(info).alias(JSON_FIELDS[3]))
    return F.to_json(s, {"ignoreNullFields": "false"})


def serialize_measurements(df: DataFrame, topic: str | None = None) -> DataFrame:
    """Producer records: null key, JSON bytes as value (the broker stamps the
    timestamp; the partition is left to the producer)."""
    cols = [F.lit(None).cast("binary").alias("key"), measurement_json(df).cast("binary").alias("value")]
    if topic is not None:
        cols.append(F.lit(topic).alias("topic"))
    return df.select(*cols)


def kafka_sink_options(bootstrap: str = "localhost:9092", topic: str = "sensor-measurements",
                       checkpoint: str | None = None) -> dict[str, str]:
    opts = {"kafka.bootstrap.servers": bootstrap, "topic": topic,
            "kafka.transaction.timeout.ms": "600000"}
    if checkpoint:
        opts["checkpointLocation"] = checkpoint
    return opts


def write_kafka(df: DataFrame, checkpoint: str, **kw):
    """At-least-once Kafka sink (Spark's Kafka sink guarantee)."""
    return serialize_measurements(df).writeStream.format("kafka").options(
        **kafka_sink_options(checkpoint=checkpoint, **kw)).start()


def discard(df: DataFrame):
    """Discarding sink (batch): runs the whole plan, keeps nothing."""
    df.write.format("noop").mode("overwrite").save()


def discard_stream(df: DataFrame, checkpoint: str, **trigger):
    return df.writeStream.format("noop").option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
