"""Measurements derived from the driver's tables.

The test tables carry no sensor stream of their own, so a measurement view
is derived from ``events`` and ``nation`` (FIXTURES.md §3):

    sensor_id = user_id, location = nation name of user_id % 25,
    measurement_information = props, value = value, ts = ts (as UTC instant)

Fixed values of that fixture: 25 locations (nation keys 0-24), raw
partition = event_id % 3, malformed rows by event_id % 7 (0: cut to 10
bytes, 1: unknown field "x":1, 2: no "value" field).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timecols import instant_as_utc_ntz, ntz_as_utc_instant
from .kafka import measurement_json

N_LOCATIONS = 25
N_RAW_PARTITIONS = 3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def location_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All locations, one row each (the reference reads one per text line)."""
    return table(spark, sf_dir, "nation").select(F.col("n_name").alias("location"))


def location_list_from_text(spark: SparkSession, path: str) -> DataFrame:
    """The reference form: a text file, one whole line = one location."""
    return spark.read.text(path).withColumnRenamed("value", "location")


def location_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``location, location_info`` — one row per location."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (n.join(r, n.n_regionkey == r.r_regionkey)
            .select(F.col("n_name").alias("location"),
                    F.concat(F.col("n_name"), F.lit("/"), F.col("r_name")).alias("location_info")))


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id, sensor_id, value, location, measurement_information, ts``."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value", "props")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = e.join(n, F.pmod(e.user_id, F.lit(N_LOCATIONS)) == n.n_nationkey)
    return j.select(
        "event_id",
        F.col("user_id").cast("int").alias("sensor_id"),
        "value",
        F.col("n_name").alias("location"),
        F.col("props").alias("measurement_information"),
        ntz_as_utc_instant("ts", spark).alias("ts"),
    )


def raw_records_from(meas: DataFrame) -> DataFrame:
    """Kafka-shaped records carrying the measurement JSON as bytes."""
    return meas.select(
        F.col("ts").alias("timestamp"),
        F.lit(None).cast("binary").alias("key"),
        measurement_json(meas).cast("binary").alias("value"),
        F.pmod(F.col("event_id"), F.lit(N_RAW_PARTITIONS)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
    )


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_records_from(measurements(spark, sf_dir))


def malformed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records with three kinds of damage (see module docstring)."""
    m = measurements(spark, sf_dir)
    good = measurement_json(m)
    # '{"x":1,' + the good JSON without its opening brace
    extra = F.concat(F.lit('{"x":1,'), good.substr(F.lit(2), F.length(good)))
    no_value = F.to_json(F.struct(F.col("sensor_id").alias("sensorId"), F.col("location"),
                                  F.col("measurement_information").alias("measurementInformation")),
                         {"ignoreNullFields": "false"})
    kind = F.pmod(F.col("event_id"), F.lit(7))
    text = (F.when(kind == 0, F.substring(good, 1, 10))
            .when(kind == 1, extra)
            .when(kind == 2, no_value)
            .otherwise(good))
    return m.select(
        F.col("ts").alias("timestamp"),
        F.lit(None).cast("binary").alias("key"),
        text.cast("binary").alias("value"),
        F.pmod(F.col("event_id"), F.lit(N_RAW_PARTITIONS)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
    )


def to_oracle_ts(df: DataFrame, *cols: str) -> DataFrame:
    """Cast instants back to UTC wall-clock TIMESTAMP_NTZ for comparison."""
    spark = df.sparkSession
    for c in cols:
        df = df.withColumn(c, instant_as_utc_ntz(c, spark))
    return df
