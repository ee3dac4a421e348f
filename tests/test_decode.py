"""JSON decode rules on a literal table of edge cases."""

from datetime import datetime

from pyspark.sql import functions as F

from sensorium.functions.decode import dead_letter_counts, dead_letters, decode_measurements

T0 = datetime(2024, 1, 1)

CASES = [
    # (offset, json text or None, expected (sensor_id, value, location) or None for dropped)
    (1, '{"sensorId": 5, "value": 12.31, "location": "A", "measurementInformation": "x"}', (5, 12.31, "A")),
    (2, '{"sensorId": 5, "value": 1.5}', (5, 1.5, None)),                      # missing fields
    (3, '{"sensorId": null, "value": null, "location": null}', (0, 0.0, None)),  # JSON nulls
    (4, '{"sensorId": 5, "value": 1.0, "x": 1}', None),                        # unknown field
    (5, '{"sensorId": 5, "val', None),                                         # truncated
    (6, '', None),                                                             # empty bytes
    (7, '[1, 2]', None),                                                       # array at top
    (8, 'null', None),                                                         # literal null
    (9, None, None),                                                           # tombstone
    (10, '{"sensorId": "12", "value": "2.5"}', (12, 2.5, None)),               # numbers as strings
    (11, '{"sensorId": 1.7, "value": 3}', (1, 3.0, None)),                     # fraction for int
    (12, '{"sensorId": 1, "value": 1, "location": 7}', (1, 1.0, "7")),         # number for string
    (13, '{"sensorId": 1, "value": 1} trailing', (1, 1.0, None)),              # trailing text
    (14, '{"sensorId": 1, "value": NaN}', None),                               # NaN token
    (15, '{"sensorId": true, "value": 1}', None),                              # boolean for int
    (16, '{"sensorId": 1, "value": "abc"}', None),                             # bad number text
    (17, '{"sensorId": 99999999999, "value": 1}', None),                       # int overflow
    (18, '{"sensorId": 1, "value": 1, "location": {"a": 1}}', None),           # object for string
    (19, '{"sensorId": 1, "value": 1, "location": "{not json"}', (1, 1.0, "{not json")),
    (20, '{"sensorId": -3, "value": -0.0, "location": "B"}', (-3, -0.0, "B")),
    (21, '{"sensorId": "1.7", "value": 1}', None),                             # fraction as text for int
    (22, '{"sensorId": " 7 ", "value": "1e2"}', (7, 100.0, None)),             # padded int text, exponent
]


def _raw(spark):
    rows = [(T0, None if t is None else bytearray(t.encode()), 0, off) for off, t, _ in CASES]
    return spark.createDataFrame(rows, "timestamp timestamp, value binary, partition int, offset bigint")


def test_decode_rules(spark):
    got = {r["offset"]: (r["sensor_id"], r["value"], r["location"])
           for r in decode_measurements(_raw(spark), keep=("offset",)).collect()}
    expected = {off: exp for off, _, exp in CASES if exp is not None}
    assert got == expected


def test_dead_letters_are_the_rest(spark):
    bad = {r["offset"] for r in dead_letters(_raw(spark)).collect()}
    assert bad == {off for off, _, exp in CASES if exp is None}


def test_malformed_record_still_moves_the_watermark(spark, tmp_path):
    """The decode filter must not be pushed below the watermark (SURVEY §2.6
    trap 2): an undecodable record one hour later still advances event time."""
    from datetime import timedelta

    from sensorium.schema import RAW_RECORD
    from sensorium.sources.replay import replay_stream
    from sensorium.streaming.windows import with_event_time
    rows = [(T0, None, bytearray(b'{"sensorId": 1, "value": 1.0}'), 0, 1, 0),
            (T0 + timedelta(hours=1), None, bytearray(b'{"sensorId": 1, "val'), 0, 2, 0),
            (T0 + timedelta(minutes=1), None, bytearray(b'{"sensorId": 1, "value": 2.0}'), 0, 3, 1)]
    from pyspark.sql import types as T
    df = spark.createDataFrame(rows, T.StructType(RAW_RECORD.fields + [T.StructField("batch", T.IntegerType())]))
    for batch in (0, 1):
        df.filter(F.col("batch") == batch).drop("batch").write.mode("append").parquet(str(tmp_path / "in"))
        stream = decode_measurements(with_event_time(replay_stream(spark, str(tmp_path / "in"), RAW_RECORD)))
        q = (stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "ck"))
             .trigger(availableNow=True).start())
        q.awaitTermination()
    marks = [p["eventTime"].get("watermark") for p in q.recentProgress if "eventTime" in p]
    assert "2024-01-01T00:59:59.750Z" in marks


def test_every_record_is_decoded_or_dead(spark):
    raw = tables_raw(spark)
    good, dead = decode_measurements(raw, keep=("offset",)), dead_letters(raw)
    assert good.count() == 900 and dead.count() == 100 and dead.filter("timestamp IS NOT NULL").count() == 0
    assert dead_letter_counts(raw).agg(F.sum("n_bad")).first()[0] == 100


def tables_raw(spark):
    """1,000 well-formed records, 100 of them without a time."""
    js = F.lit('{"sensorId":1,"value":1.5,"location":"L","measurementInformation":"i"}').cast("binary")
    t = F.when(F.col("id") % 10 != 0, F.timestamp_micros(F.col("id")))
    return spark.range(1000).select(t.alias("timestamp"), F.lit(None).cast("binary").alias("key"), js.alias("value"),
                                    F.lit(0).alias("partition"), F.col("id").alias("offset"))
