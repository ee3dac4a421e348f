"""JSON decoding of measurement records with the reference's tolerance rules.

A record is parsed with every field as text, then coerced like a default
Jackson object mapper would bind it to an (int, double, String, String) bean:

* missing field or JSON null for a number -> 0 / 0.0; for a string -> NULL
* a number given as a string ("12") is accepted; a fractional number for the
  int field is truncated toward zero, a fractional *string* ("1.7") is not
* unknown fields, invalid JSON, non-object JSON, NaN tokens, numbers that do
  not fit, objects/arrays where a scalar is expected -> the record is dropped
  (it goes to the dead-letter output instead)

Keep/drop is a generator (0 or 1 rows per record, the reference's flatMap),
not a filter: Catalyst pushes filters through projections by inlining them,
which would parse every record twice, and pushes filters that do not touch
the event-time column below ``withWatermark``, so a malformed record would
no longer move the watermark. A generator is pushed nowhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import JSON_FIELDS, JSON_TEXT

_INT_MIN, _INT_MAX = -2147483648, 2147483647
# A string field whose JSON value is an object or array (Jackson rejects it;
# a text-typed from_json would silently keep the raw JSON).
_NESTED_STRING_FIELD = r'"(location|measurementInformation)"\s*:\s*[\[{]'


def _number_text(c: Column) -> Column:
    """NULL / empty text -> '0' (Jackson coerces both to zero)."""
    return F.when(c.isNull() | (F.trim(c) == F.lit("")), F.lit("0")).otherwise(c)


def _maybe_nested(c: Column) -> Column:
    """Cheap pre-check: a text field whose value looks like JSON structure
    (only then is the raw record scanned with a regex)."""
    return F.coalesce(c.startswith("{") | c.startswith("["), F.lit(False))


def parse_columns(j: Column, keys: Column, text: Column) -> dict[str, Column]:
    """Decoded fields and the validity flag from the parsed struct ``j``,
    the top-level key list ``keys`` and the raw ``text``."""
    sid_d = _number_text(j["sensorId"]).try_cast("double")
    val_d = _number_text(j["value"]).try_cast("double")
    known = F.array(*[F.lit(f) for f in JSON_FIELDS])
    # A quoted int must be integer text ("12"); a bare number may have a
    # fraction (truncated). Only non-integer text is checked for quotes.
    sid_text = j["sensorId"]
    quoted_fraction = F.coalesce(~sid_text.rlike(r"^\s*[+-]?\d+\s*$"), F.lit(False)) \
        & text.rlike(r'"sensorId"\s*:\s*"')
    # And short-circuits: the regex runs only when a text field looks nested
    nested = (_maybe_nested(j["location"]) | _maybe_nested(j["measurementInformation"])) \
        & text.rlike(_NESTED_STRING_FIELD)
    ok = (
        keys.isNotNull()
        & (F.size(F.array_except(keys, known)) == 0)
        & sid_d.isNotNull() & (sid_d >= _INT_MIN) & (sid_d <= _INT_MAX)
        & val_d.isNotNull()
        & ~nested
        & ~quoted_fraction
    )
    return {
        "sensor_id": sid_d.try_cast("int"),
        "_value": val_d,
        "location": j["location"],
        "measurement_information": j["measurementInformation"],
        "_ok": F.coalesce(ok, F.lit(False)),
    }


def with_parsed(raw: DataFrame, value: str = "value", ts: str = "timestamp") -> DataFrame:
    """Raw records plus decoded columns and ``_ok``; ``ts`` = record time.

    The text is parsed once per record (one struct column, one key list);
    the fields are derived from those columns in a second projection, so
    the parse is not repeated for each field reference.
    """
    text = F.col(value).cast("string")
    parsed = raw.select("*", text.alias("_text"), F.from_json(text, JSON_TEXT).alias("_j"),
                        F.json_object_keys(text).alias("_k"))
    cols = parse_columns(F.col("_j"), F.col("_k"), F.col("_text"))
    return parsed.select(*raw.columns, *[c.alias(n) for n, c in cols.items()], F.col(ts).alias("ts"))


def _emit_if(cond: Column, cols: list[Column]) -> Column:
    """0 or 1 output rows per input (a flatMap). A generator, not a filter:
    Catalyst cannot push it below the parse (where it would re-run the parse
    inside the filter) nor below a watermark on the record time."""
    return F.inline(F.when(cond, F.array(F.struct(*cols))))


def decode_measurements(raw: DataFrame, value: str = "value", ts: str = "timestamp",
                        keep: tuple[str, ...] = (), metrics=None) -> DataFrame:
    """Well-formed measurements: ``sensor_id, value, location,
    measurement_information, ts`` plus the ``keep`` columns of the record.

    ``metrics`` (a name for streams, or an ``Observation``) attaches counters
    ``n_records`` and ``n_bad`` from the same parse: per micro-batch in
    ``StreamingQueryProgress.observedMetrics`` — the reference's error log
    as a metric.
    """
    p = with_parsed(raw, value, ts)
    if metrics is not None:
        p = p.observe(metrics, F.count(F.lit(1)).alias("n_records"),
                      F.count(F.when(~(F.col("_ok") & F.col("ts").isNotNull()), 1)).alias("n_bad"))
    cols = [F.col(k) for k in keep] + [F.col("sensor_id"), F.col("_value").alias("value"), F.col("location"),
                                       F.col("measurement_information"), F.col("ts")]
    return p.select(_emit_if(F.col("_ok") & F.col("ts").isNotNull(), cols))


def dead_letters(raw: DataFrame, value: str = "value", ts: str = "timestamp") -> DataFrame:
    """Every record that :func:`decode_measurements` does not emit: those that fail to
    decode (the reference logs and drops them) and those without a record time."""
    p = with_parsed(raw, value, ts)
    return p.select(_emit_if(~(F.col("_ok") & F.col("ts").isNotNull()), [F.col(c) for c in raw.columns]))


def dead_letter_counts(raw: DataFrame, by: str = "partition") -> DataFrame:
    """Number of undecodable records per source partition."""
    return dead_letters(raw).groupBy(by).agg(F.count(F.lit(1)).alias("n_bad"))



MEASUREMENT, DEAD_LETTER = "measurement", "dead_letter"


def split_records(raw: DataFrame, keep: tuple[str, ...] = (), metrics=None) -> DataFrame:
    """Every record once, from one parse: ``kind`` (measurement or dead letter), the ``keep`` columns of the record, the decoded fields
    of a measurement and ``raw`` (the record's bytes) of a dead letter.

    For a sink divided by ``kind``: one query then writes both outputs in one commit, so neither has a record
    twice or lacks one after a restart.
    """
    p = with_parsed(raw)
    ok = F.col("_ok") & F.col("ts").isNotNull()
    if metrics is not None:
        p = p.observe(metrics, F.count(F.lit(1)).alias("n_records"), F.count(F.when(~ok, 1)).alias("n_bad"))
    only = lambda c: F.when(ok, F.col(c))
    cols = [F.when(ok, MEASUREMENT).otherwise(DEAD_LETTER).alias("kind"), *[F.col(k) for k in keep], only("sensor_id").alias("sensor_id"),
            only("_value").alias("value"), only("location").alias("location"), only("measurement_information").alias("measurement_information"),
            F.col("ts"), F.when(~ok, F.col("value")).alias("raw")]
    return p.select(_emit_if(F.lit(True), cols))
