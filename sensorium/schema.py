"""Row schemas and option defaults.

Fixed values that must equal the reference jobs' defaults (they define
results, e.g. window geometry and the JSON field names):

* JSON field names of a measurement: sensorId, value, location,
  measurementInformation
* window size 60 s, default slide 10 s
* bounded out-of-orderness 250 ms
* cache time-to-live 1000 ms
* sort timer rounding 100 ms
* async lookups in flight: 30
* default location correction: {"Berlin": 1.0}
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (see module docstring) ------------------------------------
JSON_FIELDS = ("sensorId", "value", "location", "measurementInformation")
WINDOW_SIZE = "1 minute"
WINDOW_SIZE_SECONDS = 60
DEFAULT_SLIDE_SECONDS = 10
OUT_OF_ORDERNESS_MS = 250
CACHE_TTL_MS = 1000
ROUND_TIMER_TO_MS = 100
ASYNC_CAPACITY = 30
LAG_SAMPLES = 10_000
DEFAULT_CORRECTIONS = {"Berlin": 1.0}
# ----------------------------------------------------------------------------

# Raw Kafka-shaped record; ``offset`` is kept as the arrival-order tie-break.
RAW_RECORD = T.StructType([
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
])

# JSON payload parsed with every field as text; numbers are coerced after.
JSON_TEXT = T.StructType([T.StructField(f, T.StringType()) for f in JSON_FIELDS])
