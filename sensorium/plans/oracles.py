"""DuckDB SQL for each registered query (the correctness oracle).

Each statement starts from the measurement view of FIXTURES.md §3; bodies
starting with a comma continue its WITH list.
"""

from __future__ import annotations

M = """WITH m AS (
  SELECT e.event_id, CAST(e.user_id AS INTEGER) AS sensor_id, e.value,
         n.n_name AS location, e.props AS measurement_information, e.ts
  FROM events e JOIN nation n ON e.user_id % 25 = n.n_nationkey
)
"""

_SLIDING = """SELECT ws AS window_start, ws + INTERVAL 60 SECOND AS window_end, location,
       count(*) AS events_per_window, round(sum(value), 6) AS sum_per_window
FROM (SELECT m.*, time_bucket(INTERVAL 10 SECOND, ts) - to_seconds(10 * k) AS ws FROM m, range(6) r(k))
GROUP BY ALL"""

_ROUNDTRIP = "SELECT event_id, sensor_id, value, location, measurement_information, ts FROM m"

_EMA = """, f AS (SELECT sensor_id, ts, row_number() OVER w AS rn,
  list_reduce(list(value) OVER w, lambda a, x: (a + x) / 2.0) AS ema
  FROM m WINDOW w AS (PARTITION BY sensor_id ORDER BY ts, event_id))
SELECT sensor_id, ema, ts FROM f WHERE rn > 1"""

_EMA_CORRECTED = """, c AS (SELECT sensor_id, event_id, ts,
  CASE WHEN location = 'NATION_7' THEN value + 1.0 ELSE value END AS v FROM m),
f AS (SELECT sensor_id, event_id, ts, row_number() OVER w AS rn,
  list_reduce(list(v) OVER w, lambda a, x: (a + x) / 2.0) AS ema
  FROM c WINDOW w AS (PARTITION BY sensor_id ORDER BY ts, event_id))
SELECT sensor_id, ema, ts FROM f WHERE rn > 1"""

# The state is the fetch time and the row that fetched, so a hit at the very time of the fetch is told apart.
_TTL = """, f AS (SELECT event_id, location,
  list_reduce(list({'us': epoch_us(ts), 'id': event_id}) OVER (PARTITION BY location ORDER BY ts, event_id),
              lambda s, x: CASE WHEN x.us - s.us > 3600000000 THEN x ELSE s END).id <> event_id AS hit FROM m)
"""


_FIGURES = """count(*) AS n, min(lag) AS min_lag, max(lag) AS max_lag, round(avg(lag), 3) AS avg_lag, round(stddev_pop(lag), 3) AS stddev_lag,
  round(quantile_cont(lag, 0.5), 3) AS p50, round(quantile_cont(lag, 0.99), 3) AS p99"""


def _lag_stats(group: str) -> str:
    return f""", k AS (SELECT (epoch_us(max(ts)) // 1000) + 3600000 AS now_ms FROM m),
l AS (SELECT {group}, now_ms - (epoch_us(ts) // 1000) AS lag FROM m, k)
SELECT {group}, {_FIGURES} FROM l GROUP BY 1"""


# The replay of the stream queries: arrival batches, the watermark a batch runs at (wm), the one
# of the batch before (late rows of windows are judged by it), and the final watermark.
_REPLAY = """, b AS (SELECT m.*, event_id * 6 // (SELECT count(*) FROM m) + CASE event_id % 50 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END AS batch FROM m),
g AS (SELECT batch, max(epoch_us(ts) // 1000) AS top FROM b GROUP BY batch),
w AS (SELECT batch, max(top) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 86400000 AS wm,
             max(top) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) - 86400000 AS wm_before FROM g),
f AS (SELECT max(top) - 86400000 AS final FROM g)
"""


def _windows(start: str, size_ms: int, close_ms: int, select: str, extra: str = "") -> str:
    """Windows of the replay; ``close_ms`` after its start a window is emitted."""
    return _REPLAY + f""", x AS (SELECT b.*, {start} AS ws FROM b{extra}),
y AS (SELECT x.*, epoch_us(ws) // 1000 AS s FROM x JOIN w USING (batch)
      WHERE (wm_before IS NULL OR epoch_us(ws) // 1000 + {close_ms} > wm_before) AND epoch_us(ts) // 1000 < epoch_us(ws) // 1000 + {size_ms})
SELECT ws AS window_start, ws + to_milliseconds({size_ms}) AS window_end, location, {select}
FROM y, f WHERE s + {close_ms} <= final GROUP BY ALL"""


_COUNT_SUM = "count(*) AS events_per_window, round(sum(value), 6) AS sum_per_window"
_KEPT = _REPLAY + """, r AS (SELECT sensor_id, event_id, ts, value FROM b JOIN w USING (batch) WHERE wm IS NULL OR epoch_us(ts) // 1000 >= wm)
"""


def _sessions(rows: str, closed: str) -> str:
    return f""", gaps AS (SELECT sensor_id, event_id, ts, value, coalesce(epoch_us(ts) // 1000 - epoch_us(lag(ts) OVER o) // 1000 > 28800000, true) AS new
  FROM {rows} WINDOW o AS (PARTITION BY sensor_id ORDER BY ts, event_id)),
parts AS (SELECT *, sum(CAST(new AS INTEGER)) OVER (PARTITION BY sensor_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS k FROM gaps)
SELECT sensor_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n, round(sum(value), 6) AS total
FROM parts GROUP BY sensor_id, k{closed}"""


BODIES = {
    "raw_record_projection":
        """SELECT ts AS timestamp, CAST(NULL AS VARCHAR) AS key, '{"sensorId":' || sensor_id || ',"value":' || value || ',"location":"' || location ||
  '","measurementInformation":' || to_json(measurement_information) || '}' AS value,
  CAST(event_id % 3 AS INTEGER) AS partition, event_id AS "offset" FROM m""",
    "location_list": "SELECT n_name AS location FROM nation",
    "ingest_roundtrip": _ROUNDTRIP,
    "decode_drop_malformed":
        "SELECT event_id, sensor_id, CASE WHEN event_id % 7 = 2 THEN 0.0 ELSE value END AS value, "
        "location, measurement_information, ts FROM m WHERE event_id % 7 NOT IN (0, 1)",
    "dead_letter_counts":
        "SELECT CAST(event_id % 3 AS INTEGER) AS partition, count(*) AS n_bad FROM m "
        "WHERE event_id % 7 IN (0, 1) GROUP BY 1",
    "sensor_correction":
        "SELECT event_id, CASE WHEN location = 'NATION_7' THEN value + 1.0 ELSE value END AS value FROM m",
    "sliding_count_sum": _SLIDING,
    "sliding_full_buffer": _SLIDING,
    "sliding_count_sum_wide": """SELECT ws AS window_start, ws + INTERVAL 1 DAY AS window_end, location,
       count(*) AS events_per_window, round(sum(value), 6) AS sum_per_window
FROM (SELECT m.*, time_bucket(INTERVAL 4 HOUR, ts, TIMESTAMP '1970-01-01') - to_hours(4 * k) AS ws
      FROM m, range(6) r(k))
GROUP BY ALL""",
    "sampling_window": """SELECT ws AS window_start, ws + INTERVAL 60 SECOND AS window_end, location,
       count(*) AS events_per_window, round(sum(value), 6) AS sum_per_window
FROM (SELECT m.*, time_bucket(INTERVAL 90 SECOND, ts, TIMESTAMP '1970-01-01') AS ws FROM m)
WHERE ts < ws + INTERVAL 60 SECOND
GROUP BY ALL""",
    "location_enrich":
        "SELECT event_id, location, location || '/' || r.r_name AS location_info FROM m "
        "JOIN nation n ON n.n_name = m.location JOIN region r ON r.r_regionkey = n.n_regionkey",
    "ttl_cache_hits": _TTL + "SELECT event_id, location, hit AS served_from_cache FROM f",
    "ttl_cache_stats": _TTL + "SELECT location, count(*) FILTER (hit) AS served_from_cache, "
                              "count(*) FILTER (NOT hit) AS lookups, 1::BIGINT AS cache_size FROM f GROUP BY 1",
    "sorted_stream":
        "SELECT sensor_id, event_id, row_number() OVER (PARTITION BY sensor_id ORDER BY ts, event_id) AS pos FROM m",
    "ema": _EMA,
    "ema_corrected": _EMA_CORRECTED,
    "sort_lag_stats": _lag_stats("sensor_id"),
    "enrich_delay_stats": _lag_stats("location"),
    "window_lag_stats": f""", k AS (SELECT (epoch_us(max(ts)) // 1000) + 3600000 AS now_ms FROM m),
w AS (SELECT DISTINCT location, time_bucket(INTERVAL 10 SECOND, ts) - to_seconds(10 * k) + INTERVAL 60 SECOND AS we
      FROM m, range(6) r(k)),
l AS (SELECT location, now_ms - (epoch_us(we) // 1000) AS lag FROM w, k)
SELECT location, {_FIGURES} FROM l GROUP BY 1""",
    "sliding_stream_final": _windows("time_bucket(INTERVAL 10 SECOND, ts) - to_seconds(10 * k)", 60_000, 60_000, _COUNT_SUM, ", range(6) r(k)"),
    "late_window_drop": _windows("time_bucket(INTERVAL 1 DAY, ts, TIMESTAMP '1970-01-01')", 86_400_000, 86_400_000, _COUNT_SUM),
    "sampling_stream_final": _windows("time_bucket(INTERVAL 90 SECOND, ts, TIMESTAMP '1970-01-01')", 60_000, 90_000, _COUNT_SUM),
    "buffer_stream_final": _windows("time_bucket(INTERVAL 1 HOUR, ts) - to_hours(k)", 14_400_000, 14_400_000,
                                    "count(*) AS n, arg_min(value, (ts, event_id)) AS first_value, arg_max(value, (ts, event_id)) AS last_value",
                                    ", range(4) r(k)"),
    "ema_stream_final": _KEPT + """, e AS (SELECT sensor_id, ts, row_number() OVER o AS rn,
  list_reduce(list(value) OVER o, lambda a, x: (a + x) / 2.0) AS ema
  FROM r WINDOW o AS (PARTITION BY sensor_id ORDER BY ts, event_id))
SELECT sensor_id, ema, ts FROM e, f WHERE rn > 1 AND epoch_us(ts) // 1000 < final""",
    "sorted_stream_final": _KEPT + """, e AS (SELECT sensor_id, event_id, ts,
  row_number() OVER (PARTITION BY sensor_id ORDER BY ts, event_id) AS pos FROM r)
SELECT sensor_id, event_id, pos FROM e, f WHERE epoch_us(ts) // 1000 < final""",
    "sort_ema_per_event": _KEPT + """, c AS (SELECT r.*, CASE WHEN m.location = 'NATION_7' THEN r.value + 1.0 ELSE r.value END AS v FROM r JOIN m USING (event_id)),
e AS (SELECT sensor_id, event_id, ts, row_number() OVER o AS pos, list_reduce(list(v) OVER o, lambda a, x: (a + x) / 2.0) AS ema
  FROM c WINDOW o AS (PARTITION BY sensor_id ORDER BY ts, event_id))
SELECT sensor_id, event_id, pos, CASE WHEN pos > 1 THEN ema END AS ema FROM e, f WHERE epoch_us(ts) // 1000 < final""",
    "ema_hot_stream_final": _KEPT + """, h AS (SELECT CASE WHEN event_id % 3 = 0 THEN 0 ELSE sensor_id END AS sensor_id, event_id, ts, value FROM r),
e AS (SELECT sensor_id, event_id, ts, row_number() OVER o AS pos, list_reduce(list(value) OVER o, lambda a, x: (a + x) / 2.0) AS ema
  FROM h WINDOW o AS (PARTITION BY sensor_id ORDER BY ts, event_id))
SELECT sensor_id, event_id, pos, ema, ts FROM e, f WHERE pos > 1 AND epoch_us(ts) // 1000 < final""",
    "ttl_stream_final": _KEPT + """, h AS (SELECT event_id, m.location, r.ts,
  list_reduce(list({'us': epoch_us(r.ts), 'id': event_id}) OVER (PARTITION BY m.location ORDER BY r.ts, event_id),
              lambda s, x: CASE WHEN x.us - s.us > 3600000000 THEN x ELSE s END).id <> event_id AS hit FROM r JOIN m USING (event_id))
SELECT location, count(*) FILTER (hit) AS served_from_cache, count(*) FILTER (NOT hit) AS lookups, 1::BIGINT AS cache_size
FROM h, f WHERE epoch_us(ts) // 1000 < final GROUP BY 1""",
    "user_aggregate_windows": """SELECT ws AS window_start, ws + INTERVAL 4 HOUR AS window_end, location, count(*) AS n, min(value) AS low,
       max(value) AS high, arg_min(value, (ts, event_id)) AS first_value
FROM (SELECT m.*, time_bucket(INTERVAL 1 HOUR, ts) - to_hours(k) AS ws FROM m, range(4) r(k)) GROUP BY ALL""",
    "buffer_fold_split": """, h AS (SELECT event_id, ts, value, CASE WHEN event_id % 3 = 0 THEN 'NATION_0' ELSE location END AS location,
  time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') - to_hours(6 * k) AS ws FROM m, range(4) r(k)),
d AS (SELECT *, value - lag(value) OVER (PARTITION BY location, ws ORDER BY ts, event_id) AS step FROM h)
SELECT ws AS window_start, ws + INTERVAL 1 DAY AS window_end, location, count(*) AS n, count(*) FILTER (step > 0) AS rises,
       round(coalesce(sum(abs(step)), 0), 6) AS path, arg_min(value, (ts, event_id)) AS first_value, arg_max(value, (ts, event_id)) AS last_value
FROM d GROUP BY ALL""",
    "session_gap_process": _sessions("m", ""),
    "session_stream_final": _KEPT + _sessions("r, f WHERE epoch_us(ts) // 1000 < final", " HAVING max(epoch_us(ts) // 1000) + 28800000 < (SELECT final FROM f)"),
    "location_enrich_failures": "SELECT event_id, l AS location, CASE WHEN l <> 'NATION_3' THEN md5(l) END AS location_info "
                                "FROM (SELECT event_id, CASE WHEN event_id % 11 <> 0 THEN location END AS l FROM m)",
    "lag_stream_final": _REPLAY + f""", k AS (SELECT (epoch_us(max(ts)) // 1000) + 3600000 AS now_ms FROM m),
l AS (SELECT location, now_ms - (epoch_us(ts) // 1000) AS lag FROM b, k
      QUALIFY row_number() OVER (PARTITION BY location ORDER BY batch DESC, ts DESC, event_id DESC) <= 100)
SELECT location, {_FIGURES} FROM l GROUP BY 1""",
    "redelivered_stream_final": _REPLAY + """SELECT event_id, sensor_id, value FROM b JOIN w USING (batch)
WHERE wm_before IS NULL OR epoch_us(ts) > wm_before * 1000""",
    "stream_counters": _REPLAY + """, r AS (SELECT *, false AS again FROM b UNION ALL SELECT * REPLACE (batch + 1 AS batch), true FROM b WHERE event_id % 10 = 3),
t AS (SELECT batch, max(epoch_us(ts) // 1000) AS top FROM r GROUP BY batch),
u AS (SELECT batch, row_number() OVER (ORDER BY batch) - 1 AS batch_id,
             max(top) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) - 86400000 AS wm_late FROM t),
j AS (SELECT *, wm_late IS NOT NULL AND epoch_us(ts) <= wm_late * 1000 AS late FROM r JOIN u USING (batch))
SELECT batch_id, count(*) AS input_rows, count(*) FILTER (late) AS late, count(*) FILTER (NOT late AND NOT again) AS records,
       count(*) FILTER (NOT late AND NOT again AND event_id % 7 IN (0, 1)) AS bad FROM j GROUP BY 1""",
    "dead_letter_stream_final":
        "SELECT CASE WHEN event_id % 7 IN (0, 1) THEN 'dead_letter' ELSE 'measurement' END AS kind, event_id, "
        "CASE WHEN event_id % 7 NOT IN (0, 1) THEN sensor_id END AS sensor_id, "
        "CASE event_id % 7 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN 0.0 ELSE value END AS value FROM m",
    "skewed_partitions_stream": """, f AS (SELECT min(top) - 3600000 AS final FROM (SELECT max(epoch_us(ts) // 1000) AS top FROM m GROUP BY event_id % 3))
SELECT ws AS window_start, ws + INTERVAL 1 HOUR AS window_end, location, count(*) AS events_per_window, round(sum(value), 6) AS sum_per_window
FROM (SELECT m.*, time_bucket(INTERVAL 1 HOUR, ts) AS ws FROM m), f WHERE epoch_us(ws) // 1000 + 3600000 <= final GROUP BY ALL""",
    "sort_release_bucket": "SELECT event_id, sensor_id, epoch_us(ts) // 1000 // 100 * 100 + 100 AS release_ms FROM m",
    "release_watermarks": _KEPT + """, x AS (SELECT wm AS at FROM w WHERE wm IS NOT NULL UNION SELECT final FROM f)
SELECT sensor_id, event_id, min(x.at) AS watermark_ms FROM r JOIN x ON x.at > epoch_us(ts) // 1000 GROUP BY ALL""",
    "location_enrich_async": "SELECT event_id, location, md5(location) AS location_info FROM m",
}


def oracle_sql() -> dict[str, str]:
    out = {}
    for k, body in BODIES.items():
        if body.lstrip().startswith(","):
            out[k] = M + body
        elif "FROM m" in body or " m," in body or "JOIN m" in body:
            out[k] = M + body
        else:
            out[k] = body
    return out
