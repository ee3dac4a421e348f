"""What a stream did, as tables: counters per micro-batch, and lag over each group's latest samples.

Counters come from the progress that Spark keeps of a query (observed metrics, rows that stateful operators dropped as
late), so no listener or callback server runs beside it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from ..schema import LAG_SAMPLES

#: Samples that a task holds before it passes them on.
HELD = 1 << 20


def progress_rows(progress: Iterable) -> list[tuple]:
    """(batch_id, input_rows, late, metrics) of every micro-batch in a query's progress; metrics as
    ``{"name.metric": value}``. A batch reported twice counts once."""
    seen = {}
    for p in progress:
        late = sum(int(op["numRowsDroppedByWatermark"]) for op in p["stateOperators"])
        metrics = {f"{name}.{k}": int(v) for name, m in (p["observedMetrics"] or {}).items()
                   for k, v in (m if isinstance(m, dict) else m.asDict()).items() if v is not None}
        seen[int(p["batchId"])] = (int(p["batchId"]), int(p["numInputRows"]), late, metrics)
    return [seen[k] for k in sorted(seen)]


def counters(spark: SparkSession, progress: Iterable) -> DataFrame:
    """``batch_id, input_rows, late, metrics`` (a map), a row per micro-batch: one small row per batch, from the driver's record."""
    return spark.createDataFrame(progress_rows(progress), "batch_id long, input_rows long, late long, metrics map<string,long>")


# ---------------------------------------------------------------- lag over the last n samples

SUMMARY = "seq long, n long, min_lag long, max_lag long, avg_lag double, stddev_lag double, p50 double, p99 double"


def summary(lags: np.ndarray) -> tuple:
    """count, min, max, average, population standard deviation, median and 99th percentile (linear between ranks)."""
    n, exact = len(lags), [int(v) for v in lags.tolist()]
    s1, s2 = sum(exact), sum(v * v for v in exact)
    ordered = np.sort(lags)

    def at(p: float) -> float:
        rank = p * (n - 1)
        low = int(rank)
        high = min(low + 1, n - 1)
        return float(ordered[low]) + (float(ordered[high]) - float(ordered[low])) * (rank - low)

    return n, int(ordered[0]), int(ordered[-1]), s1 / n, float(np.sqrt(max(0.0, (n * s2 - s1 * s1) / (n * n)))), at(0.5), at(0.99)


def _make_trim(n: int):
    """Of the rows of a task, the latest ``n`` of each group: all that can be among the latest of the batch."""
    def trim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pd.DataFrame] = []
        size, schema = 0, None

        def cut() -> pd.DataFrame:
            return pd.concat(held).sort_values(["_us", "_tie"]).groupby(["_k", "_null"]).tail(n)

        for b in batches:
            schema = b.schema
            held.append(b.to_pandas())
            size += len(b)
            if size >= HELD:
                kept = cut()
                if len(kept) >= HELD // 2:  # many groups
                    yield pa.RecordBatch.from_pandas(kept, schema, preserve_index=False)
                    kept = kept.iloc[:0]
                held, size = [kept], len(kept)
        if size:
            yield pa.RecordBatch.from_pandas(cut(), schema, preserve_index=False)

    return trim


def _make_ring(n: int):
    def ring(key, pdfs: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        import warnings
        warnings.filterwarnings("ignore", category=FutureWarning)  # a pandas notice raised inside PySpark's state serializer
        lags, seq = (np.asarray(state.get[0], np.int64), int(state.get[1])) if state.exists else (np.zeros(0, np.int64), 0)
        fresh = pd.concat(list(pdfs)).sort_values(["_us", "_tie"])["_lag"].to_numpy(np.int64)
        lags = np.concatenate([lags, fresh])[-n:]
        state.update((lags.tolist(), seq + 1))
        yield pd.DataFrame([(key[0], key[1], seq + 1, *summary(lags))],
                           columns=["_k", "_null", "seq", "n", "min_lag", "max_lag", "avg_lag", "stddev_lag", "p50", "p99"])

    return ring


def latest_lag(rows: DataFrame, group: str, now_ms: Column, ts: str = "ts", tie: str = "event_id", samples: int = LAG_SAMPLES) -> DataFrame:
    """A stream of lag summaries over each group's latest ``samples`` rows, one per group and micro-batch that has rows of it;
    ``seq`` counts them, so the highest is current.

    Samples arrive by micro-batch, within one by (ts, tie). Every task first cuts its rows to the latest ``samples`` of a group, so a hot
    group moves a few of them per task; state holds ``samples`` numbers a group. Rows without a time are no samples."""
    from ..operators.folds import key_again, key_columns

    lag = now_ms - F.unix_millis(F.col(ts))
    data = rows.filter(F.col(ts).isNotNull()).select(*key_columns(F.col(group)), F.unix_micros(F.col(ts)).alias("_us"), F.col(tie).cast("long").alias("_tie"),
                                                     lag.cast("long").alias("_lag"))
    cut = data.mapInArrow(_make_trim(samples), "_k string, _null boolean, _us long, _tie long, _lag long")
    out = cut.groupBy("_k", "_null").applyInPandasWithState(_make_ring(samples), f"_k string, _null boolean, {SUMMARY}", "lags array<long>, seq long",
                                                            "append", GroupStateTimeout.NoTimeout)
    return out.select(key_again(rows.schema[group].dataType).alias(group), *[c.split()[0] for c in SUMMARY.split(", ")])


def current(summaries: DataFrame, group: str) -> DataFrame:
    """The latest summary of each group from a table of them."""
    names = [c for c in summaries.columns if c not in (group, "seq")]
    return summaries.groupBy(group).agg(F.max_by(F.struct(*names), "seq").alias("_s")).select(group, *[F.col("_s")[c].alias(c) for c in names])
