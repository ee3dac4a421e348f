"""Lag summaries: how far behind a clock rows or window results are.

The clock is an explicit column, so results are exact and testable. All figures
cover every row. Percentiles are exact (linear interpolation between ranks)
and found in two steps over counts: a group's lags are counted in intervals of
``BIN_MS``, the interval that holds a rank is picked, and only its distinct
lags are ranked. So no task sees all lags of a hot group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BIN_MS = 65_536


def processing_lag_ms(ts: str = "ts") -> Column:
    """``now - event time`` in ms with the query's clock (``current_timestamp``
    is fixed per micro-batch / per query): the reference's processing-time
    delay of an enriched row."""
    return F.unix_millis(F.current_timestamp()) - F.unix_millis(F.col(ts))


def clock_after_max(df: DataFrame, ts: str = "ts", plus_ms: int = 3_600_000) -> Column:
    """A fixed clock: the latest event time plus ``plus_ms`` (scalar subquery)."""
    return df.select((F.unix_millis(F.max(ts)) + F.lit(plus_ms)).alias("now_ms")).scalar()


def _figures(lag: str, n: Column) -> list[Column]:
    """count, min, max, average and standard deviation, from lags that each stand for ``n`` rows."""
    d = F.col(lag).cast("decimal(38,0)")
    total, s1, s2 = F.sum(n), F.sum(d * n), F.sum(d * d * n)
    mean = s1.cast("double") / total
    # sums of integers are exact, so the variance is too until the last step
    var = (total * s2 - s1 * s1).cast("double") / (total * total)
    return [total.alias("n"), F.min(lag).alias("min_lag"), F.max(lag).alias("max_lag"),
            F.round(mean, 3).alias("avg_lag"), F.round(F.sqrt(F.greatest(var, F.lit(0.0))), 3).alias("stddev_lag")]


def percentiles(counts: DataFrame, group: str, ps: dict[str, float], digits: int = 3) -> DataFrame:
    """``group`` and a column per entry of ``ps``, from (group, lag, n)."""
    binned = counts.withColumn("_bin", F.floor(F.col("lag") / F.lit(BIN_MS)))
    bins = binned.groupBy(group, "_bin").agg(F.sum("n").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(group).orderBy("_bin")) - F.col("_n")
    bins = bins.withColumn("_before", before).withColumn("_total", F.sum("_n").over(Window.partitionBy(group)))
    ranks = F.array(*[F.struct(F.lit(k).alias("name"), (F.lit(p) * (F.col("_total") - 1)).alias("rank")) for k, p in ps.items()])
    want = bins.withColumn("_p", F.explode(ranks)).withColumn("_at", F.explode(F.array(F.floor("_p.rank"), F.ceil("_p.rank")))) \
        .filter((F.col("_at") >= F.col("_before")) & (F.col("_at") < F.col("_before") + F.col("_n"))) \
        .select(F.col(group).alias("_g"), F.col("_bin").alias("_b"), "_before", "_p", "_at").distinct()
    inside = binned.withColumn("_upto", F.sum("n").over(Window.partitionBy(group, "_bin").orderBy("lag")))
    got = inside.join(want, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_bin") == F.col("_b"))) \
        .filter((F.col("_at") < F.col("_before") + F.col("_upto")) & (F.col("_at") >= F.col("_before") + F.col("_upto") - F.col("n")))
    low, high = F.min("lag"), F.max("lag")
    value = got.groupBy(group, F.col("_p.name").alias("_name")).agg(
        F.round(low + (high - low) * (F.first("_p.rank") - F.min("_at")), digits).alias("_v"))
    return value.groupBy(group).agg(*[F.max(F.when(F.col("_name") == k, F.col("_v"))).alias(k) for k in ps])


def lag_stats(df: DataFrame, group: str, ts: str, now_ms: Column, ps: dict[str, float] | None = None) -> DataFrame:
    """Per group over all rows: ``n, min_lag, max_lag, avg_lag, stddev_lag`` (population) and
    percentiles (``p50``, ``p99`` by default) of ``now_ms - ts`` in ms."""
    ps = ps or {"p50": 0.5, "p99": 0.99}
    counts = df.select(group, (now_ms - F.unix_millis(F.col(ts))).alias("lag")).groupBy(group, "lag").agg(F.count(F.lit(1)).alias("n"))
    base = counts.groupBy(group).agg(*_figures("lag", F.col("n")))
    pct = percentiles(counts, group, ps).withColumnRenamed(group, "_g2")
    return base.join(pct, F.col(group).eqNullSafe(F.col("_g2"))).drop("_g2")


def window_lag_stats(windows: DataFrame, key: str, now_ms: Column) -> DataFrame:
    """:func:`lag_stats` of window results: ``now - window_end`` per key."""
    return lag_stats(windows, key, "window_end", now_ms)


def observe_lag(df: DataFrame, name, ts: str = "ts", now_ms: Column | None = None, accuracy: int = 10_000) -> DataFrame:
    """``df`` (a stream or a table) with a lag summary of each micro-batch as observed metrics:
    the form for streams, read from ``StreamingQueryProgress.observedMetrics``. Percentiles
    are approximate, off by at most 1/``accuracy`` of the rows in rank."""
    lag = processing_lag_ms(ts) if now_ms is None else now_ms - F.unix_millis(F.col(ts))
    return df.observe(name, F.count(lag).alias("n"), F.min(lag).alias("min_lag"), F.max(lag).alias("max_lag"), F.avg(lag).alias("avg_lag"),
                      F.stddev_pop(lag).alias("stddev_lag"), F.percentile_approx(lag, 0.5, accuracy).alias("p50"),
                      F.percentile_approx(lag, 0.99, accuracy).alias("p99"))
