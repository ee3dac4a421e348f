"""Replaying a table as a file stream, one micro-batch per value of a batch column.

Rows are staged by one partitioned write. For each batch, one Spark job appends
its rows to the folder that the stream reads, and the query runs over what is
new (``availableNow``) from its checkpoint. Batch borders so depend on neither
file times nor listing order, and no file is handled on the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

_NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"

#: Rows of a replayed file at most. A batch's rows often lie in one or two source files, and Spark deals files to tasks by bytes: large
#: files of small rows would leave a batch to one or two tasks.
FILE_ROWS = 25_000


def assign_batches(df: DataFrame, n_batches: int = 6, id_col: str = "event_id",
                   late: dict[int, int] | None = None, late_every: int = 50) -> DataFrame:
    """``batch = floor(id * n_batches / count)``; rows whose ``id % late_every``
    is a key of ``late`` arrive that many batches later (fixture rule)."""
    n = df.select(F.count(F.lit(1))).scalar()
    b = F.floor(F.col(id_col) * F.lit(n_batches) / n).cast("long")
    for rest, shift in (late or {}).items():
        b = b + F.when(F.pmod(F.col(id_col), F.lit(late_every)) == rest, F.lit(shift)).otherwise(F.lit(0))
    return df.withColumn("batch", b)


def replay_stream(spark: SparkSession, folder: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).parquet(folder)


def _child(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """A session with the settings of ``spark`` and these, which no other stream of ``spark`` sees."""
    child = spark.newSession()
    for k, v in (spark.conf.getAll | settings).items():
        if child.conf.isModifiable(k) and child.conf.get(k, None) != v:
            child.conf.set(k, v)
    return child


def run_replay(df: DataFrame, build: Callable[[DataFrame], DataFrame], batch: str = "batch",
               root: str | None = None, partition_by: str | None = None, progress: list | None = None) -> DataFrame:
    """The output of the stream ``build(raw)`` over ``df`` without its ``batch``
    column, replayed batch by batch.

    Only the last run ends with a batch without data, as one uninterrupted run
    would: within it, state is released up to the final watermark. ``partition_by`` divides the sink's folder by a
    column; ``progress`` receives the progress of every micro-batch.
    """
    spark = df.sparkSession
    root = root or scratch_path(spark, "replay")
    staged, folder, out = f"{root}/staged", f"{root}/stream", f"{root}/out"
    df.write.option("maxRecordsPerFile", FILE_ROWS).partitionBy(batch).parquet(staged)
    schema = df.drop(batch).schema
    table = spark.read.schema(df.schema).parquet(staged)
    batches = sorted(r[0] for r in table.select(batch).distinct().collect())  # one value per micro-batch
    sessions = {last: _child(spark, {_NO_DATA: str(last).lower()}) for last in (False, True)}
    stream = None
    for i, b in enumerate(batches):
        table.filter(F.col(batch) == b).drop(batch).write.mode("append").option("maxRecordsPerFile", FILE_ROWS).parquet(folder)
        stream = build(replay_stream(sessions[i == len(batches) - 1], folder, schema))
        w = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{root}/checkpoint")
        q = (w.partitionBy(partition_by) if partition_by else w).trigger(availableNow=True).start(out)
        q.awaitTermination()
        if progress is not None:
            progress.extend(q.recentProgress)
    if stream is None:
        return build(spark.createDataFrame([], schema))
    return spark.read.schema(stream.schema).parquet(out)
