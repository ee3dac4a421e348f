"""Shared helpers of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package

#: Text bytes that one numpy pass handles at a time (a longer document is a pass of its own).
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> Column:
    """The column of this very name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, under which no name clashes."""
    return F.struct(*[quoted(c) for c in df.columns])


def unpacked(df: DataFrame, names: list[str], row: str = "row") -> DataFrame:
    """The columns of ``whole_row`` again."""
    return df.select(*[F.col(row).getField(c).alias(c) for c in names])


def filtered(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """``df`` through an Arrow function that keeps its columns, which it may name as it likes (``mapInArrow`` takes no dots)."""
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.mapInArrow(run, plain.schema).toDF(*df.columns)


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written as a Parquet table to the shared folder and read again:
    it cuts lineage, survives lost executors and is computed once."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def prepare(df: DataFrame) -> SparkSession:
    """The session of ``df``, with this package importable by its Python workers."""
    ship_package(df.sparkSession)
    return df.sparkSession


def as_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each value; null counts as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b"" if v is None else v for v in column.cast(kind).to_pylist()]


def slices(texts: list[bytes], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose texts hold about ``limit`` bytes together."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield lo, i
            lo, size = i, 0
        size += len(t)
    if lo < len(texts):
        yield lo, len(texts)


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the runs of true values."""
    edge = np.diff(np.concatenate(([0], flags.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The concatenation of ``arange(s, s + n)`` over all pairs."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(counts) - counts
    return np.arange(total, dtype=np.int64) + np.repeat(starts - before, counts)


_BASE, _MIX = 0x9E3779B97F4A7C15, np.uint64(0xFF51AFD7ED558CCD)


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def prefix_hashes(buf: np.ndarray, base: int = _BASE) -> tuple[np.ndarray, np.ndarray]:
    """Polynomial prefix sums of the bytes, and the powers that bring a difference of two back to exponent 0."""
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * powers(base, len(buf)))))
    return sums, powers(pow(base, -1, 1 << 64), len(buf) + 1)


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash (never 0) of each span of bytes; equal bytes have equal hashes in any buffer."""
    sums, back = prefix_hashes(buf)
    h = (sums[ends] - sums[starts]) * back[starts]
    h = (h ^ ((ends - starts).astype(np.uint64) << np.uint64(32)) ^ (h >> np.uint64(33))) * _MIX
    return (h ^ (h >> np.uint64(29))) | np.uint64(1)
