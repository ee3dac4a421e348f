"""Conflict-constrained best-fit packing of documents into sequences of ``CAPACITY`` words.

A document longer than a sequence is cut: full pieces are sequences of their own, and the rest is packed.
Rows are dealt by hash into blocks of about ``BLOCK_ROWS`` (more blocks for more rows), and each block is
packed on its own, largest piece first. A block's bins are kept in the order of their residual
capacity, and each carries a bitmap of the sources and one of the duplicate clusters (equal normalised texts) it
holds. The successor search starts at the tightest bin that still has room and goes on until
a bin is compatible, which holds neither the piece's source nor its cluster; without one a new
bin opens. Only ids, sizes and hashes travel; texts stay where they are.

Defined results: null or blank text is a piece of no words; null sources are one source; a null id is an ordinary
row; repeated rows are one cluster, never in the same bin; a text longer than a bin is cut into pieces; an empty table gives no rows; further columns
are ignored, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, prepare, quoted, written

CAPACITY = 2048
BLOCK_ROWS = 4096


def best_fit(pieces: list[tuple], capacity: int) -> list[int]:
    """The bin of each (size, source, cluster), in the given order; -1 clusters conflict with nothing."""
    order: list[tuple[int, int]] = []  # (residual, bin)
    sources, clusters, bins = [], [], []
    for size, source, cluster in pieces:
        at = bisect_left(order, (size, -1))
        s, c = 1 << source, 1 << cluster if cluster >= 0 else 0
        while at < len(order) and (sources[order[at][1]] & s or clusters[order[at][1]] & c):
            at += 1
        if at < len(order):
            residual, b = order.pop(at)
            sources[b] |= s
            clusters[b] |= c
        else:
            residual, b = capacity, len(sources)
            sources.append(s)
            clusters.append(c)
        insort(order, (residual - size, b))
        bins.append(b)
    return bins


def _pack(table: pa.Table, capacity: int) -> pa.Table:
    """One block: columns id, n_words, source, cluster, block -> a row per piece."""
    rows = sorted(zip(*(c.to_pylist() for c in table.columns), strict=True), key=lambda r: (-(r[1] % capacity or min(r[1], capacity)), r[3], str(r[0])))
    copies = Counter(r[3] for r in rows)
    source_bit = {s: k for k, s in enumerate(dict.fromkeys(r[2] for r in rows))}
    cluster_bit = {c: k for k, c in enumerate(c for c, n in copies.items() if n > 1)}
    # the last piece of each document is packed; the ones before it are full
    rest = [r[1] % capacity or min(r[1], capacity) for r in rows]
    bins = best_fit([(n, source_bit[r[2]], cluster_bit.get(r[3], -1)) for n, r in zip(rest, rows, strict=True)], capacity)
    filled: Counter = Counter()
    out, next_bin = [], max(bins, default=-1) + 1
    for n, b, r in zip(rest, bins, rows, strict=True):
        full = (r[1] - n) // capacity
        for k in range(full):
            out.append((r[0], k, k * capacity, capacity, r[4], next_bin, 0, r[2], r[3]))
            next_bin += 1
        out.append((r[0], full, full * capacity, n, r[4], b, filled[b], r[2], r[3]))
        filled[b] += n
    columns = list(zip(*out, strict=True)) or [()] * 9
    kinds = [table.schema.field(0).type, *[pa.int64()] * 6, table.schema.field(2).type, pa.int64()]
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                names=["id", "piece", "first_word", "n_words", "block", "bin", "bin_offset", "source", "cluster"])


def pack(docs: DataFrame, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per piece: id, piece, first_word, n_words, block, bin, bin_offset, source, cluster."""
    spark = prepare(docs)
    picked = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"), quoted(source_col).alias("source"))
    kind, source = (picked.schema[c].dataType.simpleString() for c in ("id", "source"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for b in batches:
            words = [t.split() for t in as_bytes(b.column(1))]
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array(map(len, words), pa.int64()), b.column(2),
                pa.array([xxhash.xxh64_intdigest(b" ".join(w)) - (1 << 63) for w in words], pa.int64())], names=["id", "n_words", "source", "cluster"])

    # a stored salt, so that repeated rows don't share a block
    sizes = written(picked.mapInArrow(measure, f"id {kind}, n_words long, source {source}, cluster long")
                    .withColumn("salt", F.xxhash64("id", "cluster", F.monotonically_increasing_id())), "pack-sizes")
    blocks = max(1, -(-sizes.count() // BLOCK_ROWS))
    dealt = sizes.withColumn("block", F.pmod(F.col("salt"), F.lit(blocks))).drop("salt")
    dealt = dealt.repartition(max(1, min(blocks, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))), "block")
    return dealt.groupBy("block").applyInArrow(
        lambda t: _pack(t, capacity),
        f"id {kind}, piece long, first_word long, n_words long, block long, bin long, bin_offset long, source {source}, cluster long",
    ).withColumnRenamed("id", id_col)
