"""SimHash near-duplicates by a segment-popcount embedding.

1. Each text becomes a 64-bit fingerprint (numpy inside Arrow tasks; no shuffle).
2. A fingerprint maps to its vector of bit counts in 32 segments of 2 bits. The Manhattan
   distance of two vectors never exceeds the Hamming distance of their fingerprints, so
   fingerprints at 2 bits lie within distance 2 on this integer grid, and then some grid
   point lies within 1 of both: the range join meets on at most 65 grid points per
   fingerprint. Fingerprints without a neighbour there have no partner.
3. The rest is verified exactly, without pairs: two fingerprints differ in at most 2 bits
   if and only if they share a word within 1 bit of both. A word has at most 65 such
   fingerprints, so the groups are bounded and each gives a star of links.
4. Components of the links; equal fingerprints were one node from the start.

Defined results: null or blank text has fingerprint zero, linked like any other; a null
id is ignored by ``component_id`` unless nothing else is there; repeated rows are each returned;
long texts are read whole, a slice of the batch by itself; an empty table gives no rows; further columns of the
input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, prepare, quoted, ranges, runs, slices, unpacked, whole_row, written
from .components import components

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
SEGMENTS = 32

_FOLD = bytes(32 if b == 32 or 9 <= b <= 13 else b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprints(texts: list[bytes], shingle: int = SHINGLE_WORDS) -> np.ndarray:
    """The SimHash of each text, as uint64."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    out = np.zeros(len(texts), np.uint64)
    for lo, hi in slices(texts):
        buf = np.frombuffer((b" ".join(texts[lo:hi]) + b" ").translate(_FOLD), np.uint8)
        word = buf != 32
        begun = np.concatenate(([False], word[:-1]))
        size = np.fromiter((len(t) + 1 for t in texts[lo:hi]), np.int64, hi - lo)
        n_words = np.diff(np.searchsorted(np.flatnonzero(word & ~begun), np.concatenate(([0], np.cumsum(size)))))
        packed = buf[word | begun]  # one space between words
        starts, ends = runs(packed != 32)
        first = np.cumsum(n_words) - n_words
        n = np.where(n_words >= shingle, n_words - shingle + 1, np.minimum(n_words, 1))
        at = ranges(first, n)
        if not len(at):
            continue
        until = at + np.repeat(np.minimum(n_words, shingle), n) - 1
        raw = packed.tobytes()
        h = np.fromiter((digest(raw[a:b], SEED) for a, b in zip(starts[at].tolist(), ends[until].tolist(), strict=True)),
                        np.uint64, len(at))
        out[lo:hi] = _majority(h, n)
    return out


def _majority(h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """For runs of ``n`` hashes each, the word whose bits are set in over half of the run's."""
    out = np.zeros(len(n), np.uint64)
    some = np.flatnonzero(n)
    n = n[some]
    begin = np.cumsum(n) - n
    blocks = -(-n // 255)  # a byte lane counts to 255
    block_start = np.repeat(begin, blocks) + 255 * ranges(np.zeros(len(n), np.int64), blocks)
    first_block = np.cumsum(blocks) - blocks
    ones = np.uint64(0x0101010101010101)
    value = np.zeros(len(n), np.uint64)
    for k in range(8):
        lanes = np.add.reduceat((h >> np.uint64(k)) & ones, block_start)
        counts = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), first_block, axis=0)
        bits = (2 * counts > n[:, None]).astype(np.uint8)
        value |= np.ascontiguousarray(bits).view(np.uint64).ravel() << np.uint64(k)
    out[some] = value
    return out


def _scan(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fp = fingerprints(as_bytes(b.column(1)), shingle)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64)), *b.columns[2:]], names=["id", "fp", *b.schema.names[2:]])


def _long(word: int) -> Column:
    return F.lit(word - (1 << 64) if word >> 63 else word)


def _segment_counts(x: Column) -> Column:
    """The bit count (0 to 2) of each 2-bit segment, kept in that segment."""
    odd, even = F.shiftrightunsigned(x, 1).bitwiseAND(_long(0x5555555555555555)), x.bitwiseAND(_long(0x5555555555555555))
    return even.bitwiseXOR(odd).bitwiseOR(F.shiftleft(even.bitwiseAND(odd), 1))


def _grid_points(v: Column) -> Column:
    """The grid points within Manhattan distance 1 of the vector ``v``; counts change by bit flips, so nothing carries."""
    points = [v]
    for s in range(SEGMENTS):
        count = F.shiftrightunsigned(v, 2 * s).bitwiseAND(F.lit(3))
        points += [F.when(count < 2, v.bitwiseXOR(_long(1 << 2 * s))),  # 0 to 1, 1 to 0
                   F.when(count > 0, v.bitwiseXOR(_long(3 << 2 * s)))]  # 1 to 2, 2 to 1
    return F.array_compact(F.array(*points))


def links(distinct: DataFrame) -> DataFrame:
    """Distinct fingerprints (fp) -> links (u, v) whose components are those of all pairs within MAX_BITS."""
    points = distinct.select("fp", F.explode(_grid_points(_segment_counts(F.col("fp")))).alias("point"))
    shared = points.groupBy("point").agg(F.min("fp").alias("a"), F.max("fp").alias("b")).filter("a <> b").select("point")
    near = points.join(shared, "point", "left_semi").select("fp").distinct()
    flips = [F.col("fp")] + [F.col("fp").bitwiseXOR(_long(1 << b)) for b in range(64)]
    stars = near.select("fp", F.explode(F.array(*flips)).alias("word")).groupBy("word") \
        .agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1)
    return stars.select(F.explode("fps").alias("u"), F.array_min("fps").alias("v")).filter("u <> v")


def _classes(marked: DataFrame) -> DataFrame:
    """Rows with a fingerprint (id, fp) -> each distinct fingerprint (fp), its smallest id (low) and its component (root)."""
    # as many files as shuffle partitions: each row becomes many, which the size of the classes doesn't tell
    n = int(marked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    classes = written(marked.groupBy("fp").agg(F.min("id").alias("low")).repartition(n), "classes")
    found = written(components(links(classes.select("fp"))), "components")
    return classes.join(found, classes["fp"] == found["node"], "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = SHINGLE_WORDS) -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits), component_id."""
    prepare(docs)
    kind = docs.select(quoted(id_col).alias("id")).schema["id"].dataType.simpleString()
    marked = written(docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"))
                     .mapInArrow(lambda it: _scan(it, shingle), f"id {kind}, fp long"), "simhash")
    rooted = _classes(marked)
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    return marked.join(rooted.select("fp", "root").join(lowest, "root"), "fp").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest id, all columns unchanged.

    A row is told by its id and a 96-bit hash of its text, so rows that share an id are dealt with each by its own component.
    Of several rows of a component with the smallest id (or all without an id) one stays: that of the smallest hash, and of
    rows equal in id and text any.
    """
    prepare(docs)
    names, hashes = docs.columns, [F.xxhash64(quoted(text_col)).alias("h"), F.hash(quoted(text_col)).alias("h2")]
    kind = docs.select(quoted(id_col).alias("id")).schema["id"].dataType.simpleString()
    marked = written(docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"), *hashes)
                     .mapInArrow(lambda it: _scan(it, shingle), f"id {kind}, fp long, h long, h2 int"), "simhash")
    row = F.struct(F.col("id").isNull().alias("lacks_id"), "id", "h", "h2")
    best = marked.join(_classes(marked).select("fp", "root"), "fp").groupBy("root").agg(F.min(row).alias("best"))
    told = lambda i: [i.isNull().alias("lacks_id"), F.coalesce(i.cast("string"), F.lit("")).alias("key")]
    on = ["lacks_id", "key", "h", "h2"]
    best = best.select(*told(F.col("best.id")), "best.h", "best.h2")
    # repeated rows fall together before the shuffle, so that many of one key are no task of their own
    rows = docs.select(whole_row(docs).alias("row"), *told(quoted(id_col)), *hashes).dropDuplicates(on)
    return unpacked(rows.join(best, on, "left_semi"), names)
