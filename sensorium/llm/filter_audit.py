"""How filters overlap: what each removes, alone and after others, in every order.

1. ``document_failures``: each text's failures (one Arrow pass), and whether an equal text (by SHA-256) has a smaller id.
2. ``interactions``: every task takes its rows in ranges of up to ``RANGE`` ids and keeps, per filter, a
   sorted posting list of failing ids, grouped by part. Unions and differences of the lists for all subsets
   of filters come from galloping merges (a union of k lists is k - 1 merges, shared between
   subsets); only their sizes per part leave the task and are summed by Spark.
3. Every order and step is then read off those sums: at most 2 ** n * n numbers a part.

Defined results: null text counts as empty, a null part as the empty string. A null id is neither smaller nor larger
than another, and has no label. Rows that repeat an id are counted each; a document is good or toxic if any label of its id says
so. An empty table gives no rows; texts of any length are read whole; further columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, prepare, quoted, written

FILTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT = 50  # in hundredths of the words
MAX_CAPITALS = 2  # in hundredths of the code points
SYMBOLS = rb"[#$%&*|]"
RANGE = 1 << 16  # ids of a range
STRIDE = 64  # keys that start a search together

_CAPITALS = bytes(range(65, 91))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    symbol = re.compile(SYMBOLS).search
    for b in batches:
        points = pc.fill_null(pc.utf8_length(b.column(2)), 0).to_pylist()
        bits, digests = [], []
        for text, n in zip(as_bytes(b.column(2)), points, strict=True):
            words = text.split()  # bytes split at ASCII white space
            capitals = len(text) - len(text.translate(None, _CAPITALS))
            bits.append((len(words) < MIN_WORDS) + 2 * (100 * len(set(words)) < MIN_DISTINCT * len(words))
                        + 4 * (100 * capitals > MAX_CAPITALS * n) + 8 * (symbol(text) is not None))
            digests.append(hashlib.sha256(text).digest())
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(bits, pa.int32()), pa.array(digests, pa.binary())],
                                         names=["id", "part", "bits", "sha"])


def document_failures(docs: DataFrame, id_col: str = "doc_id", part_col: str = "source", text_col: str = "text") -> DataFrame:
    """One row per document: id, part, bits (bit k set: the k-th of ``FILTERS`` rejects it)."""
    prepare(docs)
    rows = docs.select(quoted(id_col).cast("long").alias("id"), F.coalesce(quoted(part_col).cast("string"), F.lit("")).alias("part"),
                       quoted(text_col).alias("text"))
    seen = written(rows.mapInArrow(_scan, "id long, part string, bits int, sha binary"), "failures")
    # a stored side gives the join its own shuffle, so that Spark can split the rows of a common text
    first = written(seen.groupBy("sha").agg(F.min("id").alias("low")), "first")
    copy = F.coalesce(F.col("low") < F.col("id"), F.lit(False)).cast("int")
    return seen.join(first, "sha").select("id", "part", F.col("bits").bitwiseOR(F.shiftleft(copy, 4)).alias("bits"))


# ---------------------------------------------------------------- sorted lists

def gallop(hay: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Where each of the ascending ``keys`` would go in the ascending ``hay``.

    Every ``STRIDE``-th key searches from the start, the keys after it from where it ended: steps double until they
    pass the key, then the last step is halved. Short ways through a long list are so a few looks.
    """
    if len(keys) > STRIDE:
        start = np.repeat(gallop(hay, keys[::STRIDE]), STRIDE)[:len(keys)]
    else:
        start = np.zeros(len(keys), np.int64)
    n = len(hay)
    if not n or not len(keys):
        return start
    low, step = start.copy(), np.ones(len(keys), np.int64)
    going = np.arange(len(keys))
    while len(going):  # everything before low is smaller than the key
        at = low[going] + step[going] - 1
        going = going[(at < n) & (hay[np.minimum(at, n - 1)] < keys[going])]
        low[going] += step[going]
        step[going] *= 2
    high = np.minimum(low + step - 1, n)
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        middle = (low[open_] + high[open_]) // 2
        less = hay[middle] < keys[open_]
        low[open_[less]] = middle[less] + 1
        high[open_[~less]] = middle[~less]


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The union of two ascending lists without common ids; the shorter gallops through the longer."""
    a, b = (a, b) if len(a) >= len(b) else (b, a)
    return np.insert(a, gallop(a, b), b)


def difference(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The ids of ``a`` that ``b`` lacks."""
    if not len(a) or not len(b):
        return a
    if len(a) <= len(b):
        at = gallop(b, a)
        return a[b[np.minimum(at, len(b) - 1)] != a]
    at = gallop(a, b)
    return np.delete(a, at[(at < len(a)) & (a[np.minimum(at, len(a) - 1)] == b)])


def _sizes(parts: np.ndarray, ids: np.ndarray, bits: np.ndarray, good: np.ndarray, toxic: np.ndarray, n_filters: int) -> pd.DataFrame:
    """Of one range: rows (part code, before, filter, n, good, toxic), where ``before`` is the set of filters
    applied before ``filter`` and n counts what it still removes; filter -1 counts the part's documents."""
    order = np.lexsort((ids, parts))
    parts, bits, good, toxic = parts[order], bits[order], good[order], toxic[order]
    n_parts = int(parts[-1]) + 1
    lists = [np.flatnonzero(bits >> f & 1) for f in range(n_filters)]  # ascending by part and id
    count = lambda at, w=None: np.bincount(parts[at], None if w is None else w[at], n_parts).astype(np.int64)
    every = np.arange(len(parts))
    out = [(0, -1, count(every), count(every, good), count(every, toxic))]
    union = {0: np.zeros(0, np.int64)}
    for before in range(1 << n_filters):
        for f in range(n_filters):
            if before >> f & 1:
                continue
            left = difference(lists[f], union[before])
            if before >> f == 0:
                union[before | 1 << f] = merge(union[before], left)
            out.append((before, f, count(left), count(left, good), count(left, toxic)))
    table = pd.concat([pd.DataFrame({"code": np.arange(n_parts), "before": b, "filter": f, "n": n, "good": g, "toxic": t}) for b, f, n, g, t in out])
    return table[table["n"] > 0]


def _ranges(batches: Iterator[pa.RecordBatch], n_filters: int) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []

    def flush() -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        coded = t["part"].combine_chunks().dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        flag = lambda c: t[c].to_numpy().astype(np.float64)
        got = _sizes(codes, pc.fill_null(t["id"], -1).to_numpy(), t["bits"].to_numpy(), flag("good"), flag("toxic"), n_filters)
        names = coded.dictionary.take(pa.array(got.pop("code").to_numpy()))
        return pa.RecordBatch.from_arrays([names, *[pa.array(got[c].to_numpy(), pa.int64()) for c in got]], names=["part", *got])

    for b in batches:
        for k in range(0, len(b), RANGE):
            piece = b.slice(k, RANGE)
            if held and sum(map(len, held)) + len(piece) > RANGE:
                yield flush()
                held = []
            held.append(piece)
    if sum(map(len, held)):
        yield flush()


def _orders(batches: Iterator[pd.DataFrame], names: Sequence[str]) -> Iterator[pd.DataFrame]:
    """Per part: every order and step, from the sizes of its differences."""
    n = len(names)
    every = list(itertools.permutations(range(n)))
    for pdf in batches:
        for part, sizes in zip(pdf["part"], pdf["sizes"], strict=True):
            at = {(int(s["before"]), int(s["filter"])): (int(s["n"]), int(s["good"]), int(s["toxic"])) for s in sizes}
            get = lambda before, f: at.get((before, f), (0, 0, 0))  # noqa: E731, B023
            rows, total = [], [0] * n
            for order in every:
                before, kept = 0, get(0, -1)[0]
                for step, f in enumerate(order):
                    removed, good, toxic = get(before, f)
                    total[f] += removed
                    kept -= removed
                    rows.append((part, "".join(names[i] for i in order), step + 1, kept, removed, get(0, f)[0] - removed,
                                 get((1 << n) - 1 - (1 << f), f)[0], good, toxic, f))
                    before |= 1 << f
            out = pd.DataFrame(rows, columns=["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "f"])
            out["shapley"] = np.array(total, np.int64)[out.pop("f").to_numpy()]
            yield out


def interactions(failures: DataFrame, labels: DataFrame, names: Sequence[str] = FILTERS, label_id: str = "doc_id") -> DataFrame:
    """``failures`` (id, part, bits) and ``labels`` (id, quality, toxic) -> one row per part, order of the filters and step:
    kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley. ``names`` has a letter per bit."""
    prepare(failures)
    n = len(names)
    marks = written(labels.groupBy(F.col(label_id).cast("long").alias("id")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")), "marks")
    rows = failures.join(marks, "id", "left").select(
        "id", "part", "bits", *[F.coalesce(c, F.lit(False)).cast("int").alias(c) for c in ("good", "toxic")])
    counts = ["n", "good", "toxic"]
    sizes = rows.mapInArrow(lambda it: _ranges(it, n), "part string, before long, filter long, n long, good long, toxic long") \
        .groupBy("part", "before", "filter").agg(*[F.sum(c).alias(c) for c in counts])
    whole = sizes.groupBy("part").agg(F.collect_list(F.struct("before", "filter", *counts)).alias("sizes"))
    return whole.mapInPandas(lambda it: _orders(it, names), "part string, filter_order string, step int, kept long, removed long, redundant long, "
                             "unique_fails long, good_lost long, toxic_lost long, shapley long")


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters of ``document_failures`` on ``documents`` and ``labels``."""
    return interactions(document_failures(docs), labels)
