"""Hard-negative mining with exact integer scores from a residue-number-system GEMM.

1. Vectors are quantised to integers (``floor(scale * x)``) and packed; rows that can't take part go.
2. Rows are dealt into groups of about ``GROUP`` components by a hash, anchors into blocks of about
   ``BLOCK``; a cell is one group against one block. Nothing is broadcast, and a cell's size
   doesn't grow with the data or with a label's share of it.
3. A cell multiplies the component matrices modulo several primes below 256 in float32. Centred
   residues keep each sum below 2 ** 24, so it is exact; Chinese remaindering (centred mixed-radix digits)
   gives the signed scores. The largest components of the cell decide how many primes that takes.
4. Pass one keeps each cell's best same-label rows of an anchor; a window over these few rows selects the
   positives. Pass two keeps the best different-label rows within each positive's score range, and
   a window selects the negatives.

Defined results: a row with a null label or vector, or with a null component or one that isn't finite as a
float, takes no part. Rows equal in id, label and quantised vector count once; rows that share an id and
differ otherwise are rows of their own, and an anchor is only kept from pairing with itself. A null id is
no anchor and comes after all others among ties. Vectors of different lengths have no score;
empty vectors score 0 with each other. A score beyond a long is returned as the nearest long. An empty table gives
no rows; further columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, quoted, written

POSITIVES = 5
NEGATIVES = 5
LOW, HIGH = 80, 100  # a negative's score, in hundredths of the positive's
SCALE = 256
GROUP = 1 << 20  # components of a group of rows
BLOCK = 1 << 22  # components of a block of anchors
TILE = 1024  # rows or anchors of one product
_EXACT = 1 << 24  # float32 holds every integer up to here
_LONG = (1 << 63) - 1

PRIMES = [p for p in range(255, 2, -2) if all(p % k for k in range(3, 16, 2))]


# ---------------------------------------------------------------- residue-number-system products

def _center(x: np.ndarray, p: int) -> np.ndarray:
    """``x`` modulo ``p`` as the residue nearest to zero, in place; a second round settles what rounding of the first left."""
    for _ in range(2):
        x -= np.float32(p) * np.rint(x * np.float32(1 / p))
    return x


def _residues(m: np.ndarray, p: int) -> np.ndarray:
    return _center(np.fmod(m, p).astype(np.float32), p)


def primes_for(bound: int) -> list[int]:
    """As many primes as tell apart all integers of at most ``bound`` either way."""
    size, out = 1, []
    for p in PRIMES:
        if size > 2 * bound:
            break
        out.append(p)
        size *= p
    if size <= 2 * bound:
        raise ValueError("scores exceed the range of the primes")
    return out


class Products:
    """Exact inner products of the rows of ``left`` (integers held as float64) with other matrices."""

    def __init__(self, left: np.ndarray):
        self.left = left
        self.top = int(np.abs(left).max(initial=0))
        self.cache: dict[int, np.ndarray] = {}

    def _modulo(self, right: np.ndarray, p: int) -> np.ndarray:
        if p not in self.cache:
            self.cache[p] = _residues(self.left, p)
        mine, theirs = self.cache[p], _residues(right, p)
        wide = _EXACT // ((p - 1) // 2) ** 2  # terms whose sum stays exact
        out = np.zeros((len(mine), len(theirs)), np.float32)
        for k in range(0, mine.shape[1], wide):
            out += _center(mine[:, k:k + wide] @ theirs[:, k:k + wide].T, p)
            _center(out, p)
        return out

    def __call__(self, right: np.ndarray) -> np.ndarray:
        """int64 scores [left rows, right rows]."""
        bound = self.left.shape[1] * self.top * int(np.abs(right).max(initial=0))
        primes = primes_for(bound)
        whole = np.int64 if bound < 1 << 62 else object
        total = np.zeros((len(self.left), len(right)), whole)
        digits: list[np.ndarray] = []
        radix = 1
        for i, p in enumerate(primes):
            t = self._modulo(right, p)
            for digit, q in zip(digits, primes[:i], strict=True):  # (t - digit) / q, modulo p
                inverse = pow(q, -1, p)
                t = _center((t - digit) * np.float32(inverse - p if 2 * inverse > p else inverse), p)
            digits.append(t)
            total += t.astype(np.int64).astype(whole) * radix
            radix *= p
        return total if whole is np.int64 else np.clip(total, -_LONG - 1, _LONG).astype(np.int64)


# ---------------------------------------------------------------- rows as packed integers

def _pack(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[pa.RecordBatch]:
    """(id, label, vector) -> (id, label, dim, wide, q) of the rows that take part."""
    for b in batches:
        lists = b.column(2)
        values = np.asarray(lists.values.to_numpy(zero_copy_only=False), np.float64)
        offsets = lists.offsets.to_numpy()
        with np.errstate(over="ignore", invalid="ignore"):
            fits = np.abs(values) < 2.0 ** 128
            q = np.floor(scale * np.where(fits, values, 0.0))
            narrow, full = q.astype("<i2").tobytes(), q.astype("<f8").tobytes()
        count = lambda flags: np.concatenate(([0], np.cumsum(flags)))
        odd, large = (np.diff(count(f)[offsets]) for f in (~fits, np.abs(q) >= 1 << 15))
        ok = np.flatnonzero((odd == 0) & lists.is_valid().to_numpy(zero_copy_only=False) & b.column(1).is_valid().to_numpy(zero_copy_only=False))
        cut = [full[8 * s:8 * e] if w else narrow[2 * s:2 * e]
               for s, e, w in zip(offsets[ok].tolist(), offsets[ok + 1].tolist(), (large[ok] > 0).tolist(), strict=True)]
        at = pa.array(ok)
        yield pa.RecordBatch.from_arrays(
            [b.column(0).take(at), b.column(1).take(at), pa.array(np.diff(offsets)[ok].astype(np.int32)), pa.array(large[ok] > 0), pa.array(cut, pa.binary())],
            names=["id", "label", "dim", "wide", "q"])


def _matrix(t: pa.Table) -> np.ndarray:
    """The vectors of a cell (all of one length) as float64."""
    wide = t["wide"].to_numpy()
    q = t["q"].to_pylist()
    dim = int(t["dim"][0].as_py()) if len(t) else 0
    out = np.empty((len(t), dim))
    for flag, kind in ((False, "<i2"), (True, "<f8")):
        at = np.flatnonzero(wide == flag)
        out[at] = np.frombuffer(b"".join(q[i] for i in at.tolist()), kind).reshape(len(at), dim)
    return out


def _ordered(t: pa.Table) -> pa.Table:
    return t.take(pc.sort_indices(t, [("id", "ascending"), ("sub", "ascending")], null_placement="at_end"))


def _identity(t: pa.Table) -> list[tuple]:
    return list(zip(t["id"].to_pylist(), t["sub"].to_pylist(), strict=True))


# ---------------------------------------------------------------- cells

def _best_same(anchors: pa.Table, rows: pa.Table, k: int) -> pa.Table:
    """For each anchor the ``k`` best other rows of its label in each tile of rows."""
    rows = _ordered(rows)
    a_label, r_label = (np.asarray(t["label"].to_numpy()) for t in (anchors, rows))
    a_all, r_all = _matrix(anchors), _matrix(rows)
    place = {key: i for i, key in enumerate(_identity(rows))}
    own = np.array([place.get(key, -1) for key in _identity(anchors)], np.int64)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for label in np.intersect1d(a_label, r_label):
        a_at, r_at = np.flatnonzero(a_label == label), np.flatnonzero(r_label == label)
        for i in range(0, len(a_at), TILE):
            a = a_at[i:i + TILE]
            products = Products(a_all[a])
            for j in range(0, len(r_at), TILE):
                r = r_at[j:j + TILE]
                s = products(r_all[r])
                free = r[None, :] != own[a][:, None]
                line = np.arange(len(a))
                s = np.where(free, s, -_LONG - 1)
                for _ in range(min(k, len(r))):
                    best = s.argmax(axis=1)  # the first of equals, so the smallest id
                    good = free[line, best]
                    found.append((a[good], r[best[good]], s[line, best][good]))
                    s[line, best] = -_LONG - 1
                    free[line, best] = False
    a, r, s = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (zip(*found, strict=True) if found else ((), (), ())))
    return pa.table({"id": anchors["id"].take(pa.array(a)), "sub": anchors["sub"].take(pa.array(a)),
                     "other": rows["id"].take(pa.array(r)), "other_sub": rows["sub"].take(pa.array(r)), "score": pa.array(s)})


def _within(score: np.ndarray, positive: np.ndarray, low: int, high: int) -> np.ndarray:
    """low * positive <= 100 * score <= high * positive; products that could pass a long are compared as Python integers."""
    small = (np.abs(score) < 1 << 55) & (np.abs(positive) < 1 << 55)
    out = np.zeros(len(score), bool)
    out[small] = (low * positive[small] <= 100 * score[small]) & (100 * score[small] <= high * positive[small])
    for i in np.flatnonzero(~small).tolist():
        out[i] = low * int(positive[i]) <= 100 * int(score[i]) <= high * int(positive[i])
    return out


def _best_other(anchors: pa.Table, rows: pa.Table, k: int, low: int, high: int) -> pa.Table:
    """For each positive of an anchor the ``k`` best rows of other labels within its range, in each tile of rows."""
    rows = _ordered(rows)
    a_label, r_label = (np.asarray(t["label"].to_numpy()) for t in (anchors, rows))
    a_all, r_all = _matrix(anchors), _matrix(rows)
    offsets = np.concatenate(([0], np.cumsum(pc.list_value_length(anchors["scores"]).to_numpy())))
    positive = np.concatenate([np.asarray(x, np.int64) for x in anchors["scores"].to_pylist()] or [np.zeros(0, np.int64)])
    of = np.repeat(np.arange(len(anchors)), np.diff(offsets))
    # no score below the lowest or above the highest limit of any of an anchor's positives is of use
    floor = np.minimum.reduceat(positive, offsets[:-1]).astype(np.float64) * (low / 100)
    roof = np.maximum.reduceat(positive, offsets[:-1]).astype(np.float64) * (high / 100)
    slack = 1 + 1e-9 * np.maximum(np.abs(floor), np.abs(roof))
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for i in range(0, len(a_all), TILE):
        a = np.arange(i, min(i + TILE, len(a_all)))
        products = Products(a_all[a])
        for j in range(0, len(r_all), TILE):
            s = products(r_all[j:j + TILE])
            near = (s >= (floor[a] - slack[a])[:, None]) & (s <= (roof[a] + slack[a])[:, None]) & (a_label[a][:, None] != r_label[None, j:j + TILE])
            row, col = np.nonzero(near)
            if not len(row):
                continue
            value = s[row, col]
            begin = np.searchsorted(row, np.arange(len(a) + 1))
            order = np.lexsort((col, -value, row))
            row, col, value = row[order], col[order], value[order]
            for n in range(int(np.diff(offsets).max(initial=0))):  # the n-th positive of every anchor
                has = np.diff(offsets)[a] > n
                level = np.where(has, positive[np.minimum(offsets[:-1][a] + n, len(positive) - 1)], 0)
                fits = has[row] & _within(value, level[row], low, high)
                rank = np.cumsum(fits) - np.concatenate(([0], np.cumsum(fits)))[begin[row]]
                take = np.flatnonzero(fits & (rank <= k))
                found.append((offsets[:-1][a][row[take]] + n, j + col[take], value[take]))
    p, r, s = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (zip(*found, strict=True) if found else ((), (), ())))
    a = pa.array(of[p])
    return pa.table({"id": anchors["id"].take(a), "sub": anchors["sub"].take(a), "nth": pa.array((p - offsets[:-1][of[p]]).astype(np.int32)),
                     "other": rows["id"].take(pa.array(r)), "other_sub": rows["sub"].take(pa.array(r)), "score": pa.array(s)})


def _cells(anchors: DataFrame, rows: DataFrame, groups: int, blocks: int, run: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``run`` on every block of anchors against every group of rows."""
    part = lambda n: F.pmod(F.xxhash64("id", "sub"), F.lit(n)).cast("int")
    keys = ["dim", "g", "b"]
    left = anchors.withColumns({"b": part(blocks), "g": F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))})
    right = rows.withColumns({"g": part(groups), "b": F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))})

    def cell(a: pa.Table, r: pa.Table) -> pa.Table:
        if not len(a) or not len(r):
            return pa.table({n: pa.array([], kind) for n, kind in empty.items()})
        return run(a, r)

    empty = {n: {"long": pa.int64(), "int": pa.int32()}[kind] for n, kind in (c.split() for c in schema.split(", "))}
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(cell, schema)


def mine(emb: DataFrame, is_anchor: Callable[[Column], Column], id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
         positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE) -> DataFrame:
    """One row per anchor, positive and selected negative: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor`` tells anchors by their id. An anchor's positives are the ``positives`` best other rows of its label;
    the negatives of a positive the ``negatives`` best rows of other labels with
    ``low * positive <= 100 * score <= high * positive``. Scores are integer inner products; ties go by smaller id.
    """
    prepare(emb)
    packed = emb.select(quoted(id_col).cast("long").alias("id"), quoted(label_col).cast("long").alias("label"), quoted(vec_col).alias("v")) \
        .mapInArrow(lambda it: _pack(it, scale), "id long, label long, dim int, wide boolean, q binary")
    rows = written(packed.distinct().withColumn("sub", F.xxhash64("label", "wide", "q")), "vectors")
    anchors = rows.filter(is_anchor(F.col("id")))
    size = F.sum(F.greatest(F.col("dim"), F.lit(1)).cast("long"))
    total = rows.agg(size.alias("n"), F.sum(F.when(is_anchor(F.col("id")), F.greatest(F.col("dim"), F.lit(1)).cast("long"))).alias("a")).first()
    groups, blocks = max(1, math.ceil((total.n or 0) / GROUP)), max(1, math.ceil((total.a or 0) / BLOCK))

    same = _cells(anchors, rows, groups, blocks, lambda a, r: _best_same(a, r, positives),
                  "id long, sub long, other long, other_sub long, score long")
    best = Window.partitionBy("id", "sub").orderBy(F.desc("score"), F.asc_nulls_last("other"), "other_sub")
    chosen = same.withColumn("nth", F.row_number().over(best)).filter(F.col("nth") <= positives) \
        .groupBy("id", "sub").agg(F.sort_array(F.collect_list(F.struct("nth", "other", "score"))).alias("found"))
    ready = written(anchors.join(chosen, ["id", "sub"]).select("id", "sub", "label", "dim", "wide", "q", F.col("found.other").alias("others"),
                                                              F.col("found.score").alias("scores")), "anchors")
    other = _cells(ready.drop("others"), rows, groups, blocks, lambda a, r: _best_other(a, r, negatives, low, high),
                   "id long, sub long, nth int, other long, other_sub long, score long")
    best = Window.partitionBy("id", "sub", "nth").orderBy(F.desc("score"), F.asc_nulls_last("other"), "other_sub")
    ranked = other.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= negatives)
    return ranked.join(ready.select("id", "sub", "others", "scores"), ["id", "sub"]).select(
        F.col("id").alias("anchor_id"), F.get("others", F.col("nth")).alias("positive_id"), "rank", F.col("other").alias("negative_id"),
        F.get("scores", F.col("nth")).alias("positive_score"), F.col("score").alias("negative_score"))
