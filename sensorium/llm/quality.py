"""Quality classifier: random Fourier features over document statistics, ridge, isotonic calibration.

Statistics of whole texts (numpy inside Arrow tasks) are standardised and mapped to
``FEATURES`` random cosines, whose products approximate a Gaussian kernel. Each partition of the training
rows sums its part of the normal equations, Spark adds the parts, and the driver solves one small
system. Raw scores are calibrated by pool-adjacent-violators on training rows kept out of the
fit. The model is a few hundred numbers; every document is scored where it lies, without a shuffle.

Labels are learnt from at most ``SAMPLE`` labelled rows (a documented bound, chosen by hash of the id); the held-out
fold (crc32 of the id as text, modulo 4, equal to 2) never takes part. Ids, languages and sources
are no inputs.

Defined results: null text counts as empty and is scored as such; a null id is not held out; repeated rows are
each scored; several labels of an id count by their mean; null labels are ignored; without any training row,
or with labels of one kind only, the score is their mean (1.0 without labels); an empty table gives no rows;
further columns are ignored, or pass through ``keep_quality``, whatever their names; a very long text is read whole, a slice of the batch by itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, filtered, prepare, runs, slices, span_hashes, written

SAMPLE = 40_000
FEATURES = 256
#: Bandwidth and ridge have the least squared error on training fold 3 after a fit on folds 0 and 1 (tried: 3 to 15, 1e-6 to 1e-3).
BANDWIDTH = 10.0
RIDGE = 1e-5
THRESHOLD = 0.7
SEED = 7

# classes of bytes
_UPPER, _LOWER, _DIGIT, _SPACE, _LINE, _STOP, _COMMA, _MARK, _OTHER, _HIGH = range(10)
_CLASS = np.array([
    _UPPER if 65 <= b <= 90 else _LOWER if 97 <= b <= 122 else _DIGIT if 48 <= b <= 57 else _LINE if b in (10, 13)
    else _SPACE if b in (9, 11, 12, 32) else _STOP if b in b".?" else _COMMA if b in b",;:'\"-()" else _HIGH if b >= 128
    else _MARK if b in b"!#$%&*|<>{}[]\\^~_=+@/`" else _OTHER for b in range(256)], np.int64)
N_STATS = 20


def statistics(texts: list[bytes]) -> np.ndarray:
    """One row of ``N_STATS`` numbers per text."""
    out = np.zeros((len(texts), N_STATS))
    for lo, hi in slices(texts):
        out[lo:hi] = _statistics(texts[lo:hi])
    return out


def _statistics(texts: list[bytes]) -> np.ndarray:
    n = len(texts)
    size = np.fromiter(map(len, texts), np.int64, n)
    buf = np.frombuffer(b"".join(t + b"\n" for t in texts), np.uint8)
    limits = np.concatenate(([0], np.cumsum(size + 1)))
    kind = _CLASS[buf]
    counts = np.bincount(np.repeat(np.arange(n) * 10, size + 1) + kind, minlength=10 * n).reshape(n, 10).astype(float)
    counts[:, _LINE] -= 1  # the one put between texts
    word = (kind != _SPACE) & (kind != _LINE)
    starts, ends = runs(word)
    at = np.searchsorted(starts, limits)
    words, doc = np.diff(at), np.repeat(np.arange(n), np.diff(at))
    length = (ends - starts).astype(float)
    h = span_hashes(buf, starts, ends)
    last, first = kind[ends - 1] if len(ends) else kind[:0], kind[starts] if len(starts) else kind[:0]
    per = lambda x: np.bincount(doc, x, n)
    w, b = np.maximum(words, 1), np.maximum(size, 1)
    mean = per(length) / w
    capital = np.bincount(doc, _all_upper(kind, starts, ends), n)
    lines = counts[:, _LINE] + 1
    stats = [
        np.log1p(size), np.log1p(words), mean, np.sqrt(np.maximum(per(length ** 2) / w - mean ** 2, 0)),
        *(counts[:, c] / b for c in (_UPPER, _DIGIT, _SPACE, _LINE, _STOP, _COMMA, _MARK, _OTHER, _HIGH)),
        per(last == _MARK) / w, per(first == _UPPER) / w, capital / w, np.log1p(words / lines), per(length == 1) / w,
        _distinct(h, doc, n) / w, _distinct(_triples(h, doc), doc, n) / w,
    ]
    return np.stack(stats, axis=1)


def _all_upper(kind: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    upper, lower = (np.concatenate(([0], np.cumsum(kind == c))) for c in (_UPPER, _LOWER))
    return ((upper[ends] - upper[starts] > 1) & (lower[ends] == lower[starts])).astype(float)


def _triples(h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """A hash of each word with the two after it (fewer at the end of a text's slice of words)."""
    out = h * np.uint64(3)
    for k, f in ((1, 5), (2, 7)):
        if len(h) > k:
            out[:-k] += np.where(doc[k:] == doc[:-k], h[k:] * np.uint64(f), np.uint64(k))
    return out


def _distinct(h: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    u = np.unique(h + doc.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03), return_index=True)[1]
    return np.bincount(doc[u], minlength=n)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # statistics x features
    phase: np.ndarray
    beta: np.ndarray | None
    knots: np.ndarray
    levels: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.cos(np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights + self.phase) * np.sqrt(2 / len(self.phase))
        return np.concatenate((z, np.ones((len(x), 1))), axis=1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.beta

    def score(self, texts: list[bytes]) -> np.ndarray:
        if self.beta is None:
            return np.full(len(texts), float(self.levels[0]))
        return np.clip(np.interp(self.raw(statistics(texts)), self.knots, self.levels), 0, 1)


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over sorted ``x``: the centre and level of each block."""
    blocks: list[list[float]] = []  # weight, sum of y, sum of x
    for a, b, c in zip(x, y, w, strict=True):
        blocks.append([c, b * c, a * c])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            top = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], top, strict=True)]
    return np.array([b[2] / b[0] for b in blocks]), np.array([b[1] / b[0] for b in blocks])


#: Parts of the sample's hash: fine enough for any number of labels.
_FINE = 1 << 60


def _fold(id_: Column) -> Column:
    return F.crc32(F.coalesce(id_.cast("string"), F.lit(""))) % 4


def _training(docs: DataFrame, labels: DataFrame, sample: int, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(fold, y, x): statistics of at most about ``sample`` labelled documents outside the held-out fold."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y")) \
        .filter(F.col("id").isNotNull() & F.col("y").isNotNull() & (_fold(F.col("id")) != 2)).groupBy("id").agg(F.avg("y").alias("y"))
    n = known.count()
    if n > sample:
        known = known.filter(F.pmod(F.xxhash64("id"), F.lit(_FINE)) < int(_FINE * sample / n))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")) \
        .join(F.broadcast(known), "id").select(_fold(F.col("id")).cast("long").alias("fold"), "y", "text")  # at most ``sample`` pairs of numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = statistics(as_bytes(b.column(2)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(list(x), pa.list_(pa.float64()))], names=["fold", "y", "x"])

    return written(rows.mapInArrow(run, "fold long, y double, x array<double>"), "quality-training")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality") -> Model:
    prepare(docs)
    train = _training(docs, labels, sample, id_col, text_col, label_col)
    parts = [F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")) for c in (F.col("x")[k] for k in range(N_STATS))]
    sums = train.agg(F.count("*").alias("n"), F.avg("y").alias("y"), F.min("y").alias("lo"), F.max("y").alias("hi"), F.array(*parts).alias("x")).first()
    rng = np.random.default_rng(SEED)
    model = Model(np.zeros(N_STATS), np.ones(N_STATS), rng.normal(0, 1 / BANDWIDTH, (N_STATS, FEATURES)) * np.sqrt(2),
                  rng.uniform(0, 2 * np.pi, FEATURES), None, np.zeros(1), np.ones(1))
    if not sums["n"] or sums["lo"] == sums["hi"]:
        model.levels = np.array([1.0 if not sums["n"] else sums["y"]])
        return model
    model.mean = np.array([v["m"] for v in sums["x"]])
    model.scale = np.array([v["s"] if v["s"] > 1e-9 else 1.0 for v in sums["x"]])
    fit_rows = train.filter("fold <> 3")
    a, b = _normal_equations(fit_rows, model)
    model.beta = np.linalg.solve(a + RIDGE * max(a[-1, -1], 1) * np.eye(len(a)), b)
    model.knots, model.levels = _calibration(train.filter("fold = 3"), model)
    return model


def _normal_equations(train: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Z'Z and Z'y, summed by each partition and then by cell."""
    d = FEATURES + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d + 1))
        for b in batches:
            z = model.features(np.array(b.column(1).to_pylist(), float).reshape(-1, N_STATS))
            total[:, :d] += z.T @ z
            total[:, d] += z.T @ b.column(0).to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d)), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "v"])

    cells = train.select("y", "x").mapInArrow(run, "i long, v array<double>").select("i", F.posexplode("v").alias("j", "v")) \
        .groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((d, d + 1))
    for r in cells.collect():  # d * (d + 1) numbers, whatever the input
        out[r["i"], r["j"]] = r["v"]
    return out[:, :d], out[:, d]


def _calibration(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic levels over raw scores, gathered in bins of a thousandth."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = model.raw(np.array(b.column(1).to_pylist(), float).reshape(-1, N_STATS))
            yield pa.RecordBatch.from_arrays([pa.array(np.round(np.clip(raw, -1, 2) * 1000).astype(np.int64)), b.column(0)], names=["bin", "y"])

    bins = rows.select("y", "x").mapInArrow(run, "bin long, y double").groupBy("bin").agg(F.count("*").alias("n"), F.avg("y").alias("y")).orderBy("bin").collect()
    if not bins:
        return np.array([0.0, 1.0]), np.array([0.0, 1.0])
    return isotonic(np.array([r["bin"] / 1000 for r in bins]), np.array([r["y"] for r in bins]), np.array([r["n"] for r in bins], float))


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, held_out, score, predicted."""
    model = fit(docs, labels, id_col=id_col, text_col=text_col)
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(as_bytes(b.column(1))), pa.float64())], names=["id", "score"])

    out = picked.mapInArrow(run, f"id {picked.schema['id'].dataType.simpleString()}, score double")
    return out.select(F.col("id").alias(id_col), (F.col("id").isNotNull() & (_fold(F.col("id")) == 2)).alias("held_out"), "score",
                      F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


def keep_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, all columns unchanged."""
    model, at = fit(docs, labels, id_col=id_col, text_col=text_col), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(model.score(as_bytes(b.column(at))) >= THRESHOLD))

    return filtered(docs, run)
