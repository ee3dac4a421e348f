"""Benchmark decontamination with training suffix arrays.

Documents are read where they lie (no shuffle). Each slice of a partition is a shard with a
suffix array over its words, sorted by 27 words (three rounds of rank triples). The suffixes of
all benchmark items are binary-searched in every shard by their first 13 words (a shorter item by all of its words); suffixes that
agree there are searched once. The array's range holds all places of such a window, and ranges of one length don't overlap,
so a shard lists at most 13 places a word, however repetitive document and benchmark are. Hit words are
compared by their bytes. Each run of hit words is covered by verbatim matches, every one extended from its
window as far as document and item agree. Documents with enough hit words are contaminated and removed.

The benchmark is the query set. Executors cut it into pieces of at most ``BLOCK_WORDS`` words (a longer item into pieces that
share ``window`` - 1 words, so every window lies in one), and the driver hands them on in blocks of that size, ``PASS_BLOCKS``
blocks a pass. Up to that size one pass over the documents does it all, and a shard is sorted once. A larger benchmark takes
more passes over a stored copy of the documents, each with its own broadcasts only, and the hits of a document are joined by its
row number; so neither the driver nor a worker holds more than the blocks of a pass, whatever the benchmark's size. The rows are the same
either way.

Defined results: null text has no words and is clean; an item without words never matches; items that
share an item_id count once, a null item_id reads as an empty string; repeated document rows are judged
each; a very long text is a shard of its own; a match in an item of over ``BLOCK_WORDS`` words ends with its piece, and the next goes on from there;
empty tables give empty or clean results; further columns pass through
``remove_contaminated``, whatever their names.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, filtered, prepare, quoted, ranges, runs, slices, span_hashes, written

WINDOW = 13
#: Contaminated from one hit word in so many.
MIN_SHARE = 20
#: Words of benchmark text searched at a time.
BLOCK_WORDS = 200_000
#: Blocks that are broadcast together, for one pass over the documents.
PASS_BLOCKS = 10

#: A-Z in lower case; bytes that end a word become spaces. Bytes from 0x80 belong to words, so this equals
#: cutting the decoded text at [\x00-\x2F\x3A-\x60\x7B-\x7F].
_FOLD = bytes(b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


class Words:
    """The words of some texts: hashes (0 after each text's last), places in the folded bytes, and the text of each."""

    def __init__(self, texts: list[bytes]):
        self.raw = (b" ".join(texts) + b" ").translate(_FOLD)
        buf = np.frombuffer(self.raw, np.uint8)
        self.starts, self.ends = runs(buf != 32)
        limits = np.concatenate(([0], np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))))
        at = np.searchsorted(self.starts, limits)
        self.counts = np.diff(at)
        h = span_hashes(buf, self.starts, self.ends)
        # token t of text d is word t - d
        self.text_of = np.repeat(np.arange(len(texts)), self.counts + 1)
        self.tokens = np.zeros(len(h) + len(texts), np.uint64)
        self.tokens[np.arange(len(h)) + np.repeat(np.arange(len(texts)), self.counts)] = h
        self.first = np.cumsum(self.counts + 1) - (self.counts + 1)

    def word(self, token: int) -> bytes:
        w = token - int(self.text_of[token])
        return self.raw[self.starts[w]:self.ends[w]]


def suffix_array(tokens: np.ndarray) -> np.ndarray:
    """Token positions in the order of their next 27 tokens."""
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    for span, last in ((1, False), (3, False), (9, True)):
        wide = np.concatenate((rank + 1, np.zeros(2 * span, np.int64)))
        n, top = len(rank), int(wide.max()) + 1
        if top < 1 << 21:
            key = (wide[:n] * top + wide[span:n + span]) * top + wide[2 * span:n + 2 * span]
            if last:
                return np.argsort(key)
            rank = np.unique(key, return_inverse=True)[1].astype(np.int64)
        else:  # over two million ranks: pairs first
            pair = np.unique(wide[:n] * top + wide[span:n + span], return_inverse=True)[1].astype(np.int64)
            key = pair * top + wide[2 * span:n + 2 * span]
            if last:
                return np.argsort(key)
            rank = np.unique(key, return_inverse=True)[1].astype(np.int64)
    return np.argsort(rank)


class Block:
    """The distinct windows of some benchmark items, ready to search, and where each occurs in the items."""

    def __init__(self, items: list[tuple], window: int):
        self.ids = [i[0] for i in items]
        self.base = [sum(i[2:]) for i in items]  # a piece's first word in its item
        self.words = w = Words([i[1] for i in items])
        n = w.counts
        size = np.minimum(n, window)
        each = np.where(n > 0, n - size + 1, 0)
        item = np.repeat(np.arange(len(items)), each)
        offset = ranges(np.zeros(len(items), np.int64), each)
        depth = np.repeat(size, each)
        padded = np.concatenate((w.tokens, np.zeros(window, np.uint64)))
        rows = padded[(w.first[item] + offset)[:, None] + np.arange(window)]
        rows[np.arange(window) >= depth[:, None]] = 0
        first, same = _distinct(rows)
        self.query, self.depth = rows[first], depth[first]
        self.item, self.offset = item[first], offset[first]  # one place of each window
        # the items of window k: owners[bounds[k]:bounds[k + 1]]
        pairs = np.unique(same * max(1, len(items)) + item)
        self.owners = pairs % max(1, len(items))
        self.bounds = np.searchsorted(pairs // max(1, len(items)), np.arange(len(first) + 1))
        self.vocabulary: dict[int, bytes] = {}
        for token in np.flatnonzero(w.tokens).tolist():
            if self.vocabulary.setdefault(int(w.tokens[token]), w.word(token)) != w.word(token):
                raise ValueError("two benchmark words share a 64-bit hash")


def _distinct(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of equal rows the first one's place, and for each row which of these equals it."""
    if not len(rows):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    mixed = np.zeros(len(rows), np.uint64)
    for column in rows.T:
        mixed = (mixed ^ (column + (mixed >> np.uint64(31)))) * np.uint64(0x9E3779B97F4A7C15)
    _, first, same = np.unique(mixed, return_index=True, return_inverse=True)
    if (rows[first][same] != rows).any():  # rows that merely share the mixed value
        _, first, same = np.unique(rows, axis=0, return_index=True, return_inverse=True)
    return first, same.ravel()


def _bound(tokens: np.ndarray, order: np.ndarray, block: Block, upper: bool) -> np.ndarray:
    """Binary search of every window at once: the first place in ``order`` not below (or above) it."""
    width = block.query.shape[1]
    beyond = np.arange(width) >= block.depth[:, None]
    lo, hi = np.zeros(len(block.item), np.int64), np.full(len(block.item), len(order), np.int64)
    every = np.arange(len(lo))
    while (lo < hi).any():
        mid = np.minimum((lo + hi) >> 1, len(order) - 1)
        seen = tokens[order[mid][:, None] + np.arange(width)]
        seen[beyond] = 0
        at = (seen != block.query).argmax(axis=1)
        a, b = seen[every, at], block.query[every, at]
        right = ((a <= b) if upper else (a < b)) & (lo < hi)
        lo, hi = np.where(right, mid + 1, lo), np.where(right | (lo >= hi), hi, mid)
    return lo


class _Places:
    """Where the windows of a block occur in a shard: ``at`` (document token) and ``window``, without places whose bytes differ."""

    def __init__(self, docs: Words, order: np.ndarray, padded: np.ndarray, block: Block):
        self.at = self.window = np.zeros(0, np.int64)
        if not len(block.item) or not len(order):
            return
        lo, hi = _bound(padded, order, block, False), _bound(padded, order, block, True)
        n = hi - lo
        self.at, self.window = order[ranges(lo, n)], np.repeat(np.arange(len(n)), n)
        if not len(self.at):
            return
        edge = np.zeros(len(docs.tokens) + 1, np.int64)
        np.add.at(edge, self.at, 1)
        np.add.at(edge, self.at + block.depth[self.window], -1)
        hit = np.flatnonzero(np.cumsum(edge[:-1]) > 0).tolist()
        wrong = np.zeros(len(docs.tokens) + 1, np.int64)
        wrong[1:][[t for t in hit if docs.word(t) != block.vocabulary[int(docs.tokens[t])]]] = 1
        if wrong.any():
            before = np.cumsum(wrong)
            right = before[self.at + block.depth[self.window]] == before[self.at]
            self.at, self.window = self.at[right], self.window[right]


def _owners(docs: Words, places: _Places, block: Block, limit: int = 1 << 20) -> np.ndarray:
    """Distinct (text, item) pairs, as text * items + item."""
    n_texts, n_items = len(docs.counts), len(block.ids)
    seen = np.unique(places.window * n_texts + docs.text_of[places.at])
    window, text = seen // n_texts, seen % n_texts
    many = np.diff(block.bounds)[window]
    out, lo = np.zeros(0, np.int64), 0
    while lo < len(seen):  # as many at a time as expand to the limit
        hi = max(lo + 1, int(np.searchsorted(np.cumsum(many[lo:]), limit, side="right")) + lo)
        part = slice(lo, hi)
        items = block.owners[ranges(block.bounds[window[part]], many[part])]
        out = np.union1d(out, np.repeat(text[part], many[part]) * n_items + items)
        lo = hi
    return out


def _agree(docs: Words, at: int, block: Block, start: int) -> int:
    """How many words from document token ``at`` and item token ``start`` on are equal."""
    n, step = 0, 64
    while True:
        a, b = docs.tokens[at + n:at + n + step], block.words.tokens[start + n:start + n + step]
        k = min(len(a), len(b))
        differ = np.flatnonzero((a[:k] != b[:k]) | (a[:k] == 0))
        if len(differ) or k < step:
            n += int(differ[0]) if len(differ) else k
            break
        n, step = n + k, 2 * step
    return next((i for i in range(n) if docs.word(at + i) != block.words.word(start + i)), n)


def cover(docs: Words, places: _Places, block: Block) -> Iterator[tuple[int, int, int, int]]:
    """Verbatim matches that hold all hit words, as (document token, item, item word, words): each is extended from a
    window as far as it goes, and the next starts from the first window that isn't inside it."""
    by = np.lexsort((-block.depth[places.window], places.at))
    until = 0
    for at, window in zip(places.at[by].tolist(), places.window[by].tolist(), strict=True):
        if at + int(block.depth[window]) <= until:
            continue
        item, offset = int(block.item[window]), int(block.offset[window])
        n = _agree(docs, at, block, int(block.words.first[item]) + offset)
        until = at + n
        yield at, item, offset, n


def search(texts: list[bytes], blocks: Iterable[Block], window: int = WINDOW) -> Iterator[tuple[int, list[tuple[int, int]], list[str], list]]:
    """(n_words, runs of hit words, item ids, matches) of each text; a run is (first word, word after its last), a match
    (first word, item id, item word, words)."""
    for lo, hi in slices(texts):
        docs = Words(texts[lo:hi])
        padded = np.concatenate((docs.tokens, np.zeros(window, np.uint64)))
        order = suffix_array(docs.tokens)
        order = order[docs.tokens[order] != 0]
        edge = np.zeros(len(docs.tokens) + 1, np.int64)
        items: list[set] = [set() for _ in range(hi - lo)]
        matches: list[list] = [[] for _ in range(hi - lo)]
        for b in blocks:
            places = _Places(docs, order, padded, b)
            if not len(places.at):
                del b
                continue
            np.add.at(edge, places.at, 1)
            np.add.at(edge, places.at + b.depth[places.window], -1)
            for pair in _owners(docs, places, b).tolist():
                items[pair // len(b.ids)].add(b.ids[pair % len(b.ids)])
            for at, item, off, n in cover(docs, places, b):
                d = int(docs.text_of[at])
                matches[d].append((at - int(docs.first[d]), b.ids[item], b.base[item] + off, n))
            del b, places  # before the next one is built
        starts, ends = runs(np.cumsum(edge[:-1]) > 0)  # the token after a text's last word is never hit
        of = np.searchsorted(starts, np.append(docs.first, len(docs.tokens)))
        for d in range(hi - lo):
            at, first = slice(of[d], of[d + 1]), docs.first[d]
            spans = list(zip((starts[at] - first).tolist(), (ends[at] - first).tolist(), strict=True))
            yield int(docs.counts[d]), spans, sorted(items[d]), sorted(matches[d])


def scan(texts: list[bytes], blocks: Iterable[Block], window: int = WINDOW) -> Iterator[tuple[int, int, list[str], list]]:
    """(n_words, n_hit, item ids, matches) of each text, as in ``search``."""
    for n, spans, items, matches in search(texts, blocks, window):
        yield n, sum(hi - lo for lo, hi in spans), items, matches


def pieces(texts: list[bytes], window: int, limit: int) -> Iterator[tuple[int, bytes, int, int]]:
    """(text, piece, its first word, its words): every run of ``window`` words lies whole in a piece of at most ``limit`` words."""
    limit = max(limit, window)
    for k, text in enumerate(texts):
        starts, ends = runs(np.frombuffer(text.translate(_FOLD), np.uint8) != 32)
        n = len(starts)
        for lo in range(0, max(n - window + 1, min(n, 1)), limit - window + 1):
            hi = min(n, lo + limit)
            yield k, text[starts[lo]:ends[hi - 1]], lo, hi - lo


def benchmark_passes(bench: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> Iterator[list[list]]:
    """The benchmark in blocks of (item id, text, first word), ``PASS_BLOCKS`` blocks at a time; the driver holds one such list
    and a partition of pieces."""
    limit = BLOCK_WORDS

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_pylist()
            for k, text, first, n in pieces(as_bytes(b.column(1)), window, limit):
                yield pa.RecordBatch.from_arrays([pa.array([ids[k]], pa.string()), pa.array([text], pa.binary()),
                                                  pa.array([first], pa.int64()), pa.array([n], pa.int64())], names=["i", "t", "first", "n"])

    rows = bench.select(F.coalesce(quoted(id_col).cast("string"), F.lit("")).alias("i"), quoted(text_col).alias("t"))
    blocks, size = [], limit
    for r in written(rows.mapInArrow(cut, "i string, t binary, first long, n long"), "benchmark").toLocalIterator():
        if size + r["n"] > limit:
            if len(blocks) == PASS_BLOCKS:
                yield blocks
                blocks = []
            blocks.append([])
            size = 0
        blocks[-1].append((r["i"], bytes(r["t"]), r["first"]))
        size += r["n"]
    if blocks:
        yield blocks


class _Blocks:
    """The blocks of a task: each is built when its turn comes, for every batch of documents anew unless it is the only one."""

    def __init__(self, sent: list, window: int):
        self.sent, self.window = sent, window
        self.only = [Block(b.value, window) for b in sent] if len(sent) == 1 else None

    def __iter__(self) -> Iterator[Block]:
        yield from self.only or (Block(b.value, self.window) for b in self.sent)


_MATCH = pa.list_(pa.struct([("doc_word", pa.int64()), ("item_id", pa.string()), ("item_word", pa.int64()), ("n_words", pa.int64())]))
_FOUND = "n_words long, spans array<struct<lo:long,hi:long>>, items array<string>, matches array<struct<doc_word:long,item_id:string,item_word:long,n_words:long>>"


def _found(rows: DataFrame, sent: list, window: int, only_hits: bool) -> DataFrame:
    """``rows`` (columns of the row, the text last) -> those columns but the text, and what one pass finds in it."""
    kept = rows.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = _Blocks(sent, window)
        for b in batches:
            got = list(search(as_bytes(b.column(len(kept))), blocks, window))
            if only_hits:
                b = b.filter(pa.array([bool(g[1]) for g in got], pa.bool_()))
                got = [g for g in got if g[1]]
            yield pa.RecordBatch.from_arrays([
                *b.columns[:len(kept)], pa.array([g[0] for g in got], pa.int64()),
                pa.array([[{"lo": lo, "hi": hi} for lo, hi in g[1]] for g in got], pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))),
                pa.array([g[2] for g in got], pa.list_(pa.string())),
                pa.array([[dict(zip(("doc_word", "item_id", "item_word", "n_words"), m, strict=True)) for m in g[3]] for g in got], _MATCH),
            ], names=[*kept, "n_words", "spans", "items", "matches"])

    schema = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in kept)
    return rows.mapInArrow(run, f"{schema}, {_FOUND}")


def _hit_words(spans: Column) -> Column:
    """How many words lie in any of the runs."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto"))
    return F.aggregate(F.array_sort(spans), start, lambda a, s: F.struct(
        (a["n"] + F.greatest(F.lit(0).cast("long"), s["hi"] - F.greatest(s["lo"], a["upto"]))).alias("n"),
        F.greatest(a["upto"], s["hi"]).alias("upto")))["n"]


def _in_passes(numbered: DataFrame, passes: Iterator[list[list]], window: int, every: bool) -> DataFrame:
    """What all passes find in ``numbered`` (number, columns of the row, the text last), without the text; rows without a hit only if ``every``."""
    sc, kept, found = numbered.sparkSession.sparkContext, numbered.columns[1:-1], []
    for blocks in passes:
        sent = [sc.broadcast(b) for b in blocks]
        found.append(written(_found(numbered, sent, window, bool(found) or not every), "benchmark-hits"))
        for b in sent:
            b.destroy()
    return reduce(DataFrame.union, found).groupBy("number").agg(
        *[F.first(c).alias(c) for c in kept], F.max("n_words").alias("n_words"),
        *[F.flatten(F.collect_list(c)).alias(c) for c in ("spans", "items", "matches")])  # one document's, over the passes


def is_contaminated(n_words: int | Column, n_hit: int | Column) -> bool | Column:
    return (n_hit > 0) & (MIN_SHARE * n_hit >= n_words)


def _all_or_first(bench: DataFrame, window: int) -> tuple[list, Iterator[list[list]] | None]:
    """The benchmark's broadcast blocks if they are one pass, else its passes."""
    sc, todo = bench.sparkSession.sparkContext, benchmark_passes(bench, window)
    blocks, more = next(todo, []), next(todo, None)
    if more is None:
        return [sc.broadcast(b) for b in blocks], None
    return [], itertools.chain([blocks, more], todo)


def contamination(docs: DataFrame, bench: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per document: id, n_words, n_hit, n_items, items_sha256, contaminated, matches."""
    prepare(docs)
    sent, passes = _all_or_first(bench, window)
    rows = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"))
    if passes is None:
        found = _found(rows, sent, window, False)
    else:
        found = _in_passes(written(rows.select(F.monotonically_increasing_id().alias("number"), "id", "text"), "benchmark-rows"), passes, window, True)
    items = F.array_sort(F.array_distinct("items"))
    found = found.select("id", "n_words", _hit_words(F.col("spans")).alias("n_hit"), items.alias("items"), F.array_sort("matches").alias("matches"))
    return found.select(F.col("id").alias(id_col), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), is_contaminated(F.col("n_words"), F.col("n_hit")).alias("contaminated"),
                        "matches")


def remove_contaminated(docs: DataFrame, bench: DataFrame, window: int = WINDOW, text_col: str = "text") -> DataFrame:
    """``docs`` without the contaminated rows, all columns unchanged."""
    prepare(docs)
    (sent, passes), at = _all_or_first(bench, window), docs.columns.index(text_col)
    if passes is not None:
        plain = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
        plain = written(plain.select(F.monotonically_increasing_id().alias("number"), *plain.columns), "benchmark-rows")
        found = _in_passes(plain.select("number", f"c{at}"), passes, window, False)
        bad = found.filter(is_contaminated(F.col("n_words"), _hit_words(F.col("spans"))))
        return plain.join(bad.select("number"), "number", "left_anti").drop("number").toDF(*docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = _Blocks(sent, window)
        for b in batches:
            yield b.filter(pa.array([not is_contaminated(n, h) for n, h, _, _ in scan(as_bytes(b.column(at)), blocks, window)], pa.bool_()))

    return filtered(docs, run)
