"""Suffix-array deduplication: every byte inside a string of ``LENGTH`` bytes that also starts earlier is removed.

The work is exact and never sorts all suffixes of the corpus in one place:

1. Documents are packed into units of about ``UNIT_BYTES`` (a compressed table in the shared folder).
2. Each window of ``LENGTH`` bytes has an anchor: the rightmost of its substrings of ``GRAM`` bytes with the least hash. Equal
   windows have equal anchors at equal offsets, so only windows whose anchor occurs twice can repeat. Units
   exchange their distinct anchor hashes with counts, and learn which occur again, and which very often.
   In the same exchange go hashes of content-defined chunk pairs: in a pair that is not the first of its kind every window repeats.
   Chunks have at least LENGTH bytes, so each window lies in a pair, and the first place of any window lies in first pairs only.
3. What is left (windows of first pairs whose anchor occurs again) is sent by anchor, as the anchor's suffix with
   the bytes before it. The suffixes of an anchor are sorted by hashed comparisons (``suffix_sort``): windows at one
   offset are equal if they are neighbours by a common extension of the rest of the window and have equal bytes before the anchor.
   All but the first of equal windows repeat; their bytes are compared.
4. Anchors that occur at ``HOT`` places or more (a passage of a third of all documents) would be large groups: their windows go
   through the exchange of step 2, by 128-bit hash, one row per unit and hash, however often it occurs there.
5. Each unit unites its windows to spans and removes them.

A unit sends each distinct hash once, so a hot key costs one small entry per unit. Order is by id, then place.

Defined results: null text is empty; ids are integers, null ones come after all others; rows that repeat an id come in the
order of their units; texts below LENGTH bytes lose nothing; a very long text is a unit of its own; an empty table gives no rows; further
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, prefix_hashes, prepare, quoted, ranges, runs, written
from .suffix_sort import Suffixes

LENGTH = 100
GRAM = 24
UNIT_BYTES = 1 << 20
#: Context bytes whose suffixes are sorted together (an anchor's contexts are below HOT, so a few hundred kB).
LOT_BYTES = 2 << 20
CHUNK_MIN, CHUNK_MAX, CHUNK_MASK = 128, 2048, 127
HOT = 5000
#: Text bytes whose hashes and contexts share a bucket of an exchange: a task's part doesn't grow with the input.
BUCKET_BYTES = 16 << 20
_POS_BITS = 31  # a unit is one document or below UNIT_BYTES, and no Spark string has more bytes
_NO_ID = np.iinfo(np.int64).max

_EXCHANGE = "bucket long, unit long, pair_a binary, pair_b binary, pair_id binary, anchor binary, places binary"
_REPLY = "unit long, bucket long, first binary, again binary, hot binary"
_CONTEXT = ("bucket long, unit long, anchor binary, id binary, at binary, lead binary, size binary, bytes binary, "
            "hot_a binary, hot_b binary, hot_id binary, known binary, hot_at binary, hot_of binary")
_FOUND = "unit long, bucket long, known binary, first binary"


def _i64(x) -> np.ndarray:
    return np.frombuffer(x or b"", np.int64)


def _u64(x) -> np.ndarray:
    return np.frombuffer(x or b"", np.uint64)


def _table(schema: str, rows: list[dict]) -> pa.Table:
    kinds = {"long": pa.int64(), "binary": pa.binary()}
    fields = [(n, kinds[k]) for n, k in (f.split() for f in schema.split(", "))]
    return pa.Table.from_arrays([pa.array([r.get(n) for r in rows], k) for n, k in fields], names=[n for n, _ in fields])


# -- units -------------------------------------------------------------------------------------------


def _units(batches: Iterator[pa.RecordBatch], unit_bytes: int) -> Iterator[pa.RecordBatch]:
    import zstandard
    from pyspark import TaskContext

    unit = TaskContext.get().partitionId() << 32
    pack = zstandard.ZstdCompressor(level=1)
    held: list[tuple] = []
    size = 0

    def flush() -> pa.RecordBatch:
        held.sort(key=lambda d: (d[0] is None, d[0] or 0))  # stable: documents of a unit in order
        return pa.RecordBatch.from_arrays([
            pa.array([unit]), pa.array([np.array([_NO_ID if i is None else i for i, _ in held], np.int64).tobytes()]),
            pa.array([bytes(i is None for i, _ in held)]), pa.array([np.array([len(t) for _, t in held], np.int64).tobytes()]),
            pa.array([pack.compress(b"".join(t for _, t in held))], pa.binary()), pa.array([size])], names=["unit", "ids", "nulls", "sizes", "data", "n_bytes"])

    for b in batches:
        for i, t in zip(b.column(0).to_pylist(), as_bytes(b.column(1)), strict=True):
            if held and size + len(t) > unit_bytes:
                yield flush()
                unit, held, size = unit + 1, [], 0
            held.append((i, t))
            size += len(t)
    if held:
        yield flush()


class Unit:
    """The texts of a unit, its windows by anchor (runs of window starts), and its chunk pairs."""

    def __init__(self, row: dict, length: int):
        import zstandard

        self.unit, self.ids, self.nulls, self.sizes = row["unit"], _i64(row["ids"]), row["nulls"], _i64(row["sizes"])
        self.raw = zstandard.ZstdDecompressor().decompress(row["data"], max_output_size=max(1, int(self.sizes.sum())))
        self.buf = np.frombuffer(self.raw, np.uint8)
        self.offs = np.concatenate(([0], np.cumsum(self.sizes)))
        self.length = length

    def id_at(self, at: np.ndarray) -> np.ndarray:
        """The document id of places in the buffer."""
        return self.ids[np.searchsorted(self.offs, at, "right") - 1]

    def analyse(self) -> None:
        span = self.length - GRAM + 1  # substrings of a window
        n = len(self.buf)
        if n >> _POS_BITS:
            raise ValueError("a unit has too many bytes")
        self.from_, self.to, self.anchor = (np.zeros(0, np.int64) for _ in range(3))
        self.anchor_hash = np.zeros(0, np.uint64)
        self.pair_from, self.pair_to = (np.zeros(0, np.int64) for _ in range(2))
        if n < self.length:
            return
        sums, back = prefix_hashes(self.buf)
        g = (sums[GRAM:] - sums[:-GRAM]) * back[:n - GRAM + 1]
        g = (g ^ (g >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        g ^= g >> np.uint64(29)
        self.starts = ranges(self.offs[:-1], np.maximum(self.sizes - self.length + 1, 0))
        if len(self.starts):
            mask = (1 << _POS_BITS) - 1
            low = (g >> np.uint64(_POS_BITS) << np.uint64(_POS_BITS)) | (np.uint64(mask) - np.arange(len(g), dtype=np.uint64))
            w = 1
            while 2 * w <= span:  # minima over w, 2w, ... substrings, and two that overlap for the rest
                low = np.minimum(low[:len(low) - w], low[w:])
                w *= 2
            if w < span:
                low = np.minimum(low[:len(low) - (span - w)], low[span - w:])
            a = mask - (low[self.starts] & np.uint64(mask)).astype(np.int64)
            new = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1])))
            self.from_, self.anchor = self.starts[new], a[new]
            self.to = self.starts[np.concatenate((new[1:], [len(a)])) - 1]
            self.anchor_hash = g[self.anchor]
        self._pairs(np.flatnonzero(((g >> np.uint64(20)) & np.uint64(CHUNK_MASK)) == 0).tolist())

    def _pairs(self, cuts: list[int]) -> None:
        begin, until, j = [], [], 0
        for start, size in zip(self.offs[:-1].tolist(), self.sizes.tolist(), strict=True):
            if size < self.length:
                continue
            end, at, edges = start + size, start, [start]
            while at < end:
                j = bisect_left(cuts, at + CHUNK_MIN, j)
                at = min(cuts[j] if j < len(cuts) else end, at + CHUNK_MAX, end)
                edges.append(at)
            begin += edges[:-2] or edges[:1]
            until += edges[2:] or edges[1:]
        self.pair_from, self.pair_to = np.array(begin, np.int64), np.array(until, np.int64)

    def distinct_pairs(self) -> "Distinct":
        return Distinct(_digests(self.raw, self.pair_from, self.pair_to))

    def distinct_anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes, the one of each run, and counts."""
        return np.unique(self.anchor_hash, return_inverse=True, return_counts=True)


def _digests(raw: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """128-bit hashes of spans as rows of two uint64."""
    blake = hashlib.blake2b
    joined = b"".join([blake(raw[a:b], digest_size=16).digest() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)])
    return np.frombuffer(joined, np.uint64).reshape(-1, 2)


class Distinct:
    """Distinct 128-bit hashes in sorted order, the first place of each, and the hash of each place."""

    def __init__(self, h: np.ndarray):
        order = np.lexsort((np.arange(len(h)), h[:, 1], h[:, 0]))
        s = h[order]
        new = np.concatenate(([True], (s[1:] != s[:-1]).any(axis=1))) if len(s) else np.zeros(0, bool)
        self.a, self.b, self.first = s[new, 0], s[new, 1], order[new]
        self.of = np.empty(len(h), np.int64)
        self.of[order] = np.cumsum(new) - 1

    def is_first(self, winners: np.ndarray) -> np.ndarray:
        """Per place: it is the unit's first, and its hash is among the winners (indices)."""
        out = np.zeros(len(self.of), bool)
        out[self.first[winners]] = True
        return out


def _in_bucket(h: np.ndarray, buckets: int) -> dict[int, np.ndarray]:
    """Indices of the sorted hashes of each bucket that has any, in order; both sides of an exchange derive the same."""
    b = (h % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(b, kind="stable")
    keys, first = np.unique(b[order], return_index=True)
    return dict(zip(keys.tolist(), np.split(order, first[1:]), strict=False))


_NONE = np.zeros(0, np.int64)


# -- steps ----------------------------------------------------------------------------------------------


def _offer(batches: Iterator[pa.RecordBatch], length: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Step 2, out: a unit's distinct hashes by bucket."""
    for batch in batches:
        for row in batch.to_pylist():
            u = Unit(row, length)
            u.analyse()
            pairs, (anchor, _, places) = u.distinct_pairs(), u.distinct_anchors()
            ids = u.id_at(u.pair_from[pairs.first])
            by_pair, by_anchor = _in_bucket(pairs.a, buckets), _in_bucket(anchor, buckets)
            rows = [{"bucket": k, "unit": u.unit, "pair_a": pairs.a[p].tobytes(), "pair_b": pairs.b[p].tobytes(), "pair_id": ids[p].tobytes(),
                     "anchor": anchor[q].tobytes(), "places": places[q].astype(np.int32).tobytes()}
                    for k in sorted(by_pair.keys() | by_anchor) for p, q in [(by_pair.get(k, _NONE), by_anchor.get(k, _NONE))]]
            yield from _table(_EXCHANGE, rows).to_batches()


def _winners(a: np.ndarray, b: np.ndarray, ids: np.ndarray, unit: np.ndarray) -> np.ndarray:
    """Whether an entry is the first of its hash."""
    order = np.lexsort((unit, ids, b, a))
    new = np.concatenate(([True], (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1]))) if len(order) else np.zeros(0, bool)
    out = np.zeros(len(a), bool)
    out[order[new]] = True
    return out


def _split(flags: np.ndarray, counts: list[int]) -> list[bytes]:
    """Indices of the true flags within each consecutive run of ``counts`` entries, as bytes."""
    return [np.flatnonzero(f).astype(np.int32).tobytes() for f in np.split(flags, np.cumsum(counts)[:-1])]


def _match(t: pa.Table) -> pa.Table:
    """Step 2, back: which of a unit's pairs are the first of their kind, which of its anchors occur again or very often."""
    rows = t.to_pylist()
    unit = np.array([r["unit"] for r in rows], np.int64)
    n_pairs, n_anchors = [len(r["pair_a"]) // 8 for r in rows], [len(r["anchor"]) // 8 for r in rows]
    cat = lambda name, kind: np.frombuffer(b"".join(r[name] for r in rows), kind)
    first = _winners(cat("pair_a", np.uint64), cat("pair_b", np.uint64), cat("pair_id", np.int64), np.repeat(unit, n_pairs))
    of = np.unique(cat("anchor", np.uint64), return_inverse=True)[1]
    total = np.bincount(of, cat("places", np.int32)) if len(of) else np.zeros(0)
    again, hot = total[of] > 1, total[of] >= HOT
    return _table(_REPLY, [{"unit": r["unit"], "bucket": r["bucket"], "first": f, "again": a, "hot": h} for r, f, a, h in zip(
        rows, _split(first, n_pairs), _split(again & ~hot, n_anchors), _split(hot, n_anchors), strict=True)])


def _flagged(replies: list[dict], name: str, by_bucket: dict[int, np.ndarray], n: int) -> np.ndarray:
    out = np.zeros(n, bool)
    for r in replies:
        if r[name]:
            out[by_bucket[r["bucket"]][np.frombuffer(r[name], np.int32)]] = True
    return out


def _contexts(units: pa.Table, replies: pa.Table, length: int, buckets: int) -> pa.Table:
    """Steps 3 and 4, out: spans already known to repeat, and what has to be compared, by bucket."""
    out: list[dict] = []
    answers = replies.to_pylist()
    for row in units.to_pylist():
        u = Unit(row, length)
        u.analyse()
        pairs, (anchor, of, _) = u.distinct_pairs(), u.distinct_anchors()
        by_pair, by_anchor = _in_bucket(pairs.a, buckets), _in_bucket(anchor, buckets)
        first = pairs.is_first(np.flatnonzero(_flagged(answers, "first", by_pair, len(pairs.a))))
        known = np.stack((u.pair_from[~first], u.pair_to[~first]), axis=1)
        known = known[known[:, 1] - known[:, 0] >= length]
        open_ = _open(u, known)
        again, hot = (_flagged(answers, k, by_anchor, len(anchor))[of] if len(of) else np.zeros(0, bool) for k in ("again", "hot"))
        # each run's first and last window that is still open
        lo, hi = np.searchsorted(open_, u.from_), np.searchsorted(open_, u.to, "right")
        some = lo < hi
        begin, end = open_[lo[some]], open_[hi[some] - 1]
        cold = np.flatnonzero(again[some])
        rows: dict[int, dict] = {}
        h = u.anchor_hash[some][cold]
        by = _in_bucket(h, buckets)
        for k, at in by.items():
            c = cold[at]
            s, e = begin[c], end[c] + length
            rows[k] = {"anchor": h[at].tobytes(), "id": u.id_at(s).tobytes(), "at": s.tobytes(), "lead": (u.anchor[some][c] - s).tobytes(),
                       "size": (e - s).tobytes(), "bytes": u.buf[ranges(s, e - s)].tobytes()}
        c = np.flatnonzero(hot[some])
        at = ranges(begin[c], end[c] - begin[c] + 1)
        windows = Distinct(_digests(u.raw, at, at + length))
        ids = u.id_at(at[windows.first])
        for k, p in _in_bucket(windows.a, buckets).items():
            rows.setdefault(k, {}).update({"hot_a": windows.a[p].tobytes(), "hot_b": windows.b[p].tobytes(), "hot_id": ids[p].tobytes()})
        out += [{"bucket": k, "unit": u.unit, **r} for k, r in rows.items()]
        # the unit's own row: known spans, and the hot windows with their hashes in order
        out.append({"bucket": -1, "unit": u.unit, "known": known.tobytes(), "hot_at": at.tobytes(), "hot_of": windows.of.tobytes(), "hot_a": windows.a.tobytes()})
    return _table(_CONTEXT, out)


def _open(u: Unit, known: np.ndarray) -> np.ndarray:
    """The window starts outside all known spans."""
    if not len(u.from_):
        return np.zeros(0, np.int64)
    edge = np.zeros(len(u.buf) + 1, np.int32)
    np.add.at(edge, known[:, 0], 1)
    np.add.at(edge, known[:, 1] - u.length + 1, -1)
    return u.starts[np.cumsum(edge)[u.starts] == 0]


def _compare(t: pa.Table, length: int) -> pa.Table:
    """Steps 3 and 4, back: spans of repeated windows, and the units that hold the first of a hot window."""
    rows = t.to_pylist()
    unit = np.array([r["unit"] for r in rows], np.int64)
    out = [{"unit": r["unit"], "bucket": r["bucket"]} for r in rows]
    n_hot = [len(r["hot_a"] or b"") // 8 for r in rows]
    cat = lambda name, kind: np.frombuffer(b"".join(r[name] or b"" for r in rows), kind)
    first = _winners(cat("hot_a", np.uint64), cat("hot_b", np.uint64), cat("hot_id", np.int64), np.repeat(unit, n_hot))
    for o, f in zip(out, _split(first, n_hot), strict=True):
        o["first"] = f
    n = [len(r["anchor"] or b"") // 8 for r in rows]
    row = np.repeat(np.arange(len(rows)), n)
    anchor, size, buf = cat("anchor", np.uint64), cat("size", np.int64), cat("bytes", np.uint8)
    more = (cat("id", np.int64), unit[row], cat("at", np.int64), cat("lead", np.int64), size)
    begin, parts = np.cumsum(size) - size, [np.zeros((0, 3), np.int64)]
    for lot in _lots(anchor, size):
        part = repeated_spans(anchor[lot], *(x[lot] for x in more), buf[ranges(begin[lot], size[lot])], length)
        part[:, 0] = lot[part[:, 0]]
        parts.append(part)
    spans = np.concatenate(parts)
    owner = row[spans[:, 0]]
    at = cat("at", np.int64)[spans[:, 0]]
    order = np.argsort(owner, kind="stable")
    cut = np.split(np.stack((at + spans[:, 1], at + spans[:, 2]), axis=1)[order], np.searchsorted(owner[order], np.arange(1, len(rows))))
    for o, s in zip(out, cut, strict=True):
        o["known"] = s.astype(np.int64).tobytes()
    return _table(_FOUND, out)


def _lots(anchor: np.ndarray, size: np.ndarray) -> list[np.ndarray]:
    """Contexts in lots of about ``LOT_BYTES`` that keep each anchor's together."""
    order = np.argsort(anchor, kind="stable")
    total = np.cumsum(size[order])
    lots, start = [], 0
    ends = np.flatnonzero(np.concatenate((anchor[order][1:] != anchor[order][:-1], [True]))) + 1 if len(order) else []
    for end in ends:
        if total[end - 1] - (total[start - 1] if start else 0) >= LOT_BYTES or end == len(order):
            lots.append(order[start:end])
            start = end
    return lots


def repeated_spans(anchor: np.ndarray, ids: np.ndarray, unit: np.ndarray, at: np.ndarray, lead: np.ndarray, size: np.ndarray, buf: np.ndarray,
                   length: int) -> np.ndarray:
    """Rows (context, start, end): bytes of windows that an earlier context holds too, relative to the context.

    A context is ``size`` bytes of ``buf`` (one after another) with its anchor ``lead`` bytes after its start; its windows
    start at 0 .. size - length. Earlier is by (id, unit, at).
    """
    if not len(anchor):
        return np.zeros((0, 3), np.int64)
    begin = np.cumsum(size) - size
    order = np.lexsort((at, unit, ids, anchor))  # by anchor, earlier contexts first
    new = np.concatenate(([True], anchor[order][1:] != anchor[order][:-1]))
    first = np.flatnonzero(new)
    group = np.diff(np.concatenate((first, [len(order)])))
    start, end, mid = begin[order], (begin + size)[order], (begin + lead)[order]
    hashes = prefix_hashes(buf)
    suffixes = Suffixes(buf, mid, end, hashes)
    by, common = suffixes.sorted_groups(first, group)
    sums, back = hashes
    most, least = mid - start, np.maximum(mid - start - (end - start - length), 0)  # offsets of the anchor in its windows
    repeated: list[np.ndarray] = []
    for offset in range(int(least.min()), int(most.max()) + 1):
        # suffixes with the rest of the window in common stand next to one another
        block = np.empty(len(by), np.int64)
        block[by] = np.cumsum(common < length - offset)
        c = np.flatnonzero((least <= offset) & (offset <= most))
        if len(c) < 2:
            continue
        before = (sums[mid[c]] - sums[mid[c] - offset]) * back[mid[c] - offset]
        o = np.lexsort((c, before, block[c]))
        same = (block[c][o][1:] == block[c][o][:-1]) & (before[o][1:] == before[o][:-1])
        lead_of = np.maximum.accumulate(np.where(np.concatenate(([True], ~same)), np.arange(len(o)), 0))
        k = np.flatnonzero(lead_of != np.arange(len(o)))
        if len(k):
            x, y = c[o[k]], c[o[lead_of[k]]]
            equal = np.ones(len(k), bool)
            for s in range(0, len(k), 20_000):
                part = slice(s, s + 20_000)
                equal[part] = (buf[(mid[x[part]] - offset)[:, None] + np.arange(length)] == buf[(mid[y[part]] - offset)[:, None] + np.arange(length)]).all(axis=1)
            if not equal.all():
                x = _by_bytes(buf, c, mid[c] - offset, length)
            repeated.append(np.stack((order[x], mid[x] - offset - start[x]), axis=1))
    if not repeated:
        return np.zeros((0, 3), np.int64)
    w = np.concatenate(repeated)
    w = w[np.lexsort((w[:, 1], w[:, 0]))]
    fresh = np.concatenate(([True], (w[1:, 0] != w[:-1, 0]) | (w[1:, 1] != w[:-1, 1] + 1)))
    last = np.concatenate((np.flatnonzero(fresh)[1:], [len(w)])) - 1
    return np.stack((w[fresh, 0], w[fresh, 1], w[last, 1] + length), axis=1)


def _by_bytes(buf: np.ndarray, contexts: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """After a hash collision: the contexts whose window an earlier one holds, by the bytes themselves."""
    seen, out = set(), []
    for c, s in zip(contexts.tolist(), starts.tolist(), strict=True):
        w = buf[s:s + length].tobytes()
        if w in seen:
            out.append(c)
        seen.add(w)
    return np.array(out, np.int64)


def _finish(units: pa.Table, found: pa.Table, length: int, buckets: int, schema: pa.Schema) -> pa.Table:
    """Step 5: the spans of each document."""
    answers = found.to_pylist()
    own = next((r for r in answers if r["bucket"] < 0), None)
    out: list[tuple] = []
    for row in units.to_pylist():
        u = Unit(row, length)
        spans = np.concatenate([np.zeros((0, 2), np.int64), *[_i64(r["known"]).reshape(-1, 2) for r in answers if r["known"]]])
        edge = np.zeros(len(u.buf) + 1, np.int64)
        np.add.at(edge, spans[:, 0], 1)
        np.add.at(edge, spans[:, 1], -1)
        at, of, a = (_i64(own["hot_at"]), _i64(own["hot_of"]), _u64(own["hot_a"])) if own else (_i64(b""), _i64(b""), _u64(b""))
        if len(at):
            wins = _flagged([r for r in answers if r["bucket"] >= 0], "first", _in_bucket(a, buckets), len(a))
            repeat = ~wins[of]
            seen = np.unique(of, return_index=True)[1]
            later = np.ones(len(of), bool)
            later[seen] = False
            gone = at[repeat | later]
            np.add.at(edge, gone, 1)
            np.add.at(edge, gone + length, -1)
        removed = np.cumsum(edge[:-1]) > 0
        for d, (i, null) in enumerate(zip(u.ids.tolist(), u.nulls, strict=True)):
            s, e = int(u.offs[d]), int(u.offs[d + 1])
            starts, ends = runs(removed[s:e])
            kept = u.buf[s:e][~removed[s:e]].tobytes()
            out.append((None if null else i, e - s, int((ends - starts).sum()), len(starts), hashlib.sha256(kept).hexdigest(),
                        [{"start": int(p), "end": int(q)} for p, q in zip(starts, ends, strict=True)]))
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*out, strict=True)) or [()] * 6, schema, strict=True)], schema=schema)


def repeated_strings(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept_sha256, spans (byte offsets of what is removed)."""
    spark = prepare(docs)
    picked = docs.select(quoted(id_col).cast("long").alias("id"), quoted(text_col).alias("text"))
    units = written(picked.mapInArrow(lambda it: _units(it, UNIT_BYTES), "unit long, ids binary, nulls binary, sizes binary, data binary, n_bytes long"), "units")
    total = units.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_BYTES))
    units = units.drop("n_bytes")
    replies = units.mapInArrow(lambda it: _offer(it, length, buckets), _EXCHANGE).repartition(buckets, "bucket").groupBy("bucket").applyInArrow(_match, _REPLY)
    contexts = written(units.groupBy("unit").cogroup(replies.groupBy("unit"))
                       .applyInArrow(lambda a, b: _contexts(a, b, length, buckets), _CONTEXT), "contexts")
    found = contexts.filter("bucket >= 0").repartition(buckets, "bucket").groupBy("bucket").applyInArrow(lambda t: _compare(t, length), _FOUND)
    found = found.select("unit", "bucket", "known", "first", F.lit(None).cast("binary").alias("hot_at"), F.lit(None).cast("binary").alias("hot_of"),
                         F.lit(None).cast("binary").alias("hot_a"))
    own = contexts.filter("bucket < 0").select("unit", "bucket", "known", F.lit(None).cast("binary").alias("first"), "hot_at", "hot_of", "hot_a")
    schema = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()),
                        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
    out = units.groupBy("unit").cogroup(own.unionByName(found).groupBy("unit")).applyInArrow(
        lambda a, b: _finish(a, b, length, buckets, schema),
        "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>")
    return out.withColumnRenamed("id", id_col)
