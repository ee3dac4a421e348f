import hashlib
import random

import numpy as np
import pytest

from sensorium.llm import repeats as R
from sensorium.llm.suffix_sort import Suffixes


def brute(data, length=100):
    seen, out = set(), []
    for i, t in sorted(data, key=lambda d: (d[0] is None, d[0] or 0)):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            w = b[p:p + length]
            if w in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(w)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), bytes(gone).replace(b"\0", b" ").count(b"\1") and len(bytes(gone).replace(b"\0", b" ").split()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(n=60):
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice("abcdé") for _ in range(rnd.randint(1, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(k) for k in (12, 25, 30, 60, 400)]
    hot = text(35)
    data = []
    for i in range(n):
        parts = [text(rnd.choice([0, 5, 40, 300]))]
        for _ in range(rnd.randint(0, 3)):
            parts += [rnd.choice(passages), text(rnd.choice([0, 3, 50]))]
        if i % 3 == 0:
            parts.insert(1, hot)
        data.append((i * 5 % 301, "".join(parts)))
    for k in range(6):  # near copies with an edit
        t = data[k][1]
        cut = rnd.randrange(max(1, len(t)))
        data.append((400 + k, t[:cut] + "X" + t[cut + 1:]))
    data += [(500, data[3][1]), (501, data[3][1]), (502, "a" * 5000), (503, "a" * 250), (504, "abc" * 700), (505, ""), (506, None), (507, "x" * 99), (508, "y" * 100),
             (509, "y" * 100), (510, "y" * 99)]
    return data


@pytest.mark.parametrize(("hot", "unit"), [(5000, 2 << 20), (8, 3000), (10**9, 3000)])
def test_matches_brute_force(make, monkeypatch, hot, unit):
    monkeypatch.setattr(R, "HOT", hot)
    monkeypatch.setattr(R, "UNIT_BYTES", unit)
    monkeypatch.setattr(R, "LOT_BYTES", 2000 if hot == 10**9 else R.LOT_BYTES)
    data = corpus()
    df = make("doc_id long, text string, unit string", [(*d, "clash") for d in data]).repartition(3)
    # closures carry the module's names, not the patched values, to the workers: run the steps here
    got = sorted(local(data, hot, unit), key=str)
    assert got == brute(data)
    if hot == 5000:
        assert sorted([tuple(r)[:5] for r in R.repeated_strings(df).collect()], key=str) == brute(data)


def local(data, hot, unit_bytes, buckets=7, length=100):
    """The same steps in this process, with other sizes."""
    import pyarrow as pa
    import zstandard

    rows, held, size = [], [], 0
    shuffled = list(data)
    random.Random(0).shuffle(shuffled)

    def flush():
        held.sort(key=lambda d: (d[0] is None, d[0] or 0))
        rows.append({"unit": len(rows), "ids": np.array([R._NO_ID if i is None else i for i, _ in held], np.int64).tobytes(), "nulls": bytes(i is None for i, _ in held),
                     "sizes": np.array([len((t or "").encode()) for _, t in held], np.int64).tobytes(),
                     "data": zstandard.compress(b"".join((t or "").encode() for _, t in held))})
    for i, t in shuffled:
        if held and size > unit_bytes:
            flush()
            held, size = [], 0
        held.append((i, t))
        size += len((t or "").encode())
    flush()
    kinds = pa.schema([("unit", pa.int64()), ("ids", pa.binary()), ("nulls", pa.binary()), ("sizes", pa.binary()), ("data", pa.binary())])
    units = [pa.Table.from_pylist([r], kinds) for r in rows]
    offers = pa.Table.from_batches([b for u in units for b in R._offer(iter(u.to_batches()), length, buckets)])
    by = lambda t, c, v: t.filter(pa.compute.equal(t.column(c), v))
    import pyarrow.compute  # noqa: F401

    replies = pa.concat_tables([R._match(by(offers, "bucket", k)) for k in range(buckets)])
    contexts = pa.concat_tables([R._contexts(u, by(replies, "unit", n), length, buckets) for n, u in enumerate(units)])
    found = [R._compare(by(contexts, "bucket", k), length) for k in range(buckets)]
    cols = ["unit", "bucket", "known", "first", "hot_at", "hot_of", "hot_a"]
    all_ = [r | {"hot_at": None, "hot_of": None, "hot_a": None} for f in found for r in f.to_pylist()]
    all_ += [{c: r.get(c) for c in cols} | {"first": None} for r in by(contexts, "bucket", -1).to_pylist()]
    schema = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()),
                        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
    table = pa.Table.from_pylist(all_, pa.schema([("unit", pa.int64()), ("bucket", pa.int64())] + [(c, pa.binary()) for c in cols[2:]]))
    return [tuple(r.values())[:5] for n, u in enumerate(units) for r in R._finish(u, by(table, "unit", n), length, buckets, schema).to_pylist()]


def test_repeated_ids_nulls_and_empty(make):
    t = "".join(chr(97 + i * i % 26) + str(i) for i in range(100))
    got = sorted(((r.doc_id, r.n_removed) for r in R.repeated_strings(make("doc_id long, text string", [(None, t), (5, t), (5, t), (9, t[:150])])).collect()), key=str)
    assert got == sorted([(5, 0), (5, len(t)), (9, 150), (None, len(t))], key=str)
    assert R.repeated_strings(make("doc_id long, text string", [])).count() == 0


@pytest.mark.parametrize("broken", [False, True])
def test_suffix_sort(broken):
    rnd = random.Random(3)
    texts = [bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, 60))) for _ in range(300)] + [b"a" * 50, b"a" * 50, b"", b""]
    buf = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    starts = ends - [len(t) for t in texts]
    first, size = np.array([0, 100, 101]), np.array([100, 1, len(texts) - 101])
    s = Suffixes(buf, starts, ends)
    if broken:  # hashes that never differ: the bytes decide
        s.sums, s.back = np.zeros(len(buf) + 1, np.uint64), np.zeros(len(buf) + 1, np.uint64)
    order, common = s.sorted_groups(first, size)
    for f, n in zip(first, size):
        got = [texts[k] for k in order[f:f + n]]
        assert sorted(order[f:f + n]) == list(range(f, f + n)) and got == sorted(got)
        for k in range(1, n):
            a, b = got[k - 1], got[k]
            assert common[f + k] == next((i for i, (p, q) in enumerate(zip(a, b)) if p != q), min(len(a), len(b)))


def test_many_buckets(make, monkeypatch):
    """More buckets than shuffle partitions, most of them empty for a unit."""
    monkeypatch.setattr(R, "BUCKET_BYTES", 1000)
    monkeypatch.setattr(R, "UNIT_BYTES", 20_000)
    data = corpus(20)
    df = make("doc_id long, text string, `meta.lang` string, bucket long, n_bytes long", [(*d, "x", 1, 2) for d in data]).repartition(3)
    got = R.repeated_strings(df)
    assert sorted([tuple(r)[:5] for r in got.collect()], key=str) == brute(data)


def test_a_unit_beyond_the_position_bits_is_an_error(monkeypatch):
    monkeypatch.setattr(R, "_POS_BITS", 12)
    pack = lambda t: {"unit": 0, "ids": np.zeros(1, np.int64).tobytes(), "nulls": b"\0", "sizes": np.array([len(t)], np.int64).tobytes(), "data": _zstd(t)}
    R.Unit(pack(b"a" * 4095), 100).analyse()
    with pytest.raises(ValueError, match="too many bytes"):
        R.Unit(pack(b"a" * 4096), 100).analyse()


def _zstd(raw):
    import zstandard
    return zstandard.ZstdCompressor().compress(raw)
