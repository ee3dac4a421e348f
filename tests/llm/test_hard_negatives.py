import math
import random

import numpy as np
import pytest

from sensorium.llm import hard_negatives as hn

from .conftest import rows


def brute(data, positives=5, negatives=5):
    """data: (id, vector, label) -> the rows that mining should return, by plain Python integers."""
    seen, vectors = set(), []
    for i, v, label in data:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = tuple(math.floor(256 * float(np.float32(x))) for x in v)
        if (i, label, q) not in seen:
            seen.add((i, label, q))
            vectors.append((i, label, q))
    out = []
    late = lambda i: (i is None, i or 0)
    for a in vectors:
        if a[0] is None or a[0] % 100:
            continue
        scored = sorted(((sum(x * y for x, y in zip(a[2], r[2], strict=True)), r) for r in vectors if r is not a and len(r[2]) == len(a[2])),
                        key=lambda s: (-s[0], late(s[1][0])))
        for p, r in [s for s in scored if s[1][1] == a[1]][:positives]:
            fit = [(s, n) for s, n in scored if n[1] != a[1] and 80 * p <= 100 * s <= 100 * p][:negatives]
            out += [(a[0], r[0], k + 1, n[0], p, s) for k, (s, n) in enumerate(fit)]
    return sorted(out, key=str)


SCHEMA = "vec_id long, embedding array<float>, label int, `meta.lang` string, score long, q string, id long"


def mined(make, data, **kw):
    df = make(SCHEMA, [(i, v, label, "x", 1, "y", 2) for i, v, label in data])
    return sorted(rows(hn.mine(df, lambda c: c % 100 == 0, **kw)), key=str)


def clustered(n, dim, seed, spread=0.6):
    rng = random.Random(seed)
    centre = [rng.gauss(0, 1) for _ in range(dim)]
    return [(i, [float(np.float32((c + rng.gauss(0, spread)) / 8)) for c in centre], rng.randrange(4)) for i in range(n)]


@pytest.mark.parametrize("tile,group", [(1024, 1 << 20), (16, 400)])
def test_matches_brute_force(make, monkeypatch, tile, group):
    monkeypatch.setattr(hn, "GROUP", group)
    monkeypatch.setattr(hn, "BLOCK", group // 4)
    monkeypatch.setattr(hn, "TILE", tile)
    data = clustered(420, 8, 1)
    same = data[0][1]
    data += [(1000 + i, same, i % 3) for i in range(90)]  # one common vector: ties by id
    got = mined(make, data)
    assert got == brute(data) and got


def test_odd_rows(make):
    nan, inf = float("nan"), float("inf")
    data = clustered(150, 4, 2) + [
        (200, None, 1), (300, [0.1, None, 0.2, 0.3], 1), (400, [0.1, nan, 0.2, 0.3], 1), (500, [0.1, inf, 0.2, 0.3], 1), (600, [0.5] * 4, None),
        (700, [], 1), (701, [], 1), (702, [], 2), (800, [0.25] * 3, 0), (801, [0.25] * 3, 0), (802, [0.22] * 3, 1),
        (None, [0.5, 0.5, 0.5, 0.5], 1), (None, [0.5, 0.5, 0.5, 0.5], 1), (None, [-0.5, 0.5, 0.5, 0.5], 2)]
    data += data[100:105] * 3  # repeated rows count once
    got = mined(make, data)
    assert got == brute(data)
    assert {r[0] for r in got} >= {700, 800}
    assert mined(make, []) == []


def test_an_id_with_several_rows(make):
    data = [(100, [0.5, 0.5], 1), (100, [0.5, 0.4], 1), (3, [0.4, 0.5], 2), (4, [0.5, 0.5], 2)]
    assert mined(make, data) == brute(data)


def test_products_are_exact():
    rng = np.random.default_rng(3)
    for size, dim in ((100, 64), (30_000, 700), (2 ** 27, 5), (2 ** 60, 3000)):
        a, b = (rng.integers(-size, size, (k, dim)).astype(float) for k in (3, 4))
        want = [[min(max(sum(int(x) * int(y) for x, y in zip(r, s, strict=True)), -2 ** 63), 2 ** 63 - 1) for s in b] for r in a]
        assert hn.Products(a)(b).tolist() == want
    ends = np.array([[-128.0] * 64, [127.0] * 64])
    assert hn.Products(ends)(ends).tolist() == (ends @ ends.T).tolist()


def test_large_scores_are_bounded(make):
    big = 3.0e38
    data = [(100, [big, 1.0], 1), (101, [big, 2.0], 1), (102, [big, 0.5], 2), (103, [-1.0, 1.0], 2)]
    got = mined(make, data)
    assert got == [(100, 101, 1, 102, 2 ** 63 - 1, 2 ** 63 - 1)]
