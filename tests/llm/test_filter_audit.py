import itertools
import random
import re

import numpy as np
import pytest

from sensorium.llm import filter_audit as fa

from .conftest import rows


def fails(text, smaller):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return (len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            bool(re.search(r"[#$%&*|]", text)), text in smaller)


def brute(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    parts = {}
    for i, text, source in docs:
        smaller = {t or "" for j, t, _ in docs if i is not None and j is not None and j < i}
        parts.setdefault(source or "", []).append((fails(text or "", smaller), i in good, i in toxic))
    out = []
    for part, members in parts.items():
        total = dict.fromkeys(range(5), 0)
        mine = []
        for order in itertools.permutations(range(5)):
            left = members
            for step, f in enumerate(order):
                gone = [m for m in left if m[0][f]]
                left = [m for m in left if not m[0][f]]
                total[f] += len(gone)
                mine.append((f, (part, "".join("ABCDE"[k] for k in order), step + 1, len(left), len(gone), sum(m[0][f] for m in members) - len(gone),
                                 sum(m[0][f] and sum(m[0]) == 1 for m in members), sum(m[1] for m in gone), sum(m[2] for m in gone))))
        out += [(*row, total[f]) for f, row in mine]
    return sorted(out)


def data(n=150, seed=5):
    rng = random.Random(seed)
    common = [" ".join(f"w{rng.randrange(300)}" for _ in range(k)) for k in (5, 210, 400)] + ["", None]
    docs = []
    for i in range(n):
        text = rng.choice(common) if rng.random() < 0.4 else " ".join(
            f"{rng.choice(['w', 'W', 'é'])}{rng.randrange(rng.choice([20, 4000]))}{rng.choice(['', '', '', '', '$'])}" for _ in range(rng.choice([3, 199, 200, 260])))
        docs.append((rng.choice([i, i, i, rng.randrange(n), None]), text, rng.choice(["a", "a", "a", "b", "", None, "c d"])))
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, n, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1)]
    return docs, labels


@pytest.mark.parametrize("size", [fa.RANGE, 7])
def test_matches_brute_force(make, monkeypatch, size):
    monkeypatch.setattr(fa, "RANGE", size)
    docs, labels = data()
    df = make("doc_id long, text string, source string, `meta.lang` string, part string, id string, bits string", [(*d, "x", "p", "i", "b") for d in docs])
    got = rows(fa.filter_audit(df, make("doc_id long, quality int, toxic int", labels)))
    assert sorted(got) == brute(docs, labels)
    assert len(got) == 600 * len({s or "" for _, _, s in docs})


def test_long_text_and_empty_tables(make):
    labels = make("doc_id long, quality int, toxic int", [])
    long = "Word " * 200_000
    df = make("doc_id long, text string, source string", [(1, long, "s"), (2, long, "s")])
    got = {r.filter_order + str(r.step): r for r in fa.filter_audit(df, labels).collect()}
    assert (got["EABCD1"].removed, got["BACDE1"].removed, got["CABDE1"].kept) == (1, 2, 0)
    assert rows(fa.filter_audit(df.limit(0), labels)) == []


def test_galloping_lists():
    rng = np.random.default_rng(1)
    for n, m in ((0, 5), (5, 0), (1, 1), (10, 1000), (1000, 10), (3000, 2500), (100_000, 70)):
        a, b = (np.unique(rng.integers(0, 4000 if k < 5000 else 10 ** 6, k)) for k in (n, m))
        assert fa.gallop(a, b).tolist() == np.searchsorted(a, b).tolist()
        assert fa.difference(a, b).tolist() == np.setdiff1d(a, b).tolist()
        assert fa.merge(a, np.setdiff1d(b, a)).tolist() == np.union1d(a, b).tolist()
