import random
import zlib

import numpy as np

from sensorium.llm import quality as Q


def corpus(n=1500):
    rnd = random.Random(6)
    vocab = ["".join(rnd.choice("abcdefgéè") for _ in range(rnd.randint(1, 8))) for _ in range(800)]
    docs, labels = [], []
    for i in range(n):
        w = [rnd.choice(vocab) for _ in range(rnd.randint(20, 200))]
        good = rnd.random() < 0.7
        if not good:
            kind = rnd.randrange(3)
            w = [[x + "###" for x in w], [x.upper() + "!!" for x in w[:10] * 5], [y for x in w for y in (x, "|")]][kind]
        docs.append((i, " ".join(w) + ".", "clash"))
        labels.append((i, int(good), 0))
    return docs, labels


def test_held_out_accuracy(make):
    docs, labels = corpus()
    got = Q.score_quality(make("doc_id long, text string, score string", docs), make("doc_id long, quality int, toxic int", labels)).collect()
    truth = {i: q for i, q, _ in labels}
    assert len(got) == len(docs)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [r for r in got if r.held_out]
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.97
    assert len(Q.keep_quality(make("doc_id long, text string, score string", docs), make("doc_id long, quality int, toxic int", labels)).columns) == 3


def test_held_out_labels_are_not_learnt(make):
    docs, labels = corpus(300)
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q, t) for i, q, t in labels]
    df = make("doc_id long, text string", [d[:2] for d in docs])
    a, b = (Q.fit(df, make("doc_id long, quality int, toxic int", x)) for x in (labels, flipped))
    assert np.allclose(a.beta, b.beta) and np.allclose(a.levels, b.levels)


def test_nulls_empties_repeats_and_one_kind_of_label(make):
    docs = make("doc_id long, text string", [(None, None), (1, ""), (1, ""), (2, "x" * 500_000), (3, "\n\n")])
    no = make("doc_id long, quality int", [])
    assert {r.score for r in Q.score_quality(docs, no).collect()} == {1.0}
    one = make("doc_id long, quality int", [(1, 1), (1, 1), (3, None), (None, 0), (2, 1)])
    assert len(Q.score_quality(docs, one).collect()) == 5
    assert Q.score_quality(make("doc_id long, text string", []), one).count() == 0


def test_isotonic_is_the_least_squares_monotone_fit():
    x, y = np.arange(6.0), np.array([0, 1, 0, 0, 1, 1.0])
    at, level = Q.isotonic(x, y, np.ones(6))
    assert np.allclose(level, [0, 1 / 3, 1]) and np.allclose(at, [0, 2, 4.5])


def test_scores_match_a_plain_kernel_ridge(make):
    """The random features against the Gaussian kernel itself, solved by numpy on 500 rows."""
    docs, labels = corpus(900)
    model = Q.fit(make("doc_id long, text string", [d[:2] for d in docs]), make("doc_id long, quality int, toxic int", labels))
    truth = {i: q for i, q, _ in labels}
    fold = {i: zlib.crc32(str(i).encode()) % 4 for i, _, _ in docs}
    train = [d for d in docs if fold[d[0]] in (0, 1)]
    other = [d for d in docs if fold[d[0]] in (2, 3)]
    known = Q.statistics([d[1].encode() for d in docs if fold[d[0]] != 2])
    mean, scale = known.mean(axis=0), known.std(axis=0)
    assert np.allclose(model.mean, mean) and np.allclose(model.scale, np.where(scale > 1e-9, scale, 1))
    place = lambda ds: np.clip((Q.statistics([d[1].encode() for d in ds]) - model.mean) / model.scale, -8, 8)
    x, z = place(train), place(other)
    kernel = lambda a, b: np.exp(-((a[:, None] - b[None]) ** 2).sum(axis=2) / Q.BANDWIDTH ** 2) + 1
    y = np.array([truth[d[0]] for d in train], float)
    want = kernel(z, x) @ np.linalg.solve(kernel(x, x) + Q.RIDGE * len(y) * np.eye(len(y)), y)
    got = model.raw(Q.statistics([d[1].encode() for d in other]))
    assert np.corrcoef(got, want)[0, 1] > 0.97 and np.mean((got > 0.5) == (want > 0.5)) > 0.97
    # the normal equations that Spark summed give the same weights
    f = model.features(Q.statistics([d[1].encode() for d in train]))
    a, b = f.T @ f, f.T @ y
    beta = np.linalg.solve(a + Q.RIDGE * max(a[-1, -1], 1) * np.eye(len(a)), b)
    assert np.allclose(f @ beta, f @ model.beta, atol=1e-6)
