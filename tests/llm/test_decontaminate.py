import hashlib
import random
import re
import weakref

import numpy as np
import pyarrow as pa
import pytest

from sensorium.llm import decontaminate as D
from sensorium.llm.common import as_bytes  # noqa: F401


def words(t):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(texts, items):
    out = []
    for t in texts:
        w, hit, ids = words(t), set(), set()
        for i, b in items:
            v = words(b)
            k = min(13, len(v))
            for s in range(len(v) - k + 1 if k else 0):
                for p in range(len(w) - k + 1):
                    if w[p:p + k] == v[s:s + k]:
                        hit |= set(range(p, p + k))
                        ids.add(str(i))
        ids = sorted(ids)
        out.append((len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return out


def corpus():
    rnd = random.Random(5)
    vocab = ["a", "b", "É", "the", "x1", "über", "日本"]
    mk = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    items = [(i, mk(rnd.choice([3, 13, 14, 40]))) for i in range(12)] + [(2, mk(20)), (100, ""), (101, None), (102, "!!"), (103, "same same")]
    texts = [mk(rnd.choice([0, 1, 5, 30, 300])) for _ in range(40)] + [None, "", "...", "same same same", "same\nSAME"]
    for i, b in items[:8]:
        texts += [b.upper().replace("É", "É"), "start, " + (b or "") + "; " + mk(200), mk(3) + " " + (b or "").replace(" ", " -- ") + mk(2)]
        texts += [" ".join((b or "").split()[:12]), (b or "") + "\n" + (b or "")]
    return texts, items


@pytest.mark.parametrize(("block_words", "pass_blocks"), [(40, 100), (40, 3), (20, 7)])
def test_matches_brute_force(make, monkeypatch, block_words, pass_blocks):
    """In one pass, in several, and with items cut into pieces."""
    texts, items = corpus()
    monkeypatch.setattr(D, "BLOCK_WORDS", block_words)
    monkeypatch.setattr(D, "PASS_BLOCKS", pass_blocks)
    docs = make("doc_id long, text string, contaminated string", [(i, t, "?") for i, t in enumerate(texts)])
    bench = make("item_id long, text string", items)
    sizes = [len(p) for p in D.benchmark_passes(bench)]
    assert sum(sizes) > 3 and max(sizes) <= pass_blocks and (len(sizes) == 1) == (pass_blocks == 100)
    got = {r.doc_id: r for r in D.contamination(docs, bench).collect()}
    want = brute(texts, items)
    assert [(got[i].n_words, got[i].n_hit, got[i].n_items, got[i].items_sha256, got[i].contaminated) for i in range(len(texts))] == want
    left = sorted(tuple(r) for r in D.remove_contaminated(docs, bench).collect())
    assert left == [(i, t, "?") for i, (t, w) in enumerate(zip(texts, want, strict=True)) if not w[4]]
    for i, t in enumerate(texts):
        for m in got[i].matches:
            v = [words(b) for j, b in items if str(j) == m.item_id]
            w = words(t)[m.doc_word:m.doc_word + m.n_words]
            assert any(x[m.item_word:m.item_word + m.n_words] == w for x in v)


def test_long_and_repetitive(make):
    """Places and windows are no product: a document of one word against an item of the same word."""
    import resource
    import time

    items = [(1, "a " * 2000), (2, "b a " * 700), (3, "a"), (4, "b b b b b")]
    texts = ["a " * 200_000, "a b " * 50_000, "c " * 100_000 + "b a " * 7, "a " * 12 + "c"]
    began, used = time.time(), resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    got = list(D.scan([t.encode() for t in texts], [D.Block([(str(i), b.encode()) for i, b in items], 13)]))
    assert time.time() - began < 20 and resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - used < 500_000
    assert [g[:3] for g in got] == [(200_000, 200_000, ["1", "3"]), (100_000, 100_000, ["2", "3"]), (100_014, 14, ["2", "3"]), (13, 12, ["3"])]
    assert got[0][3][0] == (0, "1", 0, 2000) and sum(m[3] for m in got[0][3]) >= 200_000 and len(got[0][3]) < 200


def test_words_of_one_hash_are_told_apart(monkeypatch):
    """Word hashes of two bits: places that only the hash lets through go."""
    texts, items = corpus()
    docs = [(t or "").encode() for t in texts]
    vocabulary = {w: k for k, w in enumerate(sorted({w.encode() for _, b in items for w in words(b)}))}

    def weak(buf, starts, ends):  # benchmark words keep hashes of their own, all others share one of them
        raw = buf.tobytes()
        return np.array([vocabulary.get(raw[a:b], 0) + 1 for a, b in zip(starts.tolist(), ends.tolist())], np.uint64)
    monkeypatch.setattr(D, "span_hashes", weak)
    blocks = [D.Block([(str(i), (b or "").encode()) for i, b in items], 13)]
    got = [(n, h, len(i)) for n, h, i, _ in D.scan(docs + [b"other words " * 20], blocks)]
    want = [w[:3] for w in brute(texts + ["other words " * 20], items)]
    assert got == want


def test_pieces_hold_every_window():
    rnd = random.Random(2)
    for n in (0, 1, 12, 13, 14, 39, 40, 41, 67, 68, 69, 200):
        text = "".join(rnd.choice([" ", " . ", "\n"]) + f"w{i}" for i in range(n))
        got = list(D.pieces([b"", text.encode()], 13, 40))
        windows = {(i, i + min(n, 13)) for i in range(max(n - 12, min(n, 1)))}
        seen = set()
        for k, piece, first, m in got:
            assert k == 1 and m <= 40 and words(piece.decode()) == [f"w{i}" for i in range(first, first + m)]
            size = min(n, 13)
            assert m >= size  # no piece is a shorter window of its own
            seen |= {(first + i, first + i + size) for i in range(m - size + 1)}
        assert seen == windows and (n <= 40) == (len(got) <= 1)


def test_rows_that_repeat_over_passes(make, monkeypatch):
    """Rows are told apart by number: equal ids, null ids and equal rows are judged each; a word hit in two passes counts once."""
    monkeypatch.setattr(D, "BLOCK_WORDS", 13)
    monkeypatch.setattr(D, "PASS_BLOCKS", 1)
    long = " ".join(f"w{i}" for i in range(30))
    bench = make("item_id long, text string", [(1, long), (2, " ".join(f"w{i}" for i in range(5, 20))), (None, "w3 w4")])
    texts = [(1, long), (1, long), (1, "clean"), (None, None), (None, "w3 w4"), (2, "w4 w3 " * 20 + "w3")]
    docs = make("doc_id long, text string, number string, `c0.x` int", [(i, t, "n", 0) for i, t in texts])
    got = sorted(((r.doc_id or 0, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in D.contamination(docs, bench).collect()))
    assert got == [(0, 0, 0, 0, False), (0, 2, 2, 1, True), (1, 1, 0, 0, False), (1, 30, 30, 3, True), (1, 30, 30, 3, True), (2, 41, 38, 1, True)]
    assert sorted(map(tuple, D.remove_contaminated(docs, bench).collect()), key=str) == [(1, "clean", "n", 0), (None, None, "n", 0)]


def test_columns_of_any_name(make):
    docs = make("doc_id long, text string, `meta.lang` string, id int, contaminated int", [(1, "a b c", "x", 1, 2), (2, "d", "y", 3, 4)])
    bench = make("item_id long, text string, id string", [(1, "b", "z")])
    assert [tuple(r) for r in D.remove_contaminated(docs, bench).collect()] == [(2, "d", "y", 3, 4)]
    assert sorted((r.doc_id, r.contaminated) for r in D.contamination(docs, bench).collect()) == [(1, True), (2, False)]


def test_suffix_array_sorts_by_27_tokens():
    rnd = np.random.default_rng(0)
    t = rnd.integers(1, 3, 500).astype(np.uint64)
    got = [tuple(t[i:i + 27]) for i in D.suffix_array(t)]
    assert got == sorted(got)


def test_empty_tables(make):
    docs, bench = make("doc_id long, text string", []), make("item_id long, text string", [])
    one = make("doc_id long, text string", [(1, "a b c"), (1, "a b c"), (None, None)])
    assert D.contamination(docs, bench).count() == 0
    assert D.remove_contaminated(one, bench).count() == 3
    assert D.remove_contaminated(one, make("item_id long, text string", [(1, "b")])).count() == 1


def test_one_block_at_a_time(make, monkeypatch):
    texts, items = corpus()
    monkeypatch.setattr(D, "BLOCK_WORDS", 40)
    monkeypatch.setattr(D, "PASS_BLOCKS", 100)
    monkeypatch.setattr(D, "prepare", lambda df: None)
    alive, most = weakref.WeakSet(), []

    class Counted(D.Block):
        def __init__(self, *args):
            super().__init__(*args)
            alive.add(self)
            most.append(len(alive))

    monkeypatch.setattr(D, "Block", Counted)
    kept = []

    class Local:  # runs the operator's function here
        columns, schema = ["text"], None

        def toDF(self, *names):
            return self

        def mapInArrow(self, run, schema):
            batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
            kept.extend(t for b in run(iter([batch, batch])) for t in b.column(0).to_pylist())
            return self

    D.remove_contaminated(Local(), make("item_id long, text string", items))
    want = brute(texts, items)
    assert kept == [t for t, w in zip(texts, want, strict=True) if not w[4]] * 2
    assert len(most) > 6 and max(most) == 1
