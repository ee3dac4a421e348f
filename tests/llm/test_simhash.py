import random
import re

import xxhash

from sensorium.llm.simhash import fingerprints, simhash_components


def brute_fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    sh = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    ids = list(fps)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in ids:
        for b in ids:
            if ((fps[a] ^ fps[b]) & ((1 << 64) - 1)).bit_count() <= 2:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {i: find(i) for i in ids}


def corpus():
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdeÉé") for _ in range(rnd.randint(1, 6)))
    texts = ["", None, "  \n\t ", "one", "One\x0bTWO", "a  b\n\nc", "A b c", "é x y z", ""]
    for _ in range(30):
        w = [word() for _ in range(rnd.choice([3, 40, 600]))]
        texts.append(" ".join(w))
        for _ in range(3):
            v = list(w)
            v[rnd.randrange(len(v))] = word()
            texts.append("\n".join(v))
    return texts + ["w " * 5000, " ".join(map(str, range(3000)))]


def test_fingerprints_match_brute_force():
    texts = corpus()
    got = fingerprints([(t or "").encode() for t in texts])
    assert [int(x) for x in got] == [brute_fingerprint(t) for t in texts]


def test_components_match_brute_force(make):
    texts = corpus()
    data = [(i * 3, t, "x") for i, t in enumerate(texts)] + [(3, texts[1], "y")]
    df = make("doc_id long, text string, fp string", data)
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in simhash_components(df).collect()}
    fps = {i: brute_fingerprint(t) for i, t, _ in data}
    roots = brute_components(fps)
    assert got == {(i, f"{fps[i]:016x}", roots[i]) for i in fps}
    assert simhash_components(df).count() == len(data)


def test_chain_null_ids_and_empty(make):
    assert simhash_components(make("doc_id long, text string", [])).count() == 0
    got = simhash_components(make("doc_id long, text string", [(None, "a b c"), (None, "A b c"), (7, "x")])).collect()
    assert sorted((r.doc_id is None, r.component_id) for r in got if r.doc_id is None) == [(True, None)] * 2


def test_links_keep_long_chains(spark):
    from sensorium.llm.components import components
    from sensorium.llm.simhash import links

    rnd = random.Random(1)
    fps = [0x0123456789abcdef]
    for _ in range(60):  # each 2 bits from the one before
        fps.append(fps[-1] ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)))
    fps += [rnd.getrandbits(64) for _ in range(200)]
    fps = sorted({f - (1 << 64) if f >> 63 else f for f in fps})
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    got = {r.node: r.root for r in components(links(df)).collect()}
    want = brute_components({f: f for f in fps})
    assert {f: got.get(f, f) for f in fps} == want


def test_components_over_many_tasks(spark, monkeypatch):
    from sensorium.llm import components as C

    rnd = random.Random(8)
    n = 400
    edges = [(i, i + 1) for i in range(0, 150)] + [(rnd.randrange(150, n), rnd.randrange(150, n)) for _ in range(180)] + [(7, 7), (n, 0), (0, n)]
    edges += [(-5, -i) for i in range(10, 300)]
    monkeypatch.setattr(C, "TASK_EDGES", 60)
    perm = list(range(-300, n + 1))
    rnd.shuffle(perm)
    edges = [(perm[a], perm[b]) for a, b in edges]
    root = {x: x for e in edges for x in e}
    for _ in range(1000):
        before = dict(root)
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
        if before == root:
            break
    df = spark.createDataFrame(edges, "u long, v long").repartition(8)
    got = [(r.node, r.root) for r in C.components(df).collect()]
    assert dict(got) == {k: v for k, v in root.items() if dict(got).get(k) is not None or v != k} and len(dict(got)) == len(got)
    assert all(root[k] == k for k in root if k not in dict(got))


def kept(make, data, schema="doc_id long, text string"):
    from sensorium.llm.simhash import drop_near
    return sorted((tuple(r) for r in drop_near(make(schema, data)).collect()), key=str)


def test_drop_tells_rows_of_one_id_apart(make):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    for order in ([(0, b), (1, b), (1, a)], [(1, a), (1, b), (0, b)], [(1, b), (1, a), (0, b)]):
        assert kept(make, order) == sorted([(0, b), (1, a)], key=str)
    three = [(1, a), (1, b), (1, c)]
    assert kept(make, three) == sorted(three, key=str)
    assert kept(make, [(None, a), (None, a), (None, b), (5, a)]) == sorted([(5, a), (None, b)], key=str)
    assert kept(make, [(None, a), (None, a), (7, c), (7, c)]) == sorted([(None, a), (7, c)], key=str)
    assert kept(make, []) == []


def test_drop_keeps_columns_of_any_name(make):
    a, b = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    schema = "doc_id long, text string, `meta.lang` string, row string, key string, fp long, h int, id string, lacks_id string, best string"
    data = [(2, a, "x", "r", "k", 1, 2, "i", "l", "b"), (1, a, "y", "r", "k", 3, 4, "j", "m", "c"), (3, b, None, None, None, None, None, None, None, None)]
    assert kept(make, data, schema) == sorted(data[1:], key=str)


def test_drop_matches_brute_force(make):
    from sensorium.llm.simhash import drop_near
    texts = corpus()
    rnd = random.Random(11)
    data = [(rnd.choice([i, i, rnd.randrange(40), None]), t, i) for i, t in enumerate(texts)]
    fps = {n: brute_fingerprint(t) for n, (_, t, _) in enumerate(data)}
    roots = brute_components(fps)
    got = drop_near(make("doc_id long, text string, n long", data)).collect()
    assert len(got) == len(set(roots.values()))
    lowest = {}
    for n, (i, _, _) in enumerate(data):
        lowest[roots[n]] = min(lowest.get(roots[n], (True, 0)), (i is None, i or 0))
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == sorted(lowest.values())
    assert {roots[r.n] for r in got} == set(roots.values())
