import random
from collections import defaultdict

from sensorium.llm.packing import best_fit, pack


def naive(pieces, capacity):
    bins, out = [], []
    for size, source, cluster in pieces:
        fits = [(capacity - b["used"] - size, i) for i, b in enumerate(bins) if b["used"] + size <= capacity and source not in b["s"] and not (cluster >= 0 and cluster in b["c"])]
        if fits:
            i = min(fits)[1]
        else:
            i = len(bins)
            bins.append({"used": 0, "s": set(), "c": set()})
        bins[i]["used"] += size
        bins[i]["s"].add(source)
        bins[i]["c"].add(cluster)
        out.append(i)
    return out


def test_tightest_compatible_bin_as_in_a_full_search():
    rnd = random.Random(1)
    for _ in range(20):
        pieces = sorted([(rnd.randint(0, 40), rnd.choice([0, 0, 0, 1, 2, 3]), rnd.choice([-1, -1, 0, 1])) for _ in range(150)], reverse=True)
        assert best_fit(pieces, 64) == naive(pieces, 64)


def test_every_word_once_within_capacity_and_without_conflicts(make):
    rnd = random.Random(2)
    data = [(i, " ".join("w" for _ in range(rnd.choice([0, 1, 7, 50, 64, 128, 700]))), rnd.choice(["hot", "hot", "a", "b", None]), "clash") for i in range(600)]
    data += [(900 + i, "a copy of a text", "s%d" % i, "c") for i in range(40)] + [(None, None, None, None), (1, data[1][1], data[1][2], "again")]
    df = make("doc_id long, text string, source string, bin string", data)
    got = pack(df, 64).collect()
    by_doc, by_bin = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append((r.first_word, r.n_words))
        by_bin[r.block, r.bin].append(r)
    want = defaultdict(list)
    for i, t, _, _ in data:
        want[i].append(len((t or "").split()))
    for i, sizes in want.items():
        assert sum(n for _, n in by_doc[i]) == sum(sizes)
        if len(sizes) == 1:
            ends = [a + n for a, n in sorted(by_doc[i])]
            assert [a for a, _ in sorted(by_doc[i])] == [0, *ends[:-1]]
    for rows in by_bin.values():
        assert sum(r.n_words for r in rows) <= 64
        assert len({r.source for r in rows}) == len(rows) == len({r.cluster for r in rows})
        at = sorted((r.bin_offset, r.n_words) for r in rows)
        assert all(a + n <= b for (a, n), (b, _) in zip(at, at[1:]))
    assert pack(make("doc_id long, text string, source string", []), 64).count() == 0


def test_repeated_rows_are_dealt_over_blocks(make, monkeypatch):
    from collections import Counter

    from sensorium.llm import packing as P

    monkeypatch.setattr(P, "BLOCK_ROWS", 100)
    data = [(None, "the same text again", None, "x")] * 1500 + [(i, f"text {i}", "s", "x") for i in range(500)]
    got = P.pack(make("doc_id long, text string, source string, `meta.lang` string", data).repartition(4)).collect()
    sizes = Counter(r.block for r in got)
    assert len(got) == 2000 and len(sizes) == 20 and max(sizes.values()) < 160
