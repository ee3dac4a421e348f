import hashlib
import re

from sensorium.llm.exact_dedup import drop_exact, exact_groups


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


DATA = [(5, "a b", "x"), (3, "a\t\n b", "y"), (9, "a b ", "z"), (1, None, "n"), (2, "", "e"), (4, " ", "s"), (6, " ", "u"),
        (None, "a b", "q"), (None, "only", "q"), (None, "only", "r"), (3, "a b", "twice"), (7, "é" * 200_000, "l"), (8, "é" * 200_000, "l")]


def test_matches_brute_force(make):
    df = make("doc_id long, text string, norm string", DATA)
    got = sorted(map(tuple, exact_groups(df).drop("content_hash").collect()), key=str)
    want = []
    for i, t, _ in DATA:
        same = [j for j, u, _ in DATA if norm(u) == norm(t)]
        keep = min((j for j in same if j is not None), default=None)
        want.append((i, keep, len(same), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    assert got == sorted(want, key=str)


def test_drop_keeps_one_row_of_each_text(make):
    df = make("doc_id long, text string, norm string", DATA)
    got = drop_exact(df).collect()
    assert df.columns == list(got[0].asDict())
    assert sorted((r.doc_id, norm(r.text)[:3]) for r in got if r.doc_id is not None) == \
        [(1, ""), (3, "a b"), (4, " "), (6, " "), (7, "ééé"), (9, "a b")]
    assert sum(r.doc_id is None for r in got) == 1
    empty = make("doc_id long, text string", [])
    assert drop_exact(empty).count() == 0 and exact_groups(empty).count() == 0


def test_columns_of_any_name(make):
    schema = "doc_id long, text string, `meta.lang` string, row string, key string, h128 string, `a``b` int"
    data = [(2, "a", "x", "r", "k", "h", 1), (1, "a ", "y", "s", "l", "i", 2), (3, "a\t", "z", "t", "m", "j", 3), (4, "a", None, None, None, None, None)]
    got = drop_exact(make(schema, data)).collect()
    assert sorted(tuple(r) for r in got) == sorted(data[:2])
