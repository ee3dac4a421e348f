import random

import pytest

from sensorium.llm.quality import THRESHOLD, fit
from sensorium.llm.simhash import fingerprints

from .test_decontaminate import brute as contaminated
from .test_exact_dedup import norm
from .test_simhash import brute_components


def tables(spark, folder):
    rnd = random.Random(12)
    vocab = ["".join(rnd.choice("abcdefgéè") for _ in range(rnd.randint(1, 8))) for _ in range(900)]
    text = lambda n: " ".join(rnd.choice(vocab) for _ in range(n)) + "."
    items = [(i, text(30)) for i in range(5)]
    docs, labels = [], []

    def add(t, good=True):
        i = 3 * len(docs) + 1
        docs.append((i, t, rnd.choice(["en", "de"]), "hot" if i % 2 else "s%d" % (i % 5), len(t or ""), "clash"))
        if rnd.random() < 0.7 and t:
            labels.append((i, int(good), 0))
    for _ in range(500):
        add(text(rnd.choice([30, 80, 300])))
    for k in range(150):
        w = text(60).split()
        add(" ".join([x + "###" for x in w] if k % 2 else [x.upper() + "!!" for x in w]), good=False)
    for k in range(0, 120, 4):  # copies that differ in white space, and near copies
        add(docs[k][1].replace(" ", "\n", 1))
        w = docs[k + 1][1].split()
        w[len(w) // 2] = "edited"
        add(" ".join(w))
    for _, t in items:
        add(text(40) + " " + t.upper().replace("É", "é").replace("È", "è"))
    add(None), add(""), add("word " * 30_000)
    docs += [(*docs[0][:5], "again"), (None, text(50), None, None, 1, None), (None, docs[9][1], "en", "x", 1, None)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, score string").repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return items


def test_each_stage_against_brute_force(spark, tmp_path):
    import corpus_pipeline as P

    items = tables(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    names, seen = docs.columns, [sorted(map(tuple, docs.collect()), key=str)]
    for k, (name, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/out{k}")
        docs = spark.read.parquet(f"{tmp_path}/out{k}")
        seen.append(sorted(map(tuple, docs.collect()), key=str))
        if k < len(P.STAGES) - 1:
            assert docs.columns == names
    rows, good, single, apart, clean, packed = seen
    model = fit(spark.read.parquet(f"{tmp_path}/documents.parquet"), spark.read.parquet(f"{tmp_path}/labels.parquet"))
    scores = model.score([(r[1] or "").encode() for r in rows])
    assert good == [r for r, s in zip(rows, scores) if s >= THRESHOLD]
    junk = [r for r in rows if "###" in (r[1] or "") or "!!" in (r[1] or "")]
    assert len(set(junk) & set(good)) < 0.05 * len(junk) and len(good) > 0.95 * (len(rows) - len(junk))

    key = lambda r: (r[0] is None, r[0] or 0)
    first = {}
    for r in sorted(good, key=key):
        first.setdefault(norm(r[1]), r)
    assert sorted(key(r) + (norm(r[1]),) for r in single) == sorted(key(r) + (t,) for t, r in first.items())

    fps = [int(x) for x in fingerprints([(r[1] or "").encode() for r in single])]
    order = sorted(range(len(single)), key=lambda i: key(single[i]))
    place = {i: n for n, i in enumerate(order)}
    roots = brute_components({place[i]: fps[i] for i in range(len(single))})
    assert sorted(apart, key=str) == sorted((single[order[p]] for p, q in roots.items() if p == q), key=str)

    bad = contaminated([r[1] for r in apart], items)
    assert clean == [r for r, b in zip(apart, bad) if not b[4]] and any(b[4] for b in bad)

    words = {}
    for r in packed:
        words[r[0]] = words.get(r[0], 0) + r[3]
    assert words == {r[0]: sum(len((q[1] or "").split()) for q in clean if q[0] == r[0]) for r in clean}
    assert sorted(map(tuple, P.run(spark, str(tmp_path)).collect()), key=str) == packed


def test_empty_table_passes_through(spark, tmp_path):
    import corpus_pipeline as P

    tables(spark, str(tmp_path / "full"))
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{tmp_path}/full/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", ["op1_suffix_dedup", "op2_sharding", "op4_html_text", "op5_quality", "op9_simhash", "op10_packing"])
def test_queries_without_sql_return_whole_tables(spark, name):
    import __spark_entry__ as entry

    got = entry.queries()[name](spark, "/root/testdata/sf0.001")
    table, id_col = ("pages", "page_id") if name == "op4_html_text" else ("documents", "doc_id")
    want = {r[0] for r in spark.read.parquet(f"/root/testdata/sf0.001/{table}.parquet").select(id_col).collect()}
    ids = [r[id_col] for r in got.collect()]
    assert set(ids) == want and (name == "op10_packing" or len(ids) == len(want))
