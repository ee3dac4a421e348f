import math
import random
import re

from sensorium.llm import licenses as L


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(t):
    w, places, base = words(t), [], set()
    for p, label in L.PHRASES.items():
        v = p.split()
        at = [i for i in range(len(w) - len(v) + 1) if w[i:i + len(v)] == v]
        places += at
        base |= {label} if at else set()
    found, best = set(), 0.0
    for label, _, containment in brute_blocks(w):
        found.add(label)
        best = max(best, containment)
    return (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | found)), 1.0 if places else best)


def brute_blocks(w):
    out = set()
    for t in L.TEMPLATES:
        v = set(words(t.wording))
        size = math.ceil(len(words(t.wording)) / L.THRESHOLD)
        for s in range(max(1, len(w) - size + 1)) if w else ():
            b = set(w[s:s + size])
            if len(b & v) >= math.ceil(round(L.THRESHOLD * len(v), 9)) and set(t.required.split()) <= b and not set(t.excluded.split()) & b:
                out.add((t.label, s, len(b & v) / len(v)))
    return out


def corpus():
    rnd = random.Random(4)
    vocab = sorted({w for t in L.TEMPLATES for w in words(t.wording)}) + ["x", "É", "foo"]
    texts = [None, "", "\n", "cc by cc by", "CC-BY", "cc\nby", "all rights reserved all RIGHTS\nreserved", "wor\u212a publ\u0130c", "CC BY",
             "x " * 50_000 + "general public license", "\u212a cc by", "cc bye", "acc by", ". cc by .", "x " * 3000 + "mit " * 3000 + "license"]
    for t in L.TEMPLATES:
        w = t.wording.split()
        for drop in range(3):
            v = [x for i, x in enumerate(w) if i not in rnd.sample(range(len(w)), min(drop, len(w)))]
            texts += [" ".join(v), "foo bar\n" + " -- ".join(v).upper() + " x y z\nfoo", "\n".join(v), ("# " + " ".join(v) + " also\n") * 3]
            u = list(v)
            u.insert(rnd.randrange(len(u) + 1), rnd.choice(vocab))
            texts.append("a b c " * 9 + " ".join(u) + " d e f" * 9)
    for _ in range(150):
        texts.append("".join(rnd.choice(vocab) + rnd.choice([" ", " ", "\n", ", "]) for _ in range(rnd.randint(1, 60))))
    return texts


def test_matches_brute_force(make):
    texts = corpus()
    df = make("doc_id long, text string, labels string", [(i, t, "clash") for i, t in enumerate(texts)])
    got = {r.doc_id: tuple(r)[1:8] for r in L.scan_licenses(df).collect()}
    assert [got[i] for i in range(len(texts))] == [brute(t) for t in texts]


def test_blocks_of_matches(make):
    texts = corpus()
    got = {}
    for r in L.template_matches(make("doc_id long, text string, label string, `a.b` int", [(i, t, "x", 1) for i, t in enumerate(texts)])).collect():
        got.setdefault(r.doc_id, set()).add((r.label, r.word, r.containment))
    assert got == {i: b for i, t in enumerate(texts) if (b := brute_blocks(words(t)))}


LABELS = {
    "Licensed under CC BY 4.0": "cc-by,cc-by-4.0",
    "Licensed under CC BY-NC 4.0.": "cc-by,cc-by-nc-4.0",
    "Licensed under CC BY-NC-SA 4.0.": "cc-by",
    "Released under the BSD License": "bsd",
    "The book was released under the title X without a license": "",
    "Apache License, Version 1.0": "",
    "Licensed under the Apache License, Version 1.0": "",
    "Licensed under the terms of the Apache License,\nVersion 2.0 (the License)": "apache-2.0",
    "This work is licensed under the GNU General Public License, version 3.": "gpl,gpl-3.0",
    "This work is licensed under the GNU General Public License, version 2.": "gpl,gpl-2.0",
    "This library is licensed under the GNU Lesser General Public License, version 3": "gpl,lgpl",
    "# This Source Code Form is subject to the terms of the Mozilla Public\n# License, v. 2.0.": "mpl-2.0",
    "Redistribution and use in source and binary forms, with or without\nmodification, are permitted": "bsd",
    "Licensed under the MIT License. All rights reserved.": "all-rights-reserved,mit,reserved",
}


def test_labels(make):
    df = make("doc_id string, text string", [(t, t) for t in LABELS])
    assert {r.doc_id: r.labels for r in L.scan_licenses(df).collect()} == LABELS


def test_nulls_repeats_and_empty(make):
    assert L.scan_licenses(make("doc_id long, text string", [])).count() == 0
    got = L.scan_licenses(make("doc_id long, text string", [(None, None), (1, "cc by"), (1, "cc by")])).collect()
    assert sorted((r.n_base, r.labels, r.score) for r in got) == [(0, "", 0.0), (1, "cc-by", 1.0), (1, "cc-by", 1.0)]
