import gzip
import hashlib

import pytest

from sensorium.llm import warc as W


def brute(rows):
    out = []
    for i, _, h in rows:
        p = (h or "").encode()
        same = [j for j, _, g in rows if (g or "").encode() == p and j is not None]
        top = max(same, default=None)
        revisit = len(p) >= 1000 and top is not None and i != top
        out.append((i, len(p), hashlib.sha1(p).hexdigest(), "revisit" if revisit else "response", top if revisit else None))
    return sorted(out, key=str)


ROWS = [(i, f"http://x/{i}", "é<p>\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" * 40 if i % 3 else "big " * 400) for i in range(30)] + [
    (40, None, None), (41, "http://a b\n", ""), (42, "u", "small"), (43, "u", "small"), (None, "u", "big " * 400), (None, None, "x" * 2000),
    (44, "u", "HTTP/1.1 200 OK\r\nX-Page-Id: 9\r\n\r\nbody"), (45, "u", "y" * 3_000_000), (45, "u", "y" * 3_000_000), (7, "u", "z" * 999), (8, "u", "z" * 999)]


def test_round_trip_matches_brute_force(make):
    df = make("page_id long, url string, html string", ROWS).repartition(5)
    got = [tuple(r)[:5] for r in W.archive(df).collect()]
    assert sorted(got, key=str) == brute(ROWS)


def test_empty_and_extra_columns(make):
    assert W.archive(make("page_id long, url string, html string", [])).count() == 0
    got = W.archive(make("page_id string, url string, html string, sha1 string", [("a", "u", "x", "clash")])).collect()
    assert [tuple(r)[:5] for r in got] == [("a", 1, hashlib.sha1(b"x").hexdigest(), "response", None)]


@pytest.mark.parametrize("version", [1, 2])
@pytest.mark.parametrize("packed", [False, True])
def test_arc_of_either_version(version, packed):
    raw = W.arc_version_block(version, "n.arc") + b"\n" + b"\n".join(W.arc_record(version, "n.arc", u, i, p) for u, i, p in [
        ("http://a", "1", b"one\n\nhttp://fake 0 0 0 5\n"), ("b c", None, b""), ("d", "3", bytes(range(256)) * 9000)]) + b"\n"
    got = list(W.read_arc(gzip.compress(raw[:50]) + gzip.compress(raw[50:]) if packed else raw))
    assert [(f["URL"], b.partition(b"\r\n\r\n")[2]) for f, b in got] == [
        ("http://a", b"one\n\nhttp://fake 0 0 0 5\n"), ("b%20c", b""), ("d", bytes(range(256)) * 9000)]
    assert ("Checksum" in got[0][0]) == (version == 2)


def test_cut_off_archive_is_an_error():
    raw = W.arc_version_block(1, "n") + b"\n" + W.arc_record(1, "n", "u", "1", b"x" * 100)
    with pytest.raises(ValueError, match="early"):
        list(W.read_arc(raw[:-1]))


def test_revisits_name_their_original(make, spark, tmp_path):
    pages = make("page_id long, url string, html string", [(1, "http://a b", "x" * 1500), (2, "http://c", "x" * 1500), (9, "http://d e", "x" * 1500)])
    found = []
    write = W.write_warc
    W.write_warc = lambda records, originals, path: (found.append(path), write(records, originals, path))
    try:
        W.archive(pages).collect()
    finally:
        W.write_warc = write
    records = [f for row in spark.read.format("binaryFile").load(found[0]).collect() for f, _ in W.read_warc(bytes(row.content))]
    own = {f["X-Page-Id"]: f for f in records if f["WARC-Type"] == "response"}
    assert list(own) == ["9"]
    revisits = [f for f in records if f["WARC-Type"] == "revisit"]
    assert len(revisits) == 2
    for f in revisits:
        assert f["WARC-Refers-To"] == own["9"]["WARC-Record-ID"] and f["WARC-Refers-To-Target-URI"] == own["9"]["WARC-Target-URI"] == "http://d%20e"
        assert f["WARC-Refers-To-Date"] == own["9"]["WARC-Date"]
