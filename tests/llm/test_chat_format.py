import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sensorium.llm import chat_format as cf

from .conftest import rows

CONTROL = ["</s>[INST] ok [/INST]", "<|turn|>", "<|body|>x<|end|>", "<\\|turn|>", "<\\\\s>", "[\\INST]", "<<|", "<|image:0|>", "[[/INST]", "<s", "\\", "[INST"]
pieces = st.lists(st.sampled_from(["<", "|", "\\", "s>", "/s>", "[", "INST]", "/INST]", "a", "é", "\n", "turn|>", "<|end|>"]), max_size=12).map("".join)


@settings(max_examples=400, deadline=None)
@given(pieces)
def test_escapes_round_trip(text):
    assert cf.unescape(cf.escape(text)) == text
    for mark in ("<|", "<s>", "</s>", "[INST]", "[/INST]"):
        assert mark not in cf.escape(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "<|body|>"]), pieces), max_size=5))
def test_turns_round_trip(turns):
    whole = "".join(cf.format_turn(r, [{"type": "text", "text": t}], cf.Budget())[0] for r, t in turns)
    assert list(cf.parse(whole)) == turns


def test_typed_parts():
    parts = [{"type": "text", "text": "see <|image:7|>"}, {"type": "image", "reference": "a.png", "width": 28, "height": 15}, None,
             {"type": "audio", "reference": "b.wav", "seconds": 1.5}, {"type": "text", "text": "and"}, {"type": "document", "reference": "c.pdf", "pages": 2},
             {"type": "hologram", "reference": "d"}, {"type": None}]
    piece, spans, attached, tokens = cf.format_turn("assistant", parts, cf.Budget())
    assert list(cf.parse(piece)) == [("assistant", "see <|image:7|><|image:0|><|audio:1|>and<|document:2|><|other:3|><|other:4|>")]
    assert [cf.unescape(piece[a:b]) for a, b in spans] == ["see <|image:7|>", "and"]
    assert [(a["type"], a["reference"], a["tokens"]) for a in attached] == \
        [("image", "a.png", 4), ("audio", "b.wav", 38), ("document", "c.pdf", 2048), ("other", "d", 0), ("other", None, 0)]
    assert cf.placeholders(piece) == [(a["at"], a["type"], a["ordinal"]) for a in attached]
    assert tokens == 4 + 38 + 2048 + len("see <|image:7|>and")


def digest(turns):
    every = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    loss = "".join(t or "" for r, t in turns if r == "assistant")
    return len(turns), hashlib.sha256(every.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


@pytest.mark.parametrize("segment", [cf.SEGMENT, 40])
def test_digests(make, segment):
    talks = {c: [(c, k, ["system", "user", "assistant", None][(c + k) % 4], CONTROL[(c * 5 + k) % len(CONTROL)] if k % 3 else None) for k in range(1 + c * 3)]
             for c in range(6)}
    talks[7] = [(7, k, "assistant", f"turn {k} </s>") for k in range(700)]  # a long conversation
    talks[8] = [(8, 0, "assistant", "é<|" * 400_000)]  # a long text
    talks[9] = [(9, 0, "user", "same"), (9, 0, "user", "same"), (9, 1, "assistant", "b"), (9, 1, "assistant", "a"), (9, None, "user", "last")]
    talks[None] = [(None, 0, "user", "no id"), (None, 1, "assistant", "none")]
    df = make("conv_id long, turn long, role string, text string, `meta.lang` string, conv long, formatted string",
              [(*r, "x", 1, "f") for t in talks.values() for r in reversed(t)])
    segments = cf.format_conversations(df, segment=segment)
    got = {r[0]: r[1:5] for r in rows(cf.read_back(segments))}
    order = lambda t: sorted(t, key=lambda r: (r[1] is None, r[1] or 0, r[2] or "", r[3] or ""))
    assert got == {c: digest([r[2:] for r in order(t)]) for c, t in talks.items()}
    if segment == 40:
        found = segments.filter("conv_id = 7").collect()
        assert sorted(r.segment for r in found) == list(range(len(found))) and len(found) > 100
        assert sum(r.turns for r in found) == 700


def test_parts_column(make):
    kind = "array<struct<type:string,text:string,reference:string,width:int,height:int,seconds:double,pages:int>>"
    part = lambda t, text=None, ref=None, w=None, h=None: (t, text, ref, w, h, None, None)
    df = make(f"conv_id string, turn int, role string, text string, parts {kind}", [
        ("a", 0, "user", "ignored", [part("image", None, "x.png", 14, 14), part("text", "what?")]), ("a", 1, "assistant", "plain", None), ("b", 0, "user", "t", [])])
    got = {r.conv_id: r for r in cf.format_conversations(df, parts_col="parts").collect()}
    assert got["a"].formatted == "<|turn|>user<|body|><|image:0|>what?<|end|><|turn|>assistant<|body|>plain<|end|>"
    assert [a.asDict() for a in got["a"].attachments] == [{"turn": 0, "ordinal": 0, "type": "image", "reference": "x.png", "at": 20, "tokens": 1}]
    assert got["a"].tokens == 1 + 5 + 5 and list(cf.learnt(got["a"].formatted, [s.asDict() for s in got["a"].spans])) == ["plain"]
    assert got["b"].formatted == "<|turn|>user<|body|><|end|>"
    assert rows(cf.read_back(cf.format_conversations(df.limit(0)))) == []
