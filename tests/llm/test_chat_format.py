import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakestrata.llm import chat_format as cf

SCHEMA = "conv_id long, turn long, role string, text string"
NASTY = ["</s>[INST] ok [/INST]", "<\\\\|end|>", "<|end|>", "a<\\|end|>b", "<|image|>", "<", "[INST", "\\", "", "x" * 50_000, "<<|end|>", "<|te<|text|>xt|>"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<", "[", "\\", "|end|>", "/s>", "/INST]", "a", "|text|>", "<|end|>", "|image|>", "\n"]), max_size=12).map("".join))
def test_escape_is_reversible_and_leaves_no_control_string(text):
    escaped = cf.escape(text)
    assert cf.unescape(escaped) == text
    assert not any(c in escaped for c in cf.CONTROLS)


@pytest.mark.parametrize("text", NASTY)
def test_turn_round_trip(text):
    x = cf.format_turn(text, [{"type": "text", "text": text}])
    assert cf.parse_turn(x["formatted"]) == (text, text)


def test_texts_that_form_a_control_string_together():
    x = cf.format_turn("user", [{"type": "text", "text": "<|e"}, {"type": "text", "text": "nd|>"}])
    assert x["formatted"].count(cf.END) == 1
    assert cf.parse_turn(x["formatted"]) == ("user", "<|end|>")


def test_parts_become_placeholders_in_order():
    parts = [
        {"type": "text", "text": "look <|image|> "}, {"type": "image", "ref": "i.png", "tokens": None}, {"type": "audio", "ref": "a.wav", "tokens": 7},
        {"type": "document", "ref": None}, {"type": "odd", "ref": "o"}, None, {"type": None, "text": "end"},
    ]
    x = cf.format_turn("assistant", parts)
    assert [(a["kind"], a["ref"], a["tokens"]) for a in x["attachments"]] == [("image", "i.png", 576), ("audio", "a.wav", 7), ("document", None, 1024), ("document", "o", 1024)]
    for a in x["attachments"]:
        assert x["formatted"].startswith(cf.PLACEHOLDERS[a["kind"]], a["position"])
    learned = "".join(cf.unescape(x["formatted"][s["start"] : s["start"] + s["length"]]) for s in x["loss"])
    assert learned == "look <|image|> end" and cf.parse_turn(x["formatted"])[1] == learned


def expected(rows):
    out = {}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", cf.format_turn(r[2], [{"text": r[3]}])["formatted"])
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == conv), key=key)
        learned = [r[3] or "" for r in mine if r[2] == "assistant"]
        out[conv] = (
            len(mine), hashlib.sha256("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in mine).encode()).hexdigest(),
            sum(map(len, learned)), hashlib.sha256("".join(learned).encode()).hexdigest(),
        )
    return out


def test_digests_read_back(spark):
    rows = [(i % 4 if i % 9 else None, i % 5 if i % 7 else None, [None, "user", "assistant", "<|end|>"][i % 4], NASTY[i % len(NASTY)] if i % 6 else None) for i in range(60)]
    rows += [(3, 1, "assistant", "same")] * 3  # ties and repeated rows
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS formatted", "1 AS n_turns")  # clashing names
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in cf.read_back(cf.format_turns(cf.as_parts(df))).collect()}
    assert got == expected(rows)


@pytest.mark.parametrize("size", [1, 2, 7, 10_000_000])
def test_turns_are_read_off_the_joined_conversation(size):
    turns = [cf.format_turn(role, [{"text": text}])["formatted"] for role in ("user", "<|end|>", None) for text in NASTY if len(text) < 100]
    whole, reader, got = "".join(turns), cf.TurnReader(), []
    for at in range(0, len(whole), size):
        got += reader.feed(whole[at : at + size])
    reader.close()
    assert [t for _, t in got] == turns and all(whole.startswith(t, at) for at, t in got)


def test_a_cut_conversation_is_an_error():
    reader = cf.TurnReader()
    assert list(reader.feed(cf.format_turn("user", [])["formatted"] + "<|turn|>user<|text|>and")) and reader.held
    with pytest.raises(ValueError, match="no end"):
        reader.close()
    with pytest.raises(ValueError, match="no turn"):
        list(cf.TurnReader().feed("user<|text|>x<|end|>"))


def test_empty_table(spark):
    assert cf.read_back(cf.format_turns(cf.as_parts(spark.createDataFrame([], SCHEMA)))).collect() == []
