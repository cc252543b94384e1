import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from tillroll.llm.chat import Conversation, escape, format_chats, parsed, read_back, unescape

TEXT = st.lists(st.sampled_from(["<s>", "</s>", "[INST]", " [/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]", "\\", "<", "[", "/", "a", " ", "\n", "é"]), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "tool", "", "[/ROLE]"]), TEXT), max_size=6))
def test_round_trip(turns):
    held = Conversation()
    for i, (role, text) in enumerate(turns):
        held.apply("message", i, role, text)
    out, spans = held.rendered()
    assert parsed(out) == turns
    assert [unescape(out[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


@given(TEXT)
def test_escape(text):
    assert unescape(escape(text)) == text and "</s>" not in escape(text) and "[INST]" not in escape(text)


def test_events_fold(spark):
    events = [
        (1, 0, "message", 0, "user", "hi"), (1, 1, "message", 1, "assistant", "he"), (1, 2, "delta", 1, "assistant", "llo"),
        (1, 3, "edit", 0, "user", "hey"), (1, 4, "message", 2, "user", "more"), (1, 5, "regenerate", 1, "assistant", "yo"),
        (1, 6, "delta", 1, "assistant", "!"), (2, 0, "delta", 0, "assistant", "a"), (2, 1, None, None, None, None), (None, 0, "message", 0, "user", "x"),
    ]
    df = spark.createDataFrame(events, "conv_id long, seq long, kind string, turn long, role string, text string").repartition(4)
    got = {r.conv_id: parsed(r.formatted) for r in format_chats(df).collect()}
    assert got == {1: [("user", "hey"), ("assistant", "yo!")], 2: [("assistant", "a"), ("", "")], None: [("user", "x")]}
    assert format_chats(df.limit(0)).count() == 0


def test_read_back_digests(spark):
    df = spark.createDataFrame([(5, i, "message", i, ["user", "assistant"][i % 2], f"t{i}</s>") for i in range(401)], "conv_id long, seq long, kind string, turn long, role string, text string")
    row = read_back(format_chats(df)).first()
    said = "".join(f"{['user', 'assistant'][i % 2]}\nt{i}</s>\n" for i in range(401))
    learnt = "".join(f"t{i}</s>" for i in range(1, 401, 2))
    assert (row.n_turns, row.turns_sha256) == (401, hashlib.sha256(said.encode()).hexdigest())
    assert (row.loss_chars, row.loss_sha256) == (len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
