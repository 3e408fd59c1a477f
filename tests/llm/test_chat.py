import json
import random

from curaloom.llm import chat


def test_round_trip_of_hostile_texts():
    r = random.Random(8)
    for _ in range(3000):
        text = lambda: "".join(r.choice(["\\", "###", "#", "</turn>", "</turn", "\n", " ", "a", ":", "### Assistant: ", "é"]) for _ in range(r.randrange(12)))
        turns = [(r.choice(["user", "assistant", "system", "tool", "a:b###", ""]), text()) for _ in range(r.randrange(6))]
        formatted, mask = chat.render(turns)
        assert chat.parse(formatted) == turns
        assert chat.loss_text(formatted, mask) == "".join(t for role, t in turns if role == "assistant")


def test_layouts():
    two = [("user", "a"), ("assistant", "b")]
    assert chat.canonical(json.dumps({"messages": [{"role": r, "content": t} for r, t in two]})) == two
    assert chat.canonical(json.dumps({"conversations": [{"from": "human", "value": "a"}, {"value": "b", "from": "gpt"}]})) == two
    assert chat.canonical(json.dumps({"data": {"dialog": {"turns": [{"speaker": "user", "utterance": "a"}, {"speaker": "bot", "utterance": "b"}]}}})) == two
    assert chat.canonical('{"completion": "b", "prompt": "a"}') == two
    assert chat.canonical('{"output": "b", "instruction": "a", "system": null}') == [("system", ""), *two]
    assert chat.canonical('{"other": 1}') is None and chat.canonical("nonsense") is None and chat.canonical(None) is None
    assert len(chat.MAPPINGS) == len(chat.LAYOUTS)


def test_ill_typed_fields_and_unknown_layouts(spark):
    assert chat.canonical('{"prompt": 5, "completion": true}') == [("user", "5"), ("assistant", "true")]
    assert chat.canonical('{"messages": [{"role": null, "content": 1.5}]}') == [("", "1.5")]
    assert chat.canonical('{"messages": []}') is None and chat.canonical('{"messages": [{"role": "user", "content": "a", "name": "n"}]}') is None
    rows = [(1, '{"q": "a", "a": "b"}'), (2, '{"a": 1, "q": 2}'), (3, "nonsense"), (4, None), (5, '{"prompt": "a", "completion": "b"}'), (6, "[" * 100_000)]
    chats = chat.formatted(spark.createDataFrame(rows, "conv_id long, record string"))
    known = chat.fingerprint({"a", "q"})
    assert sorted((x.fingerprint or "", x.n, x.example) for x in chat.unmapped(chats).collect()) == sorted([(known, 2, 1), ("", 3, 3)])
    assert {x.conv_id: x.n_turns for x in chat.digests(chats).collect()} == {1: 0, 2: 0, 3: 0, 4: 0, 5: 2, 6: 0}


def test_a_very_long_conversation(spark):
    frame = spark.range(20_000).selectExpr("7L as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role", "repeat('word ', 20) as text")
    row = chat.digests(chat.formatted(chat.records(frame))).first()
    assert (row.n_turns, row.loss_chars) == (20_000, 10_000 * 100)


def test_rows_with_nulls_ties_and_empty_tables(spark):
    rows = [(i, t, role, text, "x") for i in range(40) for t, role, text in [(1, "assistant", "b"), (0, "user", None), (1, "assistant", "b"), (2, None, "c"), (3, "bot", "d")][: 2 + i % 4]]
    frame = spark.createDataFrame([*rows, (None, 0, "user", "q", "x")], "conv_id long, turn long, role string, text string, record string")
    out = {r.conv_id: r.formatted for r in chat.formatted(chat.records(frame)).collect()}
    want = [("user", ""), ("assistant", "b"), ("assistant", "b"), ("", "c"), ("bot", "d")]
    for i in range(40):
        assert chat.parse(out[i]) == want[: 2 + i % 4]
    assert chat.parse(out[None]) == [("user", "q")]
    assert chat.digests(chat.formatted(chat.records(frame.limit(0)))).count() == 0
