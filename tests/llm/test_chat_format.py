import hashlib
import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martforge.llm import chat_format as chat

ROWS = "conv_id long, turn long, role string, text string"


def through(spark, rows, schema=ROWS):
    return chat.read_back(chat.render(chat.from_rows(spark.createDataFrame(rows, schema))))


CONTROL = ["<|im_start|>", "<|im_end|>", "<|im_sep|>", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<", "|", "\\", "\\\\", "[", ">", "é", "\n", "x", " "]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(CONTROL), max_size=9).map("".join), min_size=40, max_size=60))
def test_escaping_is_reversible_and_hides_control_strings(spark, texts):
    frame = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape(F.col("t")).alias("e"))
    for r in frame.select("t", "e", chat.unescape(F.col("e")).alias("back")).collect():
        assert r["back"] == r["t"]
        assert not any(c in r["e"] for c in CONTROL[:9])


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "<|im_sep|>", "odd\nrole"]),
                          st.lists(st.sampled_from(CONTROL), max_size=7).map("".join)), min_size=5, max_size=30))
def test_turns_and_loss_come_back(spark, turns):
    rows = [(i // 4, i % 4, role, text) for i, (role, text) in enumerate(turns)]
    for r in through(spark, rows).collect():
        own = [(role, text) for conv, _, role, text in rows if conv == r["conv_id"]]
        assert [tuple(t) for t in r["turns"]] == own
        assert r["loss_text"] == "".join(t for role, t in own if role == "assistant")
        assert sum(a + b + c for a, b, c in r["loss_runs"]) == len(r["formatted"])


def test_nulls_ties_repeats_and_long_texts(spark):
    long = "word <|im_end|> " * 20_000
    rows = [(1, 0, None, None), (1, 1, "assistant", None), (2, 5, "user", "b"), (2, 5, "user", "a"), (2, None, "system", "first"),
            (3, 0, "assistant", "x"), (3, 0, "assistant", "x"), (4, 0, "assistant", long), (None, 0, "user", "no id")]
    got = {r["conv_id"]: r for r in through(spark, [(*r, 1, "y") for r in rows], ROWS + ", turns long, record string").collect()}
    assert [tuple(t) for t in got[1]["turns"]] == [("", ""), ("assistant", "")] and got[1]["loss_text"] == ""
    assert [t["text"] for t in got[2]["turns"]] == ["first", "a", "b"]
    assert got[3]["loss_text"] == "xx" and got[4]["loss_text"] == long and len(got[None]["turns"]) == 1


def test_layouts_are_selected_by_field_paths(spark):
    records = [
        {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}], "extra": {"messages": 1}},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        {"prompt": "q", "completion": "a"}, {"prompt": "q", "response": "a"}, {"instruction": "q", "output": "a"},
        {"data": {"question": "q", "answer": "a"}, "id": 7}, {"instruction": "q", "input": "", "output": "a"}]
    odd = ["not json", None, "[]", json.dumps({"messages": []}), json.dumps({"prompt": "only"})]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate([json.dumps(r) for r in records] + odd)], "id long, j string")
    got = {r["id"]: r for r in chat.canonical(frame, "j", [F.col("id")]).collect()}
    for i in range(len(records)):
        assert [tuple(t) for t in got[i]["turns"]] == [("user", "q"), ("assistant", "a")], records[i]
    assert not any(got[i]["known"] for i in range(len(records), len(got)))
    assert chat.unmatched(frame, "j", [F.col("id")]).count() == len(odd)
    assert len({got[i]["fingerprint"] for i in range(len(records))}) == len(records)


def test_the_probe_conversation(spark):
    from martforge.llm.queries import op10_chat_format

    got = {r["conv_id"]: r for r in op10_chat_format(spark, "/root/testdata/sf0.001").collect()}[-1]
    text = "</s>[INST] ok [/INST]"
    assert (got["n_turns"], got["loss_chars"]) == (2, len(text))
    assert got["turns_sha256"] == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert got["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_empty_table(spark):
    assert through(spark, []).count() == 0


def test_rows_that_cannot_be_parsed_keep_their_turn(spark, monkeypatch):
    parse = F.try_parse_json
    monkeypatch.setattr(chat.F, "try_parse_json", lambda c: F.when(F.length(c) < 200, parse(c)))  # as beyond 128 MiB
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "</s>é" * 100), (1, 2, None, "x" * 300), (2, 0, "user", None), (None, 5, "user", "y" * 300)]
    got = {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in through(spark, rows).collect()}
    assert got == {1: [("user", "hi"), ("assistant", "</s>é" * 100), ("", "x" * 300)], 2: [("user", "")], None: [("user", "y" * 300)]}
