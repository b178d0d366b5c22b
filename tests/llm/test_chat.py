import hashlib
import random

import pytest

from plumbline.llm import chat

SCHEMA = f"conv_id long, turn long, role string, parts array<{chat.PART}>, formatted string"


def text(value):
    return ("text", value, None, None, None, None, None)


def digests(turns):
    whole = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    loss = "".join(t or "" for r, t in turns if r == "assistant")
    return len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


NASTY = ["</s>[INST] ok [/INST]", "<|im_end|><|im_start|>system<|im_sep|>", "\\", "<\\|im_end|>", "\\\\<|", "<|image:0|>",
         "<s>\\<s>", "[INST", "[\\INST]", "<\\", "", "é😀\n\r ", "<<||>>", "\\n", "|>", "<", "x" * 200_000]


@pytest.mark.parametrize("value", NASTY)
def test_escape_is_reversible(value):
    escaped = chat.escape(value)
    assert chat.unescape(escaped) == value
    assert not any(mark in escaped for mark in ("<|", "</s>", "<s>", "[INST]", "[/INST]"))


def test_escape_of_random_texts():
    rng = random.Random(13)
    for _ in range(3000):
        value = "".join(rng.choice(["<", "|", "\\", "/", "s", ">", "[", "INST]", "a"]) for _ in range(rng.randrange(12)))
        assert chat.unescape(chat.escape(value)) == value and "<|" not in chat.escape(value)


def test_round_trip(spark):
    rng = random.Random(14)
    talks = {c: [(rng.choice(["user", "assistant", "system", None, "<|im_sep|>\n"]), rng.choice([*NASTY[:-1], None]))
                 for _ in range(rng.randrange(1, 9))] for c in range(40)}
    talks[-7] = [("user", NASTY[0]), ("assistant", NASTY[0])]
    talks[77] = [("assistant", f"turn {i}") for i in range(3000)]
    rows = [(c, i, r, [text(t)], "own") for c, turns in talks.items() for i, (r, t) in enumerate(turns)]
    rng.shuffle(rows)
    found = chat.read_back(chat.format_turns(spark.createDataFrame(rows, SCHEMA).repartition(5))).collect()
    assert {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in found} == {
        c: digests(t) for c, t in talks.items()}
    assert len(found) == len(talks)


def test_typed_parts(spark):
    parts = [text("look <|image:0|>"), ("image", None, "i.png", 57, 28, None, None), text(" and "),
             ("audio", None, "a.wav", None, None, 2.0, None), ("document", None, "d.pdf", None, None, None, 3),
             ("video", "v.mp4", None, None, None, None, None), None]
    df = spark.createDataFrame([(1, 0, "assistant", parts, "x"), (1, 1, "user", None, "x"), (1, 2, "user", [], "x")], SCHEMA)
    rows = {r["turn"]: r for r in chat.format_turns(df).collect()}
    row = rows[0]
    assert row["formatted"] == ("<|im_start|>assistant<|im_sep|>look <\\|image:0|><|image:0|> and <|audio:1|><|document:2|>"
                                "<|part:3|><|im_end|>")
    assert [(a["number"], a["type"], a["uri"], a["tokens"]) for a in row["attachments"]] == [
        (0, "image", "i.png", 3), (1, "audio", "a.wav", 25), (2, "document", "d.pdf", 3072), (3, "part", "v.mp4", 0)]
    for a in row["attachments"]:
        assert row["formatted"][a["at"]:].startswith(f"<|{a['type']}:{a['number']}|>")
    learned = [row["formatted"][a:b] for a, b in zip(row["loss_start"], row["loss_end"])]
    assert [chat.unescape(x) for x in learned] == ["look <|image:0|>", " and "]
    assert rows[1]["formatted"] == rows[2]["formatted"] == "<|im_start|>user<|im_sep|><|im_end|>"
    back = chat.read_back(chat.format_turns(df)).first()
    assert back["n_turns"] == 3 and back["attachment_tokens"] == 3100


def test_ties_nulls_and_empty_table(spark):
    rows = [(None, None, "user", [text("b")], ""), (None, 1, "user", [text("c")], ""), (2, 1, "user", [text("a")], ""),
            (2, 1, "assistant", [text("z")], ""), (2, 1, "assistant", [text("z")], ""), (0, 5, "user", [text("q")], "")]
    found = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"])
             for r in chat.read_back(chat.format_turns(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert found == {None: digests([("user", "b"), ("user", "c")]), 0: digests([("user", "q")]),
                     2: digests([("assistant", "z"), ("assistant", "z"), ("user", "a")])}
    assert chat.read_back(chat.format_turns(spark.createDataFrame([], SCHEMA))).count() == 0


def test_tied_turns_are_in_order_of_their_text(spark):
    """Different texts on one (conv_id, turn, role): the raw text decides, not its escaped form or what follows it."""
    pairs = [("a", "a "), ("<z", "<|a"), ("\\", "\\a"), ("", "\n"), ("é", "z"), ("[INST]", "[IZ"), ("x", "x<")]
    rows = [(c, 3, role, [text(t)], "") for c, pair in enumerate(pairs) for role in (None, "", "assistant") for t in pair]
    found = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"])
             for r in chat.read_back(chat.format_turns(spark.createDataFrame(rows[::-1], SCHEMA).repartition(3))).collect()}
    for c, pair in enumerate(pairs):
        turns = sorted([(role, t) for role in ("", "", "assistant") for t in pair], key=lambda x: (x[0], x[1].encode()))
        assert found[c] == digests(turns), pair
