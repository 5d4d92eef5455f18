import hashlib
import random
import re

import pytest

from overflight.llm import chat

PIECES = ["<", "[", "\\", "s>", "/s>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_end|>", "<|im_start|>", "\n",
          " a", "|im_end|>", "é\U0001f600"]


def table(spark, rows):
    return spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, role STRING, text STRING").selectExpr("*", "1 AS seq", "2 AS copy")


def wanted(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(((t is not None, t or 0, role or "", text or "") for c, t, role, text in rows if c == conv))
        learned = "".join(text for *_, role, text in turns if role == "assistant")
        whole = "".join(f"{role}\n{text}\n" for *_, role, text in turns)
        out[conv] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest())
    return out


def test_conversations_come_back(spark):
    draw = random.Random(5)
    text = lambda: "".join(draw.choice(PIECES) for _ in range(draw.randrange(12)))
    rows = [(draw.choice([None, *range(40)]), draw.choice([None, 0, 1, 2, 3]), draw.choice(["user", "assistant", "system", None, "a\nb\\n"]), text())
            for _ in range(800)]
    rows += [(77, i, "assistant" if i % 2 else "user", text()) for i in range(3000)]  # one long conversation
    rows += [(78, 0, "user", None), (78, 1, "assistant", ""), (79, 0, "assistant", "x" * 300_000), (79, 0, "assistant", "x" * 300_000)]
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.formatted(table(spark, rows)).collect()}
    assert got == wanted(rows)


def test_no_control_string_inside(spark):
    draw = random.Random(6)
    rows = [(1, i, "user", "".join(draw.choice(PIECES) for _ in range(9))) for i in range(300)]
    for r in chat.rendered(chat.messages(table(spark, rows))).collect():
        body = r.segment[len(chat.START):-len(chat.END) - 1]
        assert not re.search(r"<\|im_start\|>|<\|im_end\|>|</?s>|\[/?INST\]|<<SYS>>|<</SYS>>", body)
        assert chat.parse(r.segment) == ("user", rows[r.turn][3])
    with pytest.raises(ValueError):
        chat.parse("no segment")


def test_folding(spark):
    log = [(0, "delta", "He"), (1, "delta", "llo"), (2, "regenerate", ""), (3, "delta", "Good"), (4, "edit", "Bye"), (5, "delta", " now"), (6, "delta", None)]
    rows = [(1, 0, 1, "assistant", *e) for e in log] + [(1, 0, 2, "user", *e) for e in log[:2]] + [(1, 1, 1, "user", 0, "delta", None)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, copy INT, role STRING, seq INT, kind STRING, payload STRING")
    got = {(r.turn, r.copy): (r.role, r.text) for r in chat.folded(df).collect()}
    assert got == {(0, 1): ("assistant", "Bye now"), (0, 2): ("user", "Hello"), (1, 1): ("user", "")}


def test_empty_table(spark):
    assert chat.formatted(table(spark, [])).collect() == []
