import hashlib

import pytest
from pyspark.sql import functions as F

from linkframe.llm import chat

TEXTS = ["hello", "", None, "\\", "\\\\l", "\\h\\c\\l", "</turn>", "<</turn>/turn>", "</turn>\n### assistant: no", "####", "#" * 9, ": a: b", "\n", "é\U0001f600", "x" * 50_000]
ROLES = ["user", "assistant", "system", None, "", "a: b", "###", "assistant: ", "</turn>\n", "\\"]


@pytest.fixture(scope="module")
def talk(spark):
    rows = [(1, i, ROLES[i % len(ROLES)], t) for i, t in enumerate(TEXTS * 2)]
    rows += [(2, 0, "user", "hi"), (2, 1, "assistant", "yes"), (2, 1, "assistant", "yes"), (2, 2, "assistant", "\\### </turn>"), (3, 0, "user", "alone")]
    rows += [(None, None, None, None), (4, None, "assistant", "first"), (4, 0, "user", "then"), (5, 0, "assistant", "a" * 3), (5, 1, "system", None)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def expected(rows):
    turns = sorted(((r["turn"] is not None, r["turn"] or 0, r["role"] or "", r["text"] or "") for r in rows))
    loss = "".join(t[3] for t in turns if t[2] == "assistant")
    said = "".join(f"{t[2]}\n{t[3]}\n" for t in turns)
    return len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_round_trip(talk):
    by_conv = {}
    for r in talk.collect():
        by_conv.setdefault(r["conv_id"], []).append(r)
    out = chat.read_back(chat.expand(talk)).collect()
    assert len(out) == len(by_conv)
    for r in out:
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == expected(by_conv[r["conv_id"]]), r["conv_id"]


def test_examples_are_prefixes_with_one_trainable_reply(talk):
    rows = chat.expand(talk).withColumn("loss", chat.loss_text()).where("conv_id = 2").orderBy("example").collect()
    assert [r["loss"] for r in rows] == ["yes", "yes", "\\### </turn>"]
    assert [r["target"] for r in rows] == [1, 2, 3]
    assert rows[0]["formatted"] == "### user: hi</turn>\n### assistant: yes</turn>\n"
    assert all(rows[2]["formatted"].startswith(r["formatted"]) for r in rows)
    tail = chat.expand(talk).where("conv_id = 3").first()
    assert tail["target"] is None and tail["loss_start"] == tail["loss_end"] and tail["last"]


def test_control_strings_only_in_the_template(talk):
    for r in chat.expand(talk).where("last").collect():
        turns = chat_turns(talk, r["conv_id"])
        assert r["formatted"].count("</turn>") == turns == r["formatted"].count("### ")


def chat_turns(talk, conv):
    return talk.where(F.col("conv_id").eqNullSafe(conv)).count()


def test_empty_and_extra_columns(talk):
    assert chat.read_back(chat.expand(talk.limit(0))).count() == 0
    extra = talk.withColumns({"formatted": F.lit(1), "last": F.lit("x"), "example": F.lit(None)})
    assert chat.read_back(chat.expand(extra)).count() == talk.select("conv_id").distinct().count()
