import hashlib
import random

from pyspark.sql import functions as F

from tallywork.llm import chat

TEMPLATE = chat.ChatTemplate()
SCHEMA = "conv_id bigint, turn bigint, role string, text string, valid string, turns int, loss int"


def _turns(spark, rows):
    return spark.createDataFrame([(*r, "a", 1, 2) for r in rows], SCHEMA)


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _escape(text):
    import re

    return re.sub(r"<(?=\||/?s>)|\[(?=/?INST\])", lambda m: m[0] + "\\", text.replace("\\", "\\\\"))


def _expected(turns):
    turns = [(r or "", t or "") for r, t in turns]
    loss = "".join(t for r, t in turns if r == "assistant")
    whole = "".join(f"<|turn|>{_escape(r)}<|text|>{_escape(t)}<|end|>" for r, t in turns)
    return {
        "n_turns": len(turns),
        "turns_sha256": _sha("".join(f"{r}\n{t}\n" for r, t in turns)),
        "loss_chars": len(loss),
        "loss_sha256": _sha(loss),
        "formatted_chars": len(whole),
    }


def _found(df):
    formatted = chat.format_chats(df, TEMPLATE)
    return {r.conv_id: r for r in chat.digests(formatted, TEMPLATE).collect()}


def test_control_strings_come_back(spark):
    rng = random.Random(10)
    parts = ["<|turn|>", "<|text|>", "<|end|>", "<|", "|>", "<", "|", "\\", "</s>", "<s>", "[INST]"]
    parts += ["[/INST]", "[", "\n", "a", "é", "\U0001f600", "$1", "$0", "\\E", "\\Q", " "]
    conversations = {
        key: [
            (rng.choice(["user", "assistant", "system", "".join(rng.choices(parts, k=2))]),
             "".join(rng.choices(parts, k=rng.randint(0, 12))))
            for _ in range(rng.randint(1, 6))
        ]
        for key in range(300)
    }
    conversations[-7] = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
    rows = [(k, i, r, t) for k, turns in conversations.items() for i, (r, t) in enumerate(turns)]
    found = _found(_turns(spark, rows).repartition(7))
    assert len(found) == len(conversations)
    for key, turns in conversations.items():
        assert {n: found[key][n] for n in _expected(turns)} == _expected(turns), turns


def test_escaped_text_holds_no_control_string(spark):
    text = r"<|turn|> <\|end|> </s> <s> [INST] [/INST] \[INST] <<|end|>"
    row = spark.range(1).select(chat.escape(F.lit(text), TEMPLATE).alias("e")).first()
    assert not any(c in row.e for c in ("<|", "<s>", "</s>", "[INST]", "[/INST]"))


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(1, 2, "assistant", "b"), (1, None, "user", None), (1, 2, "assistant", "a")]
    rows += [(1, 2, "assistant", "a"), (None, 0, None, "x"), (None, 1, "assistant", "y")]
    found = _found(_turns(spark, rows))
    one = _expected([("user", ""), ("assistant", "a"), ("assistant", "a"), ("assistant", "b")])
    none = _expected([("", "x"), ("assistant", "y")])
    assert {n: found[1][n] for n in one} == one
    assert {n: found[None][n] for n in none} == none
    assert not found[1].valid and not found[None].valid


def test_order_of_turns(spark):
    orders = {
        1: ["user", "assistant"],
        2: ["system", "user", "assistant", "user"],
        3: ["assistant"],
        4: ["user", "user"],
        5: ["user", "system"],
        6: ["user", "tool"],
        7: ["system", "user", "assistant"],
    }
    rows = [(k, i, r, "t") for k, roles in orders.items() for i, r in enumerate(roles)]
    found = _found(_turns(spark, rows))
    assert {k for k, r in found.items() if r.valid} == {1, 7}  # 2 ends before its answer
    open_end = chat.ChatTemplate(accepting=("user", "assistant"))
    rows = chat.format_chats(_turns(spark, rows), open_end).collect()
    assert {r.conv_id for r in rows if r.valid} == {1, 2, 7}


def test_segments_make_the_text_and_the_mask(spark):
    row = chat.format_chats(
        _turns(spark, [(1, 0, "user", "hi"), (1, 1, "assistant", "a[INST]")]), TEMPLATE
    ).first()
    assert row.formatted == "".join(s.text for s in row.segments)
    assert [s.text for s in row.segments if s.loss] == ["a[\\INST]"]


def test_empty_table_and_native_plan(spark):
    df = _turns(spark, [])
    found = chat.digests(chat.format_chats(df, TEMPLATE), TEMPLATE)
    assert found.collect() == []
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_another_template(spark):
    own = chat.ChatTemplate(
        opening="[INST]", before_text="</s>", closing="[/INST]", loss_roles=("user",)
    )
    df = _turns(spark, [(1, 0, "user", "x [INST] </s>"), (1, 1, "assistant", "y[/INST]")])
    formatted = chat.format_chats(df, own)
    row = chat.digests(formatted, own).first()
    assert row.turns_sha256 == _sha("user\nx [INST] </s>\nassistant\ny[/INST]\n")
    assert row.loss_sha256 == _sha("x [INST] </s>")
