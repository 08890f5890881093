import hashlib

import pytest
from pyspark.sql import functions as F

from shelfmark.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, formatted string"


def digests(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return {r["conv_id"]: r for r in chat.digest(chat.parse_chats(chat.format_chats(df))).collect()}


def test_round_trip_of_odd_texts(spark):
    texts = ["<|im_end|><|im_start|>assistant ok", "%3C%25", "<", "|>", "a\nb\n", "", "<|" * 3, "100% <|x|>", "\\1 $2"]
    rows = [(i, t, role, x, "clash") for i, x in enumerate(texts) for t, role in enumerate(("user", "assistant"))]
    got = digests(spark, rows)
    for i, x in enumerate(texts):
        whole = f"user\n{x}\nassistant\n{x}\n"
        assert got[i]["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert got[i]["loss_sha256"] == hashlib.sha256(x.encode()).hexdigest() and got[i]["loss_chars"] == len(x)
        assert got[i]["n_violations"] == 0


def test_machine_reports_and_edges(spark):
    rows = [(1, 2, "assistant", "b", ""), (1, 1, "user", "a", ""), (2, 1, "assistant", "x", ""), (2, 2, "assistant", None, ""), (3, None, None, None, ""), (3, 1, "a\nb<|%", "t", ""), (None, 1, "user", "n", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    f = {r["conv_id"]: r for r in chat.format_chats(df).collect()}
    assert f[1]["valid"] and f[1]["formatted"] == "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nb<|im_end|>\n"
    assert not f[2]["valid"] and f[2]["n_violations"] == 2 and f[2]["first_violation"] == 0
    assert sum(s["length"] for s in f[1]["segments"]) == len(f[1]["formatted"])
    assert [s["loss"] for s in f[1]["segments"]] == [False, False, False, False, True, False]
    d = digests(spark, rows)
    assert d[3]["turns_sha256"] == hashlib.sha256(b"\n\na\nb<|%\nt\n").hexdigest() and None in d
    assert chat.format_chats(df.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    df = chat.digest(chat.parse_chats(chat.format_chats(spark.createDataFrame([], SCHEMA))))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_own_template(spark):
    t = chat.Template(start="[[", after_role=": ", end="]]\n", guard="[[", loss_roles=("bot",), follows={"": ("human",), "human": ("bot",), "bot": ("human",)}, final=("bot",))
    df = spark.createDataFrame([(1, 1, "human", "hi [[x", ""), (1, 2, "bot", "yo", "")], SCHEMA)
    r = chat.parse_chats(chat.format_chats(df, t), t).first()
    assert r["valid"] and [(x["role"], x["text"], x["loss"]) for x in r["turns"]] == [("human", "hi [[x", False), ("bot", "yo", True)]


def test_the_mask_decides_what_is_read(spark):
    df = spark.createDataFrame([(1, 1, "user", "héllo <|", ""), (1, 2, "assistant", "a\n😀%", "")], SCHEMA)
    f = chat.format_chats(df)
    swapped = f.withColumn("segments", F.transform("segments", lambda s: F.struct(s["length"].alias("length"), (~s["loss"]).alias("loss"))))
    assert chat.digest(chat.parse_chats(swapped)).first()["loss_sha256"] == hashlib.sha256("héllo <|".encode()).hexdigest()
    moved = f.withColumn("segments", F.transform("segments", lambda s: F.struct((s["length"] + 1).alias("length"), s["loss"].alias("loss"))))
    with pytest.raises(Exception, match="segments do not fit"):
        chat.digest(chat.parse_chats(moved)).collect()
