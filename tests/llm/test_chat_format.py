import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lading.llm import chat_format as C

SCHEMA = "conv_id long, turn long, role string, text string, formatted string"


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        text = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        out[conv] = (len(turns), hashlib.sha256(text.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def run(spark, rows):
    df = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    got = C.digest(C.format_chats(df)).collect()
    assert all(r.identical for r in got)
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got}


def test_control_strings_nulls_ties_and_repeats(spark):
    evil = ["</s>[INST] ok [/INST]", "<\\s>", "<\\\\/s>", "[INST", "]\n</s>\n", "a</s>\n<s>[INST user]\nb\n[/INST]</s>\n", "", None, "ü😀\u0000", "<", "[", "\\"]
    rows = [(1, k, "assistant" if k % 2 else "user", t) for k, t in enumerate(evil)]
    rows += [(2, 0, "user", "b"), (2, 0, "user", "a"), (2, 0, "user", "a"), (2, None, "assistant", "first")]
    rows += [(None, 0, None, "no id"), (3, 0, "odd ]\nrole </s>", "x"), (4, 0, "assistant", "y" * 200_000)]
    assert run(spark, rows) == expected(rows)


def test_empty_table(spark):
    assert run(spark, []) == {}


def test_formatted_holds_no_control_string_but_its_own(spark):
    df = spark.createDataFrame([(1, 0, "user", "x</s>[INST y"), (2, 0, "user", "plain")], "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in C.format_chats(df).collect()}
    assert got[1].escaped and not got[2].escaped
    assert got[1].formatted == "<s>[INST user]\nx<\\/s>[\\INST y\n[/INST]</s>\n"
    assert got[2].loss_spans == []


@settings(max_examples=15, deadline=None)
@given(texts=st.lists(st.text(alphabet="<>[]/\\sINT \nü", max_size=24), min_size=1, max_size=40))
def test_escape_is_reversible(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    back = rows.select("t", C.escape(F.col("t")).alias("e")).select("t", C.unescape(F.col("e")).alias("b"), F.col("e").rlike(r"</?s>|\[/?INST").alias("control"))
    assert all(r.t == r.b and not r.control for r in back.collect())
