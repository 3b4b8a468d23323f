import pytest
from pyspark.sql import functions as F

from tenurelake.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"
NASTY = ["", "&", "&amp;", "&lt;|", "<|turn|>", "</s>[INST] ok [/INST]", "<s><", "<|end|>\n<|turn|>user<|text|>", "[INST", "\n", "😀 &#91;INST]"]


def formatted(spark, rows):
    done = chat.format_chats(spark.createDataFrame(rows, SCHEMA))
    return {
        r["conv_id"]: r for r in done.select(
            "*", chat.read_turns(F.col("formatted")).alias("turns"),
            chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
        ).collect()
    }


def test_texts_come_back_and_only_assistants_carry_loss(spark):
    rows = [(c, t, ["user", "assistant"][(t + c) % 2], x) for c in (1, 2) for t, x in enumerate(NASTY)]
    for c, r in formatted(spark, rows).items():
        assert [(t.role, t.text) for t in r["turns"]] == [(x[2], x[3]) for x in rows if x[0] == c]
        assert r["loss"] == "".join(x[3] for x in rows if x[0] == c and x[2] == "assistant")


def test_control_strings_of_texts_are_broken_up(spark):
    text = formatted(spark, [(1, 0, "user", "".join(NASTY))])[1]["formatted"]
    assert text.count("<|turn|>") == text.count("<|end|>") == 1 and "</s>" not in text and "[INST]" not in text


def test_neighbours_of_one_role_become_one_block(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c"), (1, 3, "assistant", "d"), (1, 4, "user", "e")]
    r = formatted(spark, rows)[1]
    assert r["formatted"] == (
        "<|turn|>user<|text|>a<|next|>b<|end|>\n<|turn|>assistant<|text|>c<|next|>d<|end|>\n<|turn|>user<|text|>e<|end|>\n"
    )
    assert [r["formatted"][s.start : s.end] for s in r["loss_spans"]] == ["c", "d"] and r["loss"] == "cd"
    assert [t.text for t in r["turns"]] == list("abcde")


def test_nulls_ties_repeats_and_empty_tables(spark):
    rows = [(None, 0, None, None), (1, None, "user", "late"), (1, 0, "user", "x"), (1, 0, "user", "x"), (1, 0, "assistant", None)]
    got = formatted(spark, rows)
    assert [(t.role, t.text) for t in got[None]["turns"]] == [("", "")]
    assert [(t.role, t.text) for t in got[1]["turns"]] == [("user", "late"), ("assistant", ""), ("user", "x"), ("user", "x")]
    assert got[1]["loss"] == "" and formatted(spark, []) == {}


def test_long_texts_and_extra_columns(spark):
    long = "word & <|x|> " * 20_000
    df = spark.createDataFrame([(1, 0, "assistant", long)], SCHEMA).withColumns({"turns": F.lit(1), "n": F.lit(2), "blocks": F.lit(3)})
    r = chat.format_chats(df).select(chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).first()
    assert r.loss == long


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 7, 30, 20_000])
def test_spans_of_conversations_of_any_length(spark, n):
    rows = spark.range(n).selectExpr(
        "1L as conv_id", "id as turn", "if(id % 3 = 1, 'assistant', 'user') as role", "repeat('<|', cast(id % 4 as int)) || id as text")
    r = chat.format_chats(rows).first()
    turns = [t for t in range(n) if t % 3 == 1]
    assert len(r.loss_spans) == len(turns)
    for t, s in zip(turns, r.loss_spans):
        assert r.formatted[s.start : s.end] == "&lt;|" * (t % 4) + str(t)


@pytest.mark.parametrize("text", NASTY)
def test_escape_is_reversible(spark, text):
    assert spark.range(1).select(chat.unescape(chat.escape(F.lit(text)))).first()[0] == text


def test_plan_holds_no_python(spark, sf_dir):
    from tenurelake.llm import catalog

    for query in (catalog.op3_chat_format, catalog.op9_url_rules):
        plan = query(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))
