"""Prefix-target expansion."""

import pytest
from pyspark.sql import functions as F

from marquee.llm.chat import escape, expand_prefix_targets, parse, trainable, unescape

ODD = ["", "plain", "\\", "\\\\e", "\\e \\h \\c", "### x</turn>", "##### ", "</tu</turn>rn>", "\\### Assistant: </turn> ok", "a: b\n\n", "é\\", "</turn>\n### user: hi</turn>\n"]


def test_escapes_come_back(spark):
    rows = spark.createDataFrame([(t,) for t in ODD], "t string")
    shown = rows.select("t", escape(F.col("t"), (":",)).alias("e")).withColumn("u", unescape(F.col("e"))).collect()
    for r in shown:
        assert r.u == r.t
        assert "### " not in r.e and "</turn>" not in r.e and ":" not in r.e


def conversation(spark, rows):
    kind = "conv_id long, turn int, role string, text string, example string, loss int"
    return spark.createDataFrame([(*r, "x", 1) for r in rows], kind)


def examples(spark, rows):
    made = expand_prefix_targets(conversation(spark, rows))
    read = made.select("*", trainable(F.col("text"), F.col("loss_start"), F.col("loss_length")).alias("loss"), parse(F.col("text")).alias("turns"))
    return sorted(read.collect(), key=lambda r: (r.conv_id is not None, r.conv_id or 0, r.example))


def test_each_reply_is_an_example_with_all_turns_before(spark):
    rows = [(1, 2, "assistant", "A1"), (1, 0, "system", "S"), (1, 1, "user", "U1"), (1, 3, "user", "U2"), (1, 4, "assistant", "A2"), (1, 5, "user", "last")]
    found = examples(spark, rows)
    assert [[t.text for t in e.turns] for e in found] == [["S", "U1", "A1"], ["S", "U1", "A1", "U2", "A2"], ["S", "U1", "A1", "U2", "A2", "last"]]
    assert [e.loss for e in found] == ["A1", "A2", ""]
    assert [e.is_last for e in found] == [False, False, True]
    assert found[0].text == "### system: S</turn>\n### user: U1</turn>\n### assistant: A1</turn>\n"


def test_odd_turns(spark):
    rows = [(1, i, "assistant" if i % 2 else t, t) for i, t in enumerate(ODD)]
    last = examples(spark, rows)[-1]
    assert [(t.role, t.text) for t in last.turns] == [(r, t) for _, _, r, t in rows]
    rows = [(None, 0, "user", "n"), (2, None, None, None), (2, 1, "assistant", None), (2, 1, "assistant", None), (3, 0, "user", "alone")]
    found = examples(spark, rows)
    assert [(e.conv_id, e.n_turns, e.loss, [(t.role, t.text) for t in e.turns]) for e in found] == [
        (None, 1, "", [("user", "n")]),
        (2, 2, "", [("", ""), ("assistant", "")]),
        (2, 3, "", [("", ""), ("assistant", ""), ("assistant", "")]),
        (3, 1, "", [("user", "alone")]),
    ]
    assert examples(spark, []) == []
    nameless = [(None, i, "assistant", f"a{i}") for i in range(5)] + [(None, 0, "assistant", "a0")]
    assert sorted((e.n_turns, e.loss, e.is_last) for e in examples(spark, nameless)) == sorted((1, t, True) for _, _, _, t in nameless)


def test_a_long_text_and_many_turns(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", "é\\" * 20_000 if i == 1 else str(i)) for i in range(200)]
    found = examples(spark, rows)
    assert len(found) == 100 and found[0].loss == "é\\" * 20_000 and len(found[-1].turns) == 200


@pytest.mark.parametrize("scale", ["0.001", "0.01"])
def test_query_against_sql(spark, scale):
    from compare import duck, duck_rows, spark_rows
    from marquee.llm.queries import ORACLE, QUERIES

    folder = f"/root/testdata/sf{scale}"
    assert spark_rows(QUERIES["op2_chat"](spark, folder)) == duck_rows(duck(folder), ORACLE["op2_chat"])


def test_rows_without_an_id_against_sql(spark, tmp_path):
    from compare import duck, duck_rows, spark_rows
    from marquee.llm.queries import ORACLE, QUERIES

    rows = [(None, i % 3, ("user", "assistant", None)[i % 3], f"t{i % 4}") for i in range(12)] + [(1, 0, "user", "q"), (1, 1, "assistant", "r")]
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    frame.coalesce(1).write.parquet(f"{tmp_path}/made")
    (file,) = (tmp_path / "made").glob("*.parquet")
    file.rename(tmp_path / "conversations.parquet")
    assert spark_rows(QUERIES["op2_chat"](spark, str(tmp_path))) == duck_rows(duck(str(tmp_path)), ORACLE["op2_chat"])
