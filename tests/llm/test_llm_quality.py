"""The compression classifier: held-out accuracy and odd inputs."""

import zlib

import pytest
from pyspark.sql import functions as F

from marquee.llm.quality import CompressionClassifier


def test_held_out_accuracy(spark):
    from marquee.llm.queries import QUERIES

    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = QUERIES["op7_quality"](spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    judged = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(p == y for p, y in judged) / len(judged) > 0.96
    good = [p for p, y in judged if y == 1]
    bad = [p for p, y in judged if y == 0]
    assert sum(good) / len(good) > 0.98
    assert sum(bad) / len(bad) < 0.15


def tables(spark, rows):
    """Documents and labels, either with columns that clash with names used inside."""
    docs = spark.createDataFrame([(i, t, 7, "p") for i, t, _ in rows], "id long, words string, label int, place string")
    labels = spark.createDataFrame([(i, y, "x") for i, _, y in rows], "id long, mark int, text string")
    return docs, labels


def test_odd_texts_and_clashing_columns(spark):
    rows = [(i, f"plain prose number {i} about the weather of the day and the sea", 1) for i in range(30)]
    rows += [(100 + i, f"BUY!! NOW!! {i}!! CHEAP!! CHEAP!!", 0) for i in range(30)]
    rows += [(None, "none", 1), (201, None, 0), (202, "unlabelled", None), (203, "", 1), *rows[:3]]
    docs, labels = tables(spark, rows)
    model = CompressionClassifier.fit(docs, labels, "id", "words", "mark")
    texts = [None, "", "plain prose about the weather", "CHEAP!! NOW!! BUY!!", "x " * 50_000, "é"]
    asked = spark.createDataFrame([(t, 1.0, "z") for t in texts], "text string, score double, label string")
    scores = [r.s for r in asked.withColumn("s", model.score(F.col("text"))).collect()]
    assert scores[0] == scores[1] == pytest.approx(model.share)
    assert scores[2] > 0.5 > scores[3]
    assert all(0 <= s <= 1 for s in scores)
    again = CompressionClassifier.fit(docs.repartition(5), labels.repartition(3), "id", "words", "mark")
    assert again.weights == pytest.approx(model.weights)


@pytest.mark.parametrize("rows, share", [([], 0.5), ([(1, "a", 1)], 0.99), ([(1, "a", 0), (2, "b", 0)], 0.01)])
def test_labels_of_one_class_or_none(spark, rows, share):
    model = CompressionClassifier.fit(*tables(spark, rows), "id", "words", "mark")
    found = spark.createDataFrame([("any",), (None,)], "t string").select(model.score(F.col("t")).alias("s")).collect()
    assert [r.s for r in found] == [share, share]
    assert spark.createDataFrame([], "t string").select(model.score(F.col("t"))).collect() == []
