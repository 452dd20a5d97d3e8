"""Fill-in-the-middle examples against plain string cuts."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import duck, duck_rows, spark_rows
from marquee.llm.fill_in_middle import Exceptions, examples, restored
from marquee.llm.queries import ORACLE, QUERIES

DATA = "/root/testdata/sf0.001"


def plain(name, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if name is None else name}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(text)
    one, two = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = text[:one], text[one:two], text[two:]
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return name, n, "plain", None, None, text, text
    made = f"<S>{s}<P>{p}<M>{m}" if h4 % 100 < 20 else f"<P>{p}<S>{s}<M>{m}"
    return name, n, "spm" if h4 % 100 < 20 else "psm", len(p), len(m), made, text


def test_the_index_turns_points_into_bytes_and_back():
    draw = random.Random(1)
    texts = ["".join(draw.choices("ab\x00é€😀́", k=draw.randint(0, 40))) for _ in range(50)] + ["", "plain", ""]
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    index = Exceptions(np.frombuffer("".join(texts).encode(), np.uint8), offsets)
    assert index.lengths().tolist() == [len(t) for t in texts]
    assert len(index.points) == sum(ord(c) > 127 for t in texts for c in t)
    for i, text in enumerate(texts):
        points = index.starts[i] + np.arange(len(text) + 1)
        at = index.to_byte(points)
        assert (at - offsets[i]).tolist() == [len(text[:k].encode()) for k in range(len(text) + 1)]
        assert (index.to_point(at) == points).all()


def test_odd_texts(spark):
    draw = random.Random(2)
    rows = [(i, "".join(draw.choices(["a", "é", "€", "😀", "<", "P", "S", "M", ">", "\n", "\x00"], k=draw.randint(0, 30)))) for i in range(400)]
    rows += [(400, ""), (401, None), (None, "no id é"), (None, None), (402, "has <P> in it"), (402, "twice"), (402, "twice")]
    rows += [(500 + i, "é😀x" * 60_000) for i in range(4)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, output string, n int")
    found = examples(frame).withColumn("restored", restored(F.col("output"), F.col("form")))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted((plain(*r) for r in rows), key=repr)
    assert {r["form"] for r in found.collect()} == {"plain", "psm", "spm"}
    assert examples(frame.limit(0)).collect() == []


@pytest.mark.parametrize("scale", ["0.001", "0.01"])
def test_same_as_sql(spark, scale):
    folder = f"/root/testdata/sf{scale}"
    columns, found = spark_rows(QUERIES["op11_fill_in_middle"](spark, folder))
    assert (columns, found) == duck_rows(duck(folder), ORACLE["op11_fill_in_middle"])
