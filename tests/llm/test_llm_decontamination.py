"""Decontamination against all windows of all texts."""

import os
import random
import subprocess
import sys

import numpy as np
import pytest

from marquee.llm import decontamination
from marquee.llm.decontamination import Benchmark, Leaks, closest_passages, most_edits, words_of


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def vocabulary(draw, size):
    return ["".join(draw.choice("abcdefgh") for _ in range(5)) for _ in range(size)]


def edited(draw, words, edits, pool):
    words = list(words)
    for _ in range(edits):
        at = draw.randrange(len(words))
        kind = draw.choice("sid")
        if kind == "s":
            words[at] = draw.choice(pool)
        elif kind == "i":
            words.insert(at, draw.choice(pool))
        else:
            del words[at]
    return words


def test_closest_passages():
    draw = random.Random(1)
    rows = [([draw.randrange(4) for _ in range(6)], [draw.randrange(4) for _ in range(11)]) for _ in range(300)]
    found = closest_passages(np.array([a for a, _ in rows]), np.array([b for _, b in rows]))
    for (a, b), distance, begin, end in zip(rows, *(x.tolist() for x in found)):
        best = min((plain_distance(a, b[p:q]), q, q - p) for p in range(12) for q in range(p, 12))
        assert (distance, end, end - begin) == best


def test_recall_over_distances():
    draw = random.Random(2)
    pool = vocabulary(draw, 300)
    items = [(i, " ".join(draw.choice(pool) for _ in range(draw.randint(8, 60)))) for i in range(150)]
    leaks = Leaks(items)
    for share in (0.0, 0.05, 0.1, 0.15, 0.2):
        found = 0
        for item_id, text in items:
            words = words_of(text)
            n = len(words)
            around = [draw.choice(pool) for _ in range(2 * n)]
            inside = [*around[:n], *edited(draw, words, int(share * n), pool), *around[n:]]
            found += item_id in {leak[0] for leak in leaks.in_texts([" ".join(inside)])[0]}
        assert found == len(items) if share == 0 else found >= 0.95 * len(items)


@pytest.mark.parametrize("kinds", ["ii", "iii", "dd", "ddd", "sss", "sid"])
@pytest.mark.parametrize("place", ["middle", "start", "end", "alone"])
def test_net_insertions_and_deletions(kinds, place):
    """15-word items with as many edits as may be, of one direction, anywhere in a text."""
    draw = random.Random(f"{kinds} {place}")
    pool = vocabulary(draw, 400)
    items = [(i, " ".join(draw.choice(pool) for _ in range(15))) for i in range(100)]
    leaks, found = Leaks(items), 0
    for item_id, text in items:
        words = words_of(text)
        for kind in kinds:
            at = draw.randrange(1, len(words) - 1)
            words[at : at + (kind != "i")] = [draw.choice(pool)] if kind != "d" else []
        before, after = ([draw.choice(pool) for _ in range(40)] for _ in range(2))
        inside = {"middle": before + words + after, "start": words + after, "end": before + words, "alone": words}[place]
        found += item_id in {leak[0] for leak in leaks.in_texts([" ".join(inside)])[0]}
    assert found >= 95


def test_short_items_are_found_word_for_word():
    leaks = Leaks([(1, "one two"), (2, "alpha"), (3, "red green blue dot"), (4, "two one"), (5, "ONE, two!")])
    found = leaks.in_texts(["alpha one two one", "red green blue dots", "red green blue dot", "one", "Alpha-alpha", "two\none"])
    assert [[(i, d) for i, _, _, d in f] for f in found] == [[(2, 0), (1, 0), (5, 0), (4, 0)], [], [(3, 0)], [], [(2, 0), (2, 0)], [(4, 0)]]


def test_a_long_item_in_bounded_memory():
    code = """
import random, resource
from marquee.llm.decontamination import Leaks
draw = random.Random(1)
pool = [f"w{n}" for n in range(20000)]
words = draw.choices(pool, k=5000)
items = [(1, " ".join(words)), (2, " ".join(draw.choices(pool, k=4000)))]
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
changed = [w for w in words if draw.random() > 0.02]
text = " ".join(draw.choices(pool, k=3000) + changed + draw.choices(pool, k=3000))
print(Leaks(items).in_texts([text])[0][0][0], resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
"""
    root = os.path.dirname(os.path.dirname(decontamination.__file__))
    ran = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, env=os.environ | {"PYTHONPATH": os.path.dirname(root)})
    item, megabytes = map(int, ran.stdout.split())
    assert item == 1 and megabytes < 500


def test_random_texts_are_clean():
    draw = random.Random(3)
    pool = vocabulary(draw, 40)
    items = [(i, " ".join(draw.choice(pool) for _ in range(20))) for i in range(50)]
    texts = [" ".join(draw.choice(pool) for _ in range(400)) for _ in range(20)]
    for text, leaks in zip(texts, Leaks(items).in_texts(texts)):
        for item, start, end, distance in leaks:
            assert plain_distance(words_of(items[item][1]), words_of(text[start:end])) == distance <= 4


ITEM = "The quick brown fox, jumps over the lazy dog and İstanbul."
ITEMS = [(1, ITEM), (2, None), (3, ""), (4, "too short"), (5, ITEM.upper()), (6, "one two three four five six"), (None, "one two three four five six")]


def tables(spark, texts):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], "doc_id long, text string, item_id int, leak string")
    return Benchmark(items), docs


TEXTS = [
    None, "", "nothing", f"İ before {ITEM} after", "THE QUICK!! BROWN!! FOX!! JUMPS!! OVER!! THE!! LAZY!! DOG!! AND!! İSTANBUL!!",
    "the quick brown cat jumps over the lazy dog and i̇stanbul", "one two three four five six one two three four five six",
    "fox " * 50_000 + ITEM, "one two three four", ITEM, ITEM,
]


def test_odd_texts_and_items(spark):
    benchmark, docs = tables(spark, TEXTS)
    rows = benchmark.leaks(docs).collect()
    by_text = {i: sorted((r.item_id, r.distance) for r in rows if r.doc_id == i) for i in range(len(TEXTS))}
    both = [(1, 0), (5, 0)]
    assert [by_text[i] for i in (0, 1, 2, 8)] == [[], [], [], []]
    assert by_text[3] == by_text[7] == by_text[9] == by_text[10] == both
    assert [i for i, _ in by_text[4]] == [1, 5] and [i for i, _ in by_text[5]] == [1, 5]
    assert by_text[6] == [(6, 0), (6, 0)]
    (spot,) = {(r.start, r.end) for r in rows if r.doc_id == 3}
    assert TEXTS[3][slice(*spot)] == ITEM.rstrip(".")
    kept = benchmark.without_leaks(docs).collect()
    assert [r.doc_id for r in kept] == [0, 1, 2, 8] and kept[0].asDict().keys() == {"doc_id", "text", "item_id", "leak"}


def test_items_without_an_id(spark, monkeypatch):
    items = [(None, ITEM), (None, ITEM.upper()), (None, None), (None, "one two three four five six"), (6, "ONE two three four five six")]
    items = spark.createDataFrame(items, "item_id long, text string")
    _, docs = tables(spark, ["nothing here", f"before {ITEM} after", "one two three four five six", f"one two three four five six {ITEM}"])
    for size in (decontamination.PART_CHARACTERS, 30):
        monkeypatch.setattr(decontamination, "PART_CHARACTERS", size)
        benchmark = Benchmark(items)
        found = sorted(((r.doc_id, r.item_id, r.distance) for r in benchmark.leaks(docs).collect()), key=str)
        assert found == [(1, None, 0), (2, 6, 0), (3, 6, 0), (3, None, 0)]
        assert [r.doc_id for r in benchmark.without_leaks(docs).collect()] == [0]


def test_empty_tables_and_parts(spark, monkeypatch):
    empty = Benchmark(spark.createDataFrame([], "item_id long, text string"))
    _, docs = tables(spark, TEXTS)
    assert empty.leaks(docs).collect() == [] and empty.without_leaks(docs).count() == len(TEXTS)
    whole, _ = tables(spark, TEXTS)
    monkeypatch.setattr(decontamination, "PART_CHARACTERS", 60)
    parts, _ = tables(spark, TEXTS)
    assert len(parts.parts) > 1
    assert sorted(map(tuple, parts.leaks(docs).collect())) == sorted(map(tuple, whole.leaks(docs).collect()))
    assert parts.without_leaks(docs).count() == 4
    assert whole.leaks(docs.limit(0)).collect() == []


def test_query_finds_every_exact_passage(spark):
    from marquee.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    items = [(r.item_id, " ".join(words_of(r.text))) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    found = {(r.doc_id, r.item_id) for r in QUERIES["op8_decontamination"](spark, folder).collect()}
    held = set()
    for d in docs:
        words = f" {' '.join(words_of(d.text or ''))} "
        held |= {(d.doc_id, i) for i, t in items if f" {t} " in words}
    assert held and held <= found
