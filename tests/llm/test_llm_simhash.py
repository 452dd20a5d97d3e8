"""Covering SimHash against a brute force over all pairs."""

import random

import numpy as np
import pytest
import xxhash

from marquee.llm import simhash
from marquee.llm.components import components


def plain_fingerprint(text, words=3):
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    shingles = [b" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def plain_classes(prints):
    """Smallest position reachable over links, for each of the fingerprints."""
    prints = np.array(prints, np.uint64)
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(prints[i + 1 :] ^ prints[i]) <= 3):
            a, b = find(i), find(i + 1 + int(j))
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("radius, copies", [(1, 1), (2, 1), (3, 1), (4, 1), (3, 2)])
def test_every_choice_of_positions_is_left_out_of_some_mask(radius, copies):
    masks = simhash.covering_masks(radius, copies)
    draw = random.Random(radius)
    for _ in range(2000):
        places = sum(1 << p for p in draw.sample(range(64), radius))
        assert any(not mask & places for mask in masks)


def test_fingerprints_of_odd_texts(monkeypatch):
    draw = random.Random(2)
    long = " ".join(draw.choice("the of and Ünd   ciónez".split()) for _ in range(3000))
    texts = ["", None, "  \t\n", "One", "one TWO", "one two three", "É é  x y z", "a " * 500, long]
    assert [simhash.fingerprint_of(t, 3) & (1 << 64) - 1 for t in texts] == [plain_fingerprint(t) for t in texts]
    monkeypatch.setattr(simhash, "STRETCH", 50)  # many stretches must not change a thing
    assert [simhash.fingerprint_of(t, 3) & (1 << 64) - 1 for t in texts] == [plain_fingerprint(t) for t in texts]


@pytest.mark.parametrize("crowd", [1000, 4])
def test_crowds_of_near_fingerprints(spark, crowd):
    draw = random.Random(1)
    prints = [draw.getrandbits(64)]
    for _ in range(400):
        near = draw.choice(prints)
        for p in draw.sample(range(64), draw.choice([1, 2, 3, 4, 5])):
            near ^= 1 << p
        prints.append(near)
    prints = sorted({p - (1 << 64) if p >> 63 else p for p in prints + [draw.getrandbits(64) for _ in range(50)]})
    links = simhash.links(spark.createDataFrame([(p,) for p in prints], "fp long"), 3, 1, crowd)
    roots = {r.node: r.root for r in components(links).collect()}
    want = plain_classes([p % (1 << 64) for p in prints])
    assert [roots.get(p, p) for p in prints] == [prints[w] for w in want]


def test_components_of_chains_loops_and_repeats(spark):
    links = [(i, i + 1) for i in range(200)] + [(5, 5), (300, 299), (299, 300), (300, 299)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert found == {**{i: 0 for i in range(1, 201)}, 300: 299}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def documents(spark, rows):
    kind = "doc_id long, text string, fingerprint string, component_id long, fp int, root map<string,int>"
    return spark.createDataFrame([(i, t, "x", 1, 2, {"a": 1}) for i, t in rows], kind)


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(5, "a b c d"), (3, "A  b\tC d"), (5, "a b c d"), (7, None), (2, ""), (9, " "), (None, "a b c d"), (4, "else"), (None, "z")]
    found = [tuple(r) for r in simhash.near_duplicate_classes(documents(spark, rows)).collect()]
    print_of = {t: f"{plain_fingerprint(t):016x}" for _, t in rows}
    least = {print_of["a b c d"]: 3, "0" * 16: 2, print_of["else"]: 4, print_of["z"]: None}
    assert sorted(found, key=str) == sorted(((i, print_of[t], least[print_of[t]]) for i, t in rows), key=str)
    kept = simhash.keep_one_per_class(documents(spark, [*rows, (3, "a b c d")]))
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [2, 3, 4, None, None]
    assert kept.columns == ["doc_id", "text", "fingerprint", "component_id", "fp", "root"]


def test_repeated_ids_with_different_texts(spark):
    one, two, three = "a b c d e f", "g h i j k l", "m n o p q r"
    # 5 names the classes of two texts; 7 names one and has a copy of what 5 names; 8 has copies only.
    rows = [(5, one), (5, two), (5, two), (7, three), (7, one), (8, two), (8, three)]
    kept = simhash.keep_one_per_class(documents(spark, rows)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(5, one), (5, two), (7, three)]


def test_an_empty_table(spark):
    assert simhash.near_duplicate_classes(documents(spark, [])).collect() == []
    assert simhash.keep_one_per_class(documents(spark, [])).collect() == []


def test_query_against_brute_force(spark):
    from marquee.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect())
    prints = [plain_fingerprint(t) for _, t in docs]
    classes = plain_classes(prints)
    want = [(d, f"{p:016x}", docs[c][0]) for (d, _), p, c in zip(docs, prints, classes)]
    assert sorted(tuple(r) for r in QUERIES["op3_simhash"](spark, folder).collect()) == want
