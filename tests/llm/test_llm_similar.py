"""Near copies against brute force over all pairs."""

import random

import numpy as np
import pytest

from marquee.llm import similar_texts
from marquee.llm.similar_texts import Crowd, keys_of, minima_of, shingles_of, sketch_of, without_near_copies


def plain_shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_kept(rows):
    """The least id of each group that near copies form."""
    sets = [(i, plain_shingles(text)) for i, text in sorted(rows)]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (_, own) in enumerate(sets):
        for m, (_, other) in enumerate(sets[:n]):
            if own and 5 * len(own & other) >= 4 * len(own | other):
                a, b = sorted((find(m), find(n)))
                root[b] = a
    return [i for n, (i, own) in enumerate(sets) if not own or find(n) == n]


def kept(spark, rows):
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, node int, key string")
    out = without_near_copies(docs)
    assert out.columns == docs.columns
    return sorted((r.doc_id for r in out.collect()), key=str)


def altered(draw, words, edits):
    words = list(words)
    for at in draw.sample(range(len(words)), edits):
        words[at] = f"new{draw.randrange(10**6)}"
    return words


@pytest.mark.parametrize("crowd, block, crowded", [(32, 2048, 100), (8, 2048, 40), (8, 20, 120)])
def test_edited_words_are_found_and_others_stay(spark, monkeypatch, crowd, block, crowded):
    monkeypatch.setattr(similar_texts, "CROWD", crowd)
    monkeypatch.setattr(similar_texts, "BLOCK", block)
    draw = random.Random(1)
    rows = []
    for _ in range(25):
        words = [f"w{draw.randrange(3000)}" for _ in range(draw.randint(5, 300))]
        rows.append(words)
        rows += [altered(draw, words, draw.randint(0, max(1, len(words) // 25))) for _ in range(4)]
    # A crowd of near copies, some of them near each other and not near the first one.
    words = [f"c{n}" for n in range(150)]
    rows += [altered(draw, words, draw.randint(1, 5)) for _ in range(crowded)]
    rows = [" ".join(x) for x in rows]
    draw.shuffle(rows)
    rows = list(enumerate(rows))
    want = plain_kept(rows)
    assert len(want) < len(rows) - 30
    assert kept(spark, rows) == sorted(want, key=str)


def test_pairs_at_the_bound_share_a_key():
    draw = random.Random(2)
    for _ in range(1500):
        size = draw.choice([9, 45, 90])
        common, rest = size * 8 // 9, size - size * 8 // 9
        a, b = ([f"{n} a b c d" for n in range(common)] + [f"{k}{n} a b c d" for n in range(rest)] for k in "xy")
        x, y = ({int(s) for t in texts for s in shingles_of(t)} for texts in (a, b))
        first, second = (keys_of(minima_of(np.array(sorted(s), np.uint64))) for s in (x, y))
        assert set(first.tolist()) & set(second.tolist())
        assert 5 * len(x & y) == 4 * len(x | y)


def test_odd_rows(spark):
    text = " ".join(f"w{n}" for n in range(60))
    near = text + " end"
    rows = [(1, ""), (2, None), (3, " "), (4, text), (5, near), (None, near), (None, text), (6, "a b"), (7, "A  b"), (8, "b a"), (9, "x " * 9000), (9, "else"), (10, "b a")]
    assert kept(spark, rows) == sorted([1, 2, 3, 4, None, None, 6, 8, 9, 9], key=str)
    assert kept(spark, []) == []
    assert kept(spark, [(1, "alone")]) == [1]


def test_a_crowd_that_only_looks_alike_names_no_pairs():
    draw = random.Random(4)
    common = [f"c{n} a b c d" for n in range(300)]
    rows = []
    for i in range(400):  # three quarters in common: a similarity of 0.6
        rows.append({int(s) for t in common + [f"own{i}x{n} a b c d" for n in range(100)] for s in shingles_of(t)})
    sets = [np.array(sorted(r), np.uint64) for r in rows]
    sets += sets[:20]
    sketches = np.frombuffer(b"".join(sketch_of(minima_of(x)) for x in sets), np.uint8).reshape(420, -1)
    crowd = Crowd(list(range(420)), sketches, sets)
    assert crowd.links(range(420), lambda text: text) == [(i, 400 + i) for i in range(20)]


def test_jobs_do_not_follow_the_crowd(spark):
    """Pages of one site, at a similarity of 0.6: as many jobs for 1,500 as for 150, and all pages stay."""
    draw = random.Random(5)
    frame = " ".join(f"c{n}" for n in range(160))
    own = lambda: " ".join(f"o{draw.randrange(10**9)}" for _ in range(40))
    counts = []
    for pages in (150, 1500):
        group = f"crowd of {pages}"
        spark.sparkContext.setJobGroup(group, group)
        rows = [(i, f"{frame} {own()}") for i in range(pages)]
        assert len(kept(spark, rows)) == pages
        counts.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert counts[1] <= counts[0] + 15
