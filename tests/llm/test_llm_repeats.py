"""Merged transforms and the removal of repeats against plain versions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.llm import repeated_spans
from marquee.llm.bwt import Transform, merged_intervals
from marquee.llm.queries import QUERIES
from marquee.llm.repeated_spans import without_repeats

DATA = "/root/testdata/sf0.001"


def plain(rows, span):
    """(id, bytes, removed, spans, kept) of each row, by a table of all windows."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1] is not None, rows[i][1] or "", i))
    seen, out = set(), []
    for i in order:
        name, text = rows[i]
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for s in range(len(data) - span + 1):
            window = data[s : s + span]
            if window in seen:
                gone[s : s + span] = True
            seen.add(window)
        edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(int)) == 1)
        out.append((name, len(data), int(gone.sum()), len(edges), bytes(np.frombuffer(data, np.uint8)[~gone])))
    return sorted(out, key=repr)


def found(spark, rows, **options):
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, ord int, marks string")
    return sorted(((r[0], r[1], r[2], r[3], bytes(r[4])) for r in without_repeats(frame, **options).collect()), key=repr)


def test_merged_intervals_are_the_shared_prefixes():
    draw = random.Random(3)
    for _ in range(150):
        strings = [bytes(draw.choices(b"ab\x00", k=draw.randint(0, 25))) for _ in range(draw.randint(1, 12))]
        cuts = sorted({0, len(strings), *(draw.randrange(len(strings)) for _ in range(3))})
        groups = [strings[a:b] for a, b in zip(cuts, cuts[1:])]
        shards = [Transform(g) for g in groups]
        depth = draw.randint(1, 9)
        rows, begins = merged_intervals(shards, depth)
        places = [s.places() for s in shards]
        name = np.concatenate([p + a for (p, _), a in zip(places, cuts)])
        left = np.concatenate([n for _, n in places])
        got = [
            sorted((int(name[r]), len(strings[name[r]]) - int(left[r])) for r in part)
            for part in np.split(rows, begins[1:])
            if len(part)
        ]
        wanted = {}
        for i, text in enumerate(strings):
            for s in range(len(text) - depth + 1):
                wanted.setdefault(text[s : s + depth], []).append((i, s))
        assert sorted(got) == sorted(sorted(v) for v in wanted.values() if len(v) > 1)


def texts(draw, n, pool):
    return [" ".join(draw.choices(pool, k=draw.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("options", [{}, {"crowd": 1}, {"cell_bytes": 500, "shard_bytes": 200}])
def test_same_as_all_windows(spark, options):
    draw = random.Random(5)
    pool = ["".join(draw.choices("abé€", k=draw.randint(1, 9))) for _ in range(12)]
    line = "the same line in many places of many documents "
    rows = [(i, t) for i, t in enumerate(texts(draw, 60, pool))]
    rows += [(100 + i, f"{i} {draw.random()} {line}{draw.random()} {i}") for i in range(40)]
    rows += [(200 + i, rows[i % 5][1]) for i in range(20)]
    rows += [(300, "ab" * 700), (301, "a" * 1500), (302, "ab" * 700 + "c"), (303, ""), (304, None), (-5, line * 3)]
    assert found(spark, rows, span=30, **options) == plain(rows, 30)


def test_odd_ids_and_tables(spark):
    text = "one two three four five six seven eight nine ten eleven"
    rows = [(None, text), (3, text), (3, text), (3, "x" + text), (2, None), (None, None), (1, "short"), (9, text[:40])]
    assert found(spark, rows, span=30) == plain(rows, 30)
    assert found(spark, []) == []
    assert found(spark, [(1, None)]) == [(1, 0, 0, 0, b"")]
    named = spark.createDataFrame([("b", text), ("a", text)], "doc_id string, text string")
    assert sorted((r[0], r[2]) for r in without_repeats(named, span=30).collect()) == [("a", 0), ("b", len(text))]
    with pytest.raises(ValueError):
        without_repeats(named, span=5)


def test_texts_longer_than_a_stretch(spark, monkeypatch):
    draw = random.Random(7)
    long = "".join(draw.choices("abcdefgh", k=40_000))
    rows = [(1, long), (2, long[5000:25_000]), (3, "é" + long[30_000:] + long[:50])]
    assert found(spark, rows) == plain(rows, 100)
    data = np.frombuffer(long.encode(), np.uint8)
    whole = repeated_spans._pieces(data, np.array([0, 7000, len(data)]), 100)
    monkeypatch.setattr(repeated_spans, "STRETCH", 1 << 10)
    parts = repeated_spans._pieces(data, np.array([0, 7000, len(data)]), 100)
    cover = lambda p: sorted((s, int(a)) for x, y, a in zip(*p) for s in range(x, y))
    assert cover(whole) == cover(parts) and len(whole[0]) < len(parts[0])


def test_query_on_the_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    import hashlib

    wanted = sorted((n, b, r, s, hashlib.sha256(k).hexdigest()) for n, b, r, s, k in plain(rows, 100))
    assert sorted(tuple(r) for r in QUERIES["op12_repeats"](spark, DATA).collect()) == wanted
    assert any(w[2] for w in wanted)
