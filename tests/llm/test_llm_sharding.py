"""Best-fit-decreasing sharding."""

import zlib
from collections import defaultdict

import pytest

from marquee.llm import sharding
from marquee.llm.sharding import OpenBins, best_fit, best_fit_decreasing, pack_shards


def test_items_enter_the_tightest_bin():
    bins = OpenBins(2, 10)
    assert [bins.place(s) for s in (6, 7, 3, 4)] == [0, 1, 1, 0]
    assert bins.place(1) is None
    assert best_fit([6, 5, 5, 4], 2, 10) == [0, 1, 1, 0]
    assert best_fit([6, 6, 6], 2, 10) is None


def test_the_capacity_is_the_least_that_best_fit_needs():
    placed = best_fit_decreasing({c: s for c, s in zip("abcdefg", (9, 8, 5, 4, 3, 3, 2))}, 3)
    loads = defaultdict(int)
    for c, s in zip("abcdefg", (9, 8, 5, 4, 3, 3, 2)):
        loads[placed[c]] += s
    assert max(loads.values()) == 12
    assert best_fit_decreasing({}, 3) == {}


def check(rows, texts, shards):
    slots, homes = defaultdict(list), defaultdict(set)
    for r in rows:
        slots[r.shard].append(r.slot)
        homes[texts[r.doc_id]].add(r.shard)
        assert 0 <= r.shard < shards and r.law == "bytes" and r.grown_shard is None
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(data) + 8, zlib.crc32(data))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(h) == 1 for h in homes.values())


def test_groups_stay_whole_and_slots_have_no_gaps(spark):
    texts = {i: "x" * (i % 7 * 10) + str(i // 4) for i in range(300)} | {300: None, 301: None, 302: "", 303: "", 304: "é" * 2000}
    docs = spark.createDataFrame([(i, t, 1, "b", 2) for i, t in texts.items()], "doc_id long, text string, size int, shard string, parcel int")
    rows = pack_shards(docs, 5).collect()
    assert len(rows) == len(texts)
    check(rows, texts, 5)


@pytest.mark.parametrize("stretch", [100_000, 7])
def test_repeated_rows_and_rows_without_an_id(spark, monkeypatch, stretch):
    monkeypatch.setattr(sharding, "STRETCH", stretch)
    docs = spark.createDataFrame([(1, "same")] * 40 + [(None, "n")] * 3 + [(2, "two")], "doc_id long, text string")
    rows = pack_shards(docs, 3).collect()
    assert len(rows) == 44
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({r.shard for r in rows if r.doc_id == 1}) == 1


def test_an_empty_table(spark):
    assert pack_shards(spark.createDataFrame([], "doc_id long, text string"), 3).collect() == []


def test_query_shards_are_near_equal(spark):
    from marquee.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op10_sharding"](spark, folder).collect()
    assert len(rows) == len(texts)
    check(rows, texts, 24)
    loads, groups = defaultdict(int), defaultdict(int)
    for r in rows:
        loads[r.shard] += r["size"]
        groups[texts[r.doc_id]] += r["size"]
    fair = sum(loads.values()) / 24
    assert len(loads) == 24
    assert max(loads.values()) <= max(1.05 * fair, max(groups.values()))
