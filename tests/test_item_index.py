"""The stored index against the exact search."""

import numpy as np
import pytest

from marquee.operators.item_index import ItemIndex
from marquee.operators.topk import top_k
from test_topk import clustered, vectors


def rows(df):
    return sorted((r["user_id"], r["rank"], r["movie_id"], None if r["score"] is None else round(r["score"], 9)) for r in df.collect())


@pytest.fixture(scope="module")
def tables(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(30, 16))
    users = clustered(rng, 70, centres)
    items = clustered(rng, 900, centres) * rng.uniform(0.5, 2, size=(900, 1)).astype(np.float32)
    items[100:300] = items[5]  # a crowd of one vector
    items[7], users[3] = 0, 0
    return vectors(spark, users, "user_id"), vectors(spark, items, "movie_id")


@pytest.fixture(scope="module")
def index(tables, tmp_path_factory):
    return ItemIndex.build(tables[1], str(tmp_path_factory.mktemp("index") / "items"), items_per_cell=50)


@pytest.mark.parametrize("metric", ["cosine", "dot"])
@pytest.mark.parametrize("users_per_cell", [32768, 5])
def test_exact_search_gives_the_rows_of_the_full_one(tables, index, metric, users_per_cell):
    users, items = tables
    assert rows(index.exact(users, 10, metric, users_per_cell=users_per_cell)) == rows(top_k(users, items, 10, metric))


def test_more_wanted_than_there_are(spark, tables, index):
    users, items = (t.limit(9) for t in tables)
    assert rows(index.exact(users, 950)) == rows(top_k(users, tables[1], 950))


def test_exact_search_skips_cells_of_clustered_vectors(tables, index):
    users, items = tables
    directed = users.where("exists(features, x -> x != 0)")
    for metric, most in (("cosine", 0.35), ("dot", 0.6)):
        assert index.exact_pairs(directed, 10, metric) < most * directed.count() * items.count()


def test_search_finds_what_it_was_trained_for(spark, tables, index):
    users, items = tables
    exact = {r[:3:2]: r[3] for r in rows(top_k(users, items, 10)) if r[3] is not None}
    found = {r[:3:2]: r[3] for r in rows(index.search(users, 10))}
    assert len(found) == 10 * 69  # the user without a direction has no neighbours
    common = exact.keys() & found.keys()
    assert len(common) >= 0.9 * len(exact) and all(exact[c] == found[c] for c in common)
    assert index.asked_pairs(index.probes(users)) < 0.4 * 70 * 900


def test_the_share_falls_with_the_items_and_without_structure_stays_below_half(spark, tmp_path):
    rng = np.random.default_rng(8)
    shares = []
    for size in (500, 4000):
        centres = rng.standard_normal((size // 10, 16))
        built = ItemIndex.build(vectors(spark, clustered(rng, size, centres), "movie_id"), f"{tmp_path}/{size}")
        shares.append(built.cells.share)
    assert shares[1] < shares[0] < 0.2
    loose = ItemIndex.build(vectors(spark, rng.normal(size=(1500, 64)), "movie_id"), f"{tmp_path}/loose")
    assert 0.2 < loose.cells.share < 0.5


def test_a_user_travels_to_each_block_once(spark, tmp_path):
    """Cells that a user asks for share its journey: rows follow the blocks, not the cells."""
    rng = np.random.default_rng(9)
    items, users = (vectors(spark, rng.normal(size=(n, 16)).astype(np.float32), name) for n, name in ((1200, "movie_id"), (60, "user_id")))
    built = ItemIndex.build(items, f"{tmp_path}/loose", items_per_cell=500)
    probes = built.probes(users)
    assert len(built.cells.items) > 60 and probes.count() <= 60 * 8
    assert built.asked_pairs(probes) >= 60 * 1200 * built.cells.share
    assert rows(built.exact(users, 10, users_per_cell=7)) == rows(top_k(users, items, 10))


def test_read_again_and_sorted_by_cell(spark, tables, index):
    again = ItemIndex(spark, index.path)
    assert rows(again.search(tables[0], 3)) == rows(index.search(tables[0], 3))
    assert sum(again.cells.items) + again.cells.nowhere == 900 and again.items.count() == 900
    per_file = again.items.selectExpr("input_file_name() AS f", "_cell").groupBy("f").agg({"_cell": "min"}).count()
    assert per_file >= 1


def test_few_and_no_items(spark, tables, tmp_path):
    users, items = tables
    none = ItemIndex.build(items.limit(0), f"{tmp_path}/none")
    assert none.search(users, 5).collect() == [] and none.exact(users, 5).collect() == []
    zero = ItemIndex.build(items.where("movie_id = 8"), f"{tmp_path}/zero")
    assert zero.search(users, 5).collect() == []
    assert rows(zero.exact(users, 5)) == rows(top_k(users, items.where("movie_id = 8"), 5))
    three = items.where("movie_id < 4")
    assert rows(ItemIndex.build(three, f"{tmp_path}/three").exact(users, 5, "dot")) == rows(top_k(users, three, 5, "dot"))
    with pytest.raises(ValueError):
        zero.search(users, 0)


@pytest.mark.parametrize("metric", ["cosine", "dot"])
@pytest.mark.parametrize("users_per_cell", [32768, 5])
def test_exact_search_leaves_out_what_is_excluded(spark, tables, index, metric, users_per_cell):
    users, items = tables
    # What is best for each user, all of a crowd for one, and items there are not.
    best = top_k(users, items, 14, metric).where("(user_id + rank) % 3 > 0").select("user_id", "movie_id")
    others = spark.createDataFrame([(6, m) for m in range(1, 400)] + [(9, 5000), (999, 1)], "user_id int, movie_id int")
    hidden = best.unionByName(others)
    found = index.exact(users, 10, metric, users_per_cell=users_per_cell, exclude=hidden)
    assert rows(found) == rows(top_k(users, items, 10, metric, hidden))
