import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.functions.vectors import cosine_distance, cosine_similarity, dot
from marquee.operators import item_index, topk
from marquee.operators.topk import top_k

SCHEMA = "{} int, features array<float>"


def vectors(spark, matrix, name, ids=None):
    ids = range(1, len(matrix) + 1) if ids is None else ids
    return spark.createDataFrame([(int(i), [float(x) for x in row]) for i, row in zip(ids, matrix)], SCHEMA.format(name))


def brute(users, items, k, metric, hidden=()):
    """Rank by rank: (user, rank) to (item, score), scores summed in plain Python order."""
    wanted = {}
    for u, a in enumerate(users, 1):
        scored = []
        for i, b in enumerate(items, 1):
            if (u, i) in hidden:
                continue
            score = float(sum(float(x) * float(y) for x, y in zip(a, b)))
            if metric == "cosine":
                length = float(np.sqrt(sum(float(x) ** 2 for x in a)) * np.sqrt(sum(float(x) ** 2 for x in b)))
                score = score / length if length else None
            scored.append((score is None, -(score or 0.0) if score is not None else 0.0, i, score))
        # Python floats of equal vectors are equal, so ties go by id here as well.
        for rank, (_, _, i, score) in enumerate(sorted(scored)[:k], 1):
            wanted[u, rank] = (i, score)
    return wanted


def assert_same(df, wanted):
    got = {(r["user_id"], r["rank"]): (r["movie_id"], r["score"]) for r in df.collect()}
    assert got.keys() == wanted.keys()
    for key, (item, score) in wanted.items():
        assert got[key][0] == item, key
        assert (got[key][1] is None) == (score is None)
        if score is not None:
            assert got[key][1] == pytest.approx(score, abs=1e-9)


@pytest.fixture(scope="module")
def matrices():
    rng = np.random.default_rng(5)
    users = rng.normal(size=(40, 12)).astype(np.float32)
    items = rng.normal(size=(90, 12)).astype(np.float32)
    items[30:60] = items[3]  # a third of the items are copies of one
    items[70] = 0
    users[11] = 0
    return users, items


@pytest.mark.parametrize("metric", ["cosine", "dot"])
@pytest.mark.parametrize("cells", [(8192, 32768), (7, 11), (1, 90), (40, 1)])
def test_equals_brute_force(spark, matrices, metric, cells):
    users, items = matrices
    best = top_k(
        vectors(spark, users, "user_id"), vectors(spark, items, "movie_id"), 10, metric, users_per_cell=cells[0], items_per_cell=cells[1]
    )
    assert_same(best, brute(users, items, 10, metric))


@pytest.mark.parametrize("cells", [(8192, 32768), (9, 13)])
def test_excluded_items_are_left_out_before_the_cut(spark, matrices, cells):
    users, items = matrices
    rng = np.random.default_rng(6)
    hidden = {(int(u), int(i)) for u in range(1, 41) for i in rng.choice(np.arange(1, 91), 30, replace=False)}
    hidden |= {(5, i) for i in range(1, 91)}  # nothing left for user 5
    hidden |= {(6, i) for i in range(1, 88)}  # three left for user 6
    pairs = spark.createDataFrame(sorted(hidden) + [(1, 9999), (777, 1)], "user_id int, movie_id int")
    best = top_k(
        vectors(spark, users, "user_id"),
        vectors(spark, items, "movie_id"),
        10,
        "dot",
        pairs,
        users_per_cell=cells[0],
        items_per_cell=cells[1],
    )
    assert_same(best, brute(users, items, 10, "dot", hidden))


def test_more_items_than_groups(spark):
    rng = np.random.default_rng(8)
    users = rng.normal(size=(6, 5)).astype(np.float32)
    items = np.round(rng.normal(size=(5000, 5)), 1).astype(np.float32)
    items[1000:3000] = items[999]
    best = top_k(vectors(spark, users, "user_id"), vectors(spark, items, "movie_id"), 10, "dot")
    assert_same(best, brute(users, items, 10, "dot"))


@pytest.mark.parametrize("metric", ["cosine", "dot"])
def test_crowds_of_copies(spark, metric):
    """A third of the users zero, two thirds of the items copies, and some copies hidden."""
    rng = np.random.default_rng(12)
    users, items = rng.normal(size=(30, 4)).astype(np.float32), rng.normal(size=(600, 4)).astype(np.float32)
    users[::3] = 0
    items[100:300] = 3 * items[5]
    items[300:500] = 0
    hidden = {(u, i) for u in (2, 4, 5) for i in range(90, 140)}
    pairs = spark.createDataFrame(sorted(hidden), "user_id int, movie_id int")
    best = top_k(vectors(spark, users, "user_id"), vectors(spark, items, "movie_id"), 12, metric, pairs)
    assert_same(best, brute(users, items, 12, metric, hidden))
    assert_same(top_k(vectors(spark, users, "user_id"), vectors(spark, items, "movie_id"), 12, metric), brute(users, items, 12, metric))


def test_copies_before():
    matrix = np.array([[1.0, 2.0], [3.0, 4.0], [1.0, 2.0], [1.0, 2.0], [3.0, 4.0], [5.0, 6.0]])
    assert topk._copies_before(matrix).tolist() == [0, 0, 1, 2, 1, 0]
    assert topk._copies_before(matrix[:2]).tolist() == [0, 0]


def test_magnitudes_far_apart(spark):
    rng = np.random.default_rng(9)
    items = (rng.normal(size=(300, 6)) * 10.0 ** rng.integers(-12, 12, size=(300, 1))).astype(np.float32)
    users = (rng.normal(size=(8, 6)) * 10.0 ** rng.integers(-12, 12, size=(8, 1))).astype(np.float32)
    for metric in ("dot", "cosine"):
        best = top_k(vectors(spark, users, "user_id"), vectors(spark, items, "movie_id"), 7, metric)
        got = {(r["user_id"], r["rank"]): r["movie_id"] for r in best.collect()}
        assert got == {key: item for key, (item, _) in brute(users, items, 7, metric).items()}


def test_partitions_and_order_do_not_matter(spark, matrices):
    users, items = (vectors(spark, m, n) for m, n in zip(matrices, ("user_id", "movie_id")))
    one = sorted(map(tuple, top_k(users, items, 10).collect()))
    shuffled = top_k(users.repartition(11), items.orderBy(F.rand(3)), 10, users_per_cell=6, items_per_cell=17)
    assert sorted(map(tuple, shuffled.collect())) == one


def test_few_items_long_ids_and_empty_inputs(spark, matrices):
    users, items = matrices
    few = top_k(vectors(spark, users, "user_id"), vectors(spark, items[:3], "movie_id"), 10)
    assert few.groupBy("user_id").count().filter("count <> 3").count() == 0
    long = vectors(spark, items, "movie_id").selectExpr("movie_id + 10000000000 as movie_id", "features")
    best = top_k(vectors(spark, users, "user_id"), long, 2)
    assert dict(best.dtypes)["movie_id"] == "bigint" and best.agg(F.min("movie_id")).first()[0] > 10000000000
    assert top_k(vectors(spark, users[:0], "user_id"), long, 2).count() == 0
    assert top_k(vectors(spark, users, "user_id"), long.limit(0), 2).count() == 0


def test_bad_arguments_and_ragged_vectors(spark, matrices):
    users, items = (vectors(spark, m, n) for m, n in zip(matrices, ("user_id", "movie_id")))
    with pytest.raises(ValueError):
        top_k(users, items, 0)
    with pytest.raises(ValueError):
        top_k(users, items, 1, "euclid")
    ragged = items.withColumn("features", F.expr("slice(features, 1, 3 + movie_id % 2)"))
    with pytest.raises(Exception, match="one length"):
        top_k(users, ragged, 1).collect()


def test_vector_functions(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0]), ([1.0, 2.0], [0.0, 0.0])], "a array<float>, b array<float>")
    a, b = F.col("a"), F.col("b")
    first, second = df.select(dot(a, b), cosine_similarity(a, b), cosine_distance(a, b)).collect()
    assert tuple(first) == pytest.approx((1.0, 2**-0.5, 1 - 2**-0.5))
    assert tuple(second) == (0.0, None, None)


def clustered(rng, count, centres):
    return (centres[rng.integers(0, len(centres), count)] + 0.08 * rng.normal(size=(count, centres.shape[1]))).astype(np.float32)


@pytest.mark.parametrize("metric", ["cosine", "dot"])
@pytest.mark.parametrize("structured", [True, False])
def test_many_pairs_go_through_an_index_where_its_bounds_skip_most(spark, monkeypatch, metric, structured):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(30, 16)) if structured else rng.normal(size=(3000, 16))
    spread = 0.02 if structured else 1.0
    users = vectors(spark, centres[rng.integers(0, len(centres), 150)] + spread * rng.normal(size=(150, 16)), "user_id")
    items = vectors(spark, centres[rng.integers(0, len(centres), 2000)] + spread * rng.normal(size=(2000, 16)), "movie_id")
    seen = top_k(users, items, 6, metric).where("(user_id + rank) % 2 = 0").select("user_id", "movie_id")
    wanted = [sorted(top_k(users, items, 10, metric, hidden).collect()) for hidden in (None, seen)]

    searched = []
    exact = item_index.ItemIndex.exact
    monkeypatch.setattr(item_index.ItemIndex, "exact", lambda *a, **b: searched.append(1) or exact(*a, **b))
    monkeypatch.setattr(topk, "PAIRS_FOR_INDEX", 1)
    assert [sorted(top_k(users, items, 10, metric, hidden).collect()) for hidden in (None, seen)] == wanted
    assert len(searched) == (2 if structured else 0)


@pytest.mark.parametrize("metric", ["cosine", "dot"])
def test_close_scores_are_told_apart_before_pairs_are_scored_one_by_one(monkeypatch, metric):
    turn = np.linspace(0, 0.02, 3000)
    items, asked = (np.stack([np.cos(t), np.sin(t), 0.1 * np.ones(len(t))], axis=1) for t in (turn, turn[::600] + 2e-6))
    items[100] = 0
    hidden = (np.repeat([0, 4], 20), np.tile(np.arange(1480, 1500), 2))
    users, items = topk._Side(asked, True), topk._Side(items, metric == "cosine")
    pairs = []
    scored = topk._pair_products
    monkeypatch.setattr(topk, "_pair_products", lambda u, i, row, col: pairs.append(len(row)) or scored(u, i, row, col))
    row, col, values, rank = topk._best_in_tile(users, items, slice(0, 5), 10, metric, hidden)
    assert sum(pairs) < 5 * 200

    products = np.einsum("uj,ij->ui", users.exact, items.exact)
    if metric == "cosine":
        products /= users.norms[:, None] * np.where(items.norms > 0, items.norms, np.nan)
    products = np.nan_to_num(products, nan=-2.0)
    products[hidden] = -np.inf
    best = [np.lexsort((np.arange(3000), -line))[:10].tolist() for line in products]
    assert [sorted(col[row == u].tolist()) for u in range(5)] == [sorted(b) for b in best]
