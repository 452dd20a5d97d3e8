import datetime

import pytest

from marquee.operators.contracts import ContractError
from marquee.serving import Serving
from marquee.session import HASH_JOINS
from marquee.sources import schemas
from marquee.sources.files import register_views
from marquee.sources.sinks import Store, _place, serving_factors, serving_movies, serving_ratings
from marquee.sources.synthetic import synthetic_factors


def movies(spark, rows):
    return serving_movies(spark.createDataFrame(rows, schemas.CLEAN_MOVIES))


def ratings(spark, rows):
    return serving_ratings(spark.createDataFrame(rows, schemas.CLEAN_RATINGS))


def factors(spark, n, id_column, seed=42):
    return serving_factors(synthetic_factors(spark, n, 4, seed), id_column)


MOVIES = [(1, "A (2000)", "X|Y"), (2, "B (2001)", None), (3, None, "Z")]
RATINGS = [(1, 1, 4.0, 964982703), (1, 2, 3.25, None), (2, 3, 0.5, 10)]


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "tables"))


def load(store, movie_rows=MOVIES, rating_rows=RATINGS, users=2, items=3, seed=42, **options):
    spark = store.spark
    return store.publish(
        movies(spark, movie_rows),
        ratings(spark, rating_rows),
        factors(spark, users, "user_id", seed),
        factors(spark, items, "movie_id", seed),
        dim=4,
        **options,
    )


def test_first_load(store):
    assert store.current() is None
    with pytest.raises(LookupError):
        store.read("movies")
    assert load(store) == store.current()
    tables = store.tables()
    for name, df in tables.items():
        assert df.schema.simpleString() == schemas.SERVING[name].simpleString()
    assert sorted(map(tuple, tables["movies"].collect())) == [(1, "A (2000)", "X|Y"), (2, "B (2001)", "Unknown"), (3, "Unknown", "Z")]
    rated = {(r["user_id"], r["movie_id"]): (float(r["rating"]), r["rated_at"]) for r in tables["ratings"].collect()}
    assert rated[1, 2] == (3.3, None)
    assert rated[1, 1][0] == 4.0
    epoch = tables["ratings"].selectExpr("user_id", "movie_id", "unix_seconds(rated_at) s").filter("s = 964982703")
    assert epoch.count() == 1
    register_views(tables)
    assert store.spark.sql("SELECT count(*) FROM ratings JOIN movies USING (movie_id)").first()[0] == 3


def test_merge(store):
    load(store)
    before = {r["user_id"]: r for r in store.read("user_factors").collect()}
    load(store, [(3, "C", "W"), (4, "D", "V")], [(1, 1, 5.0, 20), (2, 4, 1.0, 30)], users=3, items=1, seed=7)
    assert sorted(map(tuple, store.read("movies").collect())) == [
        (1, "A (2000)", "X|Y"),
        (2, "B (2001)", "Unknown"),
        (3, "C", "W"),
        (4, "D", "V"),
    ]
    rated = {(r["user_id"], r["movie_id"]): float(r["rating"]) for r in store.read("ratings").collect()}
    assert rated == {(1, 1): 5.0, (1, 2): 3.3, (2, 3): 0.5, (2, 4): 1.0}
    after = {r["user_id"]: r for r in store.read("user_factors").collect()}
    assert after[1]["features"] != before[1]["features"]
    assert after[1]["loaded_at"] == before[1]["loaded_at"] < after[3]["loaded_at"]
    assert store.read("movie_factors").count() == 3


def test_replace(store):
    load(store)
    load(store, [(9, "N", "M")], [(5, 9, 2.0, 1)], replace=True)
    assert [r["movie_id"] for r in store.read("movies").collect()] == [9]
    assert store.read("ratings").count() == 1


@pytest.mark.parametrize(
    "rows, reason",
    [
        (RATINGS + [(1, 1, 2.0, 5)], "repeated key"),
        (RATINGS + [(1, 3, 5.5, 5)], "out of range"),
        (RATINGS + [(1, 3, 99.5, 5)], "null rating"),
        (RATINGS + [(1, 77, 3.0, 5)], "orphan"),
    ],
)
def test_a_refused_load_is_never_seen(store, rows, reason):
    first = load(store)
    with pytest.raises(ContractError, match=reason):
        load(store, rating_rows=rows)
    assert store.current() == first
    assert store.read("ratings").count() == 3


def test_refused_rows_can_be_set_aside(store):
    load(store)
    version = load(store, rating_rows=RATINGS + [(3, 1, 5.5, 5), (3, 2, 0.4, 5), (3, 77, 3.0, 5), (3, 3, 1.0, 5)], strict=False)
    assert store.read("ratings").count() == 4
    refused = store.spark.read.parquet(store.path(version, "ratings_refused")).collect()
    assert sorted(r["broken_rule"] for r in refused) == ["orphan movie_id", "out of range rating", "out of range rating"]
    with pytest.raises(ContractError, match="repeated key"):
        load(store, rating_rows=RATINGS + RATINGS, strict=False)


def test_wrong_vectors_are_refused(store):
    spark = store.spark
    with pytest.raises(ContractError, match="vector length"):
        store.publish(movies(spark, MOVIES), ratings(spark, RATINGS), factors(spark, 2, "user_id"), factors(spark, 2, "movie_id"), dim=50)
    assert store.current() is None


def test_serving(store):
    load(store, users=3, items=3)
    serving = Serving(store.tables())
    assert serving.recommendations(1, 2).count() == 2
    assert serving.recommendations().groupBy("user_id").count().count() == 3
    assert serving.recommendations(99).count() == 0
    assert [r["movie_id"] for r in serving.user_history(1).collect()] == [1, 2]
    stats = serving.user_stats(1).first()
    assert (stats["ratings_count"], stats["avg_score"], stats["top_affinity"]) == (2, 3.7, "Unknown")
    assert tuple(serving.user_stats(99).first()) == (99, 0, None, None)
    assert serving.user_stats().count() == 2
    assert tuple(serving.rating_count(1).first()) == (1, 2, True)
    assert [(r["genre"], r["percentage"]) for r in serving.genre_distribution(1).collect()] == [("Unknown", 50), ("X", 50), ("Y", 50)]
    assert [r["movie_id"] for r in serving.trending_movies(2, 1).collect()] == [1, 2]
    assert [r["movie_id"] for r in serving.search_movies("a (", genre="x").collect()] == [1]
    assert [r["genre"] for r in serving.all_genres().collect()] == ["Unknown", "X", "Y", "Z"]
    assert serving.movie_details(3).first()["title"] == "Unknown"
    assert serving.movie_details(33).first() is None
    assert serving.user_rating_for_movie(1, 2).first()["rating"] == 3.3
    assert serving.user_rating_for_movie(1, 3).first() is None
    reasons = serving.explanation(1, 1).collect()
    assert [(r["title"], r["rating"], r["shared_genres"]) for r in reasons] == [("A (2000)", 4.0, ["X", "Y"])]
    assert tuple(serving.system_health().first()) == (3, 3, 3, "present")
    assert [tuple(r) for r in serving.all_users().collect()] == [(1, 2), (2, 1), (3, 0)]
    assert serving.cards(1).count() == 3
    assert [r["section"] for r in serving.cards(1).collect()] == ["shown"] * 3
    assert serving.history_pages(1).count() == 2
    assert serving.taste_shares(1).count() == 3
    assert serving.movie_cards("a (").count() == 1
    assert serving.user_picker().count() == 3
    assert serving.health_cards().first()["total_ratings"] == "3"
    assert isinstance(serving.user_history(1).first()["rated_at"], (datetime.datetime, type(None)))


def test_a_load_that_was_overtaken_is_refused(store, monkeypatch):
    first = load(store)
    other = Store(store.spark, store.root)
    write = store._write

    def slow(version, name, df):
        if name == "ratings":
            load(other)
        return write(version, name, df)

    monkeypatch.setattr(store, "_write", slow)
    with pytest.raises(ContractError, match="meanwhile"):
        load(store)
    assert store.current() not in (None, first)


def test_versions_that_were_never_published_are_removed(store):
    import os

    kept = load(store)
    with pytest.raises(ContractError):
        load(store, rating_rows=RATINGS + RATINGS)
    assert len(os.listdir(f"{store.root}/versions")) == 2
    removed = store.clean_up()
    assert len(removed) == 2 and f"{store.root}/versions/{kept}/incoming" in removed
    assert os.listdir(f"{store.root}/versions") == [kept]
    assert store.read("ratings").count() == 3 and store.clean_up() == []


def test_of_two_loads_from_one_state_exactly_one_wins(store):
    """Both loads have written everything before either is published."""
    load(store, MOVIES, RATINGS)
    other = Store(store.spark, store.root)
    claims = []

    def held(number, version):
        claims.append((number, version))
        return True

    for writer, rating in ((store, 1.0), (other, 2.0)):
        claim, writer._claim = writer._claim, held
        load(writer, rating_rows=[(1, 1, rating, 50)])
        writer._claim = claim
    (first, a), (second, b) = claims
    assert first == second == 2
    assert other._claim(second, b) and not store._claim(first, a)
    assert store.current() == other.current() == b
    assert {float(r["rating"]) for r in store.read("ratings").filter("user_id = 1 AND movie_id = 1").collect()} == {2.0}
    assert store.read("ratings").count() == 3


def test_a_state_without_its_content_is_not_published(store):
    first = load(store)
    path = store.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{store.root}/published/{2:012d}")
    path.getFileSystem(store.spark.sparkContext._jsc.hadoopConfiguration()).create(path, False).close()
    assert store.current() == first


def test_an_earlier_state_can_still_be_read(store):
    first = load(store, [(i, "T", "G") for i in range(50)], [(i, i, 4.0, i) for i in range(50)], users=50, items=50)
    load(store, [(7, "New", "G")], [(7, 7, 1.0, 7)], users=1, items=1)
    assert all(store.read(table).count() == 50 for table in schemas.SERVING)
    assert store.read("movies").filter("movie_id = 7").first()["title"] == "New"
    assert store.read("movies", first).filter("movie_id = 7").first()["title"] == "T"
    store.clean_up()
    assert store.read("ratings").count() == store.read("ratings", first).count() == 50


def test_a_publication_joins_large_inputs_without_sorting_them(store, with_conf, monkeypatch):
    with_conf(spark__sql__autoBroadcastJoinThreshold="-1")
    before = store.spark.conf.get(HASH_JOINS)
    plans = {}
    stage = store._stage

    def seen(version, table, df):
        df.collect()
        plans[table] = df._jdf.queryExecution().executedPlan().toString()
        return stage(version, table, df)

    monkeypatch.setattr(store, "_stage", seen)
    joined = ratings(store.spark, RATINGS).join(store.spark.range(9).selectExpr("CAST(id AS INT) AS user_id"), "user_id")
    parts = [factors(store.spark, n, f"{kind}_id") for kind, n in (("user", 2), ("movie", 3))]
    store.publish(movies(store.spark, MOVIES), joined, *parts, dim=4)
    assert "ShuffledHashJoin" in plans["incoming/ratings"].split("Initial Plan")[0]
    assert "SortMergeJoin" not in plans["incoming/ratings"].split("Initial Plan")[0]
    assert store.read("ratings").count() == 3 and store.spark.conf.get(HASH_JOINS) == before


def test_one_number_orders_like_the_key(spark):
    low, high = -(2**31), 2**31 - 1
    pairs = [(u, m) for u in (low, -1, 0, 1, high) for m in (low, -1, 0, 1, high)]
    df = spark.createDataFrame(pairs[::-1], "user_id int, movie_id int")
    assert dict(df.select(_place("ratings").alias("p")).dtypes) == {"p": "bigint"}
    assert [tuple(r) for r in df.orderBy(_place("ratings")).collect()] == pairs
    assert df.select(_place("ratings")).distinct().count() == len(pairs)
    assert [r["movie_id"] for r in df.select("movie_id").distinct().orderBy(_place("movies")).collect()] == [low, -1, 0, 1, high]
