import pytest
from pyspark.sql import functions as F

from marquee.functions import display, exact, genres
from marquee.functions.vectors import vector_text
from marquee.plans import catalog, pages, profiles, recommend, reports
from marquee.session import use_checkpoints


def one(spark, column, *values, kind="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [r[0] for r in df.select(column(F.col("x"))).collect()]


def test_title_and_year(spark):
    titles = ["Toy Story (1995)", "No Year", None, "", "Two (x) (2001)", "Bad (20011)", "(1999)", "A  (1980)"]
    assert one(spark, display.title_part, *titles) == [
        "Toy Story", "No Year", "Untitled", "Untitled", "Two (x)", "Bad (20011)", "(1999)", "A ",
    ]
    assert one(spark, display.year_part, *titles) == ["1995", "", "", "", "2001", "", "", "1980"]


def test_genre_texts(spark):
    lists = ["A|B|C|D", "(no genres listed)", None, "", "A||B", "|"]
    assert one(spark, lambda c: display.genre_text(c, 3), *lists) == [
        "A, B, C", "Genres unavailable", "Genres unavailable", "Genres unavailable", "A, B", "Genres unavailable",
    ]
    assert one(spark, genres.genre_list, "A|B", "", None) == [["A", "B"], [], None]


def test_numbers(spark):
    assert one(spark, display.match_percent, 0.125, 0.135, 1.7, -0.2, None, 0.005, kind="double") == [12, 14, 100, 0, 0, 0]
    assert one(spark, display.bar_percent, "12.9", "130", "-5", "x", None) == [12, 100, 0, 0, 0]
    assert one(spark, display.to_number, "1.5", "x", None) == [1.5, 0.0, 0.0]
    assert one(spark, display.grouped_number, "1234567", "12", None, "x") == ["1,234,567", "12", "0", "0"]
    assert one(spark, display.one_decimal, 3.25, 4.0, None, kind="double")[1:] == ["4.0", "0.0"]


def test_meta_text(spark):
    df = spark.createDataFrame([("A (1999)", "X|Y|Z"), ("B", None)], "t string, g string")
    assert [r[0] for r in df.select(display.meta_text(F.col("t"), F.col("g"), 2)).collect()] == ["1999 • X, Y", "Genres unavailable"]


def test_exact_rounding(spark):
    def average(*ratings):
        df = spark.createDataFrame([(r,) for r in ratings], "r double").select(exact.tenths(F.col("r")).alias("t"))
        return df.agg(exact.average_from_tenths(F.sum("t"), F.count("t"))).first()[0]

    assert average(3.0, 3.5) == 3.3
    assert average(0.5, 0.5, 1.0) == 0.7
    wide = spark.range(500_001).select(F.when(F.col("id") < 250_001, 30).otherwise(35).alias("t"))
    assert wide.agg(exact.average_from_tenths(F.sum("t"), F.count("t"))).first()[0] == 3.2
    parts = spark.createDataFrame([(29, 200), (1, 3), (0, 0), (5, 5)], "a int, b int")
    assert [r[0] for r in parts.select(exact.whole_percent(F.col("a"), F.col("b"))).collect()] == [15, 33, None, 100]


def test_vector_text(spark):
    df = spark.createDataFrame([([1.0, -0.5],)], "v array<float>")
    assert df.select(vector_text(F.col("v"), 2)).first()[0] == "[1.0,-0.5]"
    for bad in ([1.0], None, [1.0, None]):
        with pytest.raises(Exception, match="expected a vector of 2 numbers"):
            spark.createDataFrame([(bad,)], "v array<float>").select(vector_text(F.col("v"), 2)).collect()


@pytest.fixture(scope="module")
def small(spark):
    movies = spark.createDataFrame(
        [(1, "A (2000)", "X|Y"), (2, "B (2001)", None), (3, "C", "Y|Z|Z"), (4, "D", "")], "movie_id int, title string, genres string"
    )
    ratings = spark.createDataFrame(
        [(1, 1, 4.0, 5), (1, 2, 5.0, None), (1, 3, 4.0, 9), (1, 4, 4.0, 9), (2, 99, 3.0, 1), (2, 3, 1.0, 1)],
        "user_id int, movie_id int, rating double, rated_at int",
    )
    return movies, ratings


def test_history_and_pages(small):
    movies, ratings = small
    history = profiles.history(ratings, movies, 3)
    assert [(r["user_id"], r["movie_id"]) for r in history.orderBy("user_id", "position").collect()] == [(1, 3), (1, 4), (1, 1), (2, 3)]
    paged = pages.history_pages(profiles.history(ratings, movies), 3).orderBy("user_id", "position").collect()
    assert [(r["page"], r["pages"]) for r in paged] == [(1, 2), (1, 2), (1, 2), (2, 2), (1, 1)]
    assert paged[2]["title"] == "A" and paged[2]["meta"] == "2000 • X, Y" and paged[2]["rating_text"] == "4.0"


def test_stats_and_distribution(spark, small):
    movies, ratings = small
    asked = spark.createDataFrame([(1,), (2,), (3,)], "user_id int")
    stats = {r["user_id"]: tuple(r)[1:] for r in profiles.stats(ratings, movies, asked).collect()}
    # The orphan rating of user 2 does not count; a genre that stands twice in a list counts twice.
    assert stats == {1: (4, 4.3, "Y"), 2: (1, 1.0, "Z"), 3: (0, None, None)}
    shares = profiles.genre_distribution(ratings, movies).orderBy("user_id", "rank").collect()
    assert [(r["user_id"], r["genre"], r["percentage"]) for r in shares] == [
        (1, "Y", 50), (1, "Z", 50), (1, "X", 25), (2, "Z", 200), (2, "Y", 100),
    ]
    top = profiles.genre_distribution(ratings, movies, 1).collect()
    assert sorted(r["genre"] for r in top) == ["Y", "Z"]
    slices = pages.taste_shares(profiles.genre_distribution(ratings, movies)).orderBy("user_id", "rank").collect()
    assert [(r["percent"], r["start_degree"], r["end_degree"]) for r in slices] == [
        (50, 0.0, 144.0), (50, 144.0, 288.0), (25, 288.0, 360.0), (100, 0.0, 240.0), (100, 240.0, 360.0),
    ]


def test_counts_users_and_pairs(spark, small):
    _, ratings = small
    counts = {r["user_id"]: (r["rating_count"], r["cold_start"]) for r in profiles.rating_counts(ratings).collect()}
    assert counts == {1: (4, True), 2: (2, True)}
    users = spark.createDataFrame([(2,), (7,), (1,)], "user_id int")
    assert [tuple(r) for r in profiles.all_users(users, ratings).collect()] == [(1, 4), (2, 2), (7, 0)]
    assert [tuple(r) for r in profiles.all_users(users, ratings, 2).collect()] == [(1, 4), (2, 2)]
    assert profiles.all_users(users, ratings, None).count() == 3
    assert pages.user_picker(profiles.all_users(users, ratings)).first()["label"] == "User 1  ·  4 ratings"
    pairs = spark.createDataFrame([(1, 1), (1, 50)], "user_id int, movie_id int")
    assert sorted(map(tuple, profiles.ratings_for_pairs(pairs, ratings).collect())) == [(1, 1, 4.0), (1, 50, None)]


def test_catalogue(spark, small):
    movies, ratings = small
    assert [r["genre"] for r in catalog.all_genres(movies).collect()] == ["X", "Y", "Z"]
    assert [r["movie_id"] for r in catalog.search(movies, "b").collect()] == [2]
    assert [r["movie_id"] for r in catalog.search(movies, "_ (200%").collect()] == [1, 2]
    assert [r["movie_id"] for r in catalog.search(movies, "", 2).collect()] == [1, 2]
    assert [r["movie_id"] for r in catalog.search(movies, genre="y").collect()] == [1, 3]
    found = catalog.trending(ratings, movies, 10, 1).collect()
    assert [(r["movie_id"], r["avg_rating"], r["rating_count"]) for r in found] == [(2, 5.0, 1), (1, 4.0, 1), (4, 4.0, 1), (3, 2.5, 2)]
    assert catalog.trending(ratings, movies).count() == 0
    assert catalog.movie_details(movies).count() == 4
    cards = pages.movie_cards(movies).filter("movie_id = 1").first()
    assert tuple(cards) == (1, "A", "2000", "2000 • X, Y")


def test_trending_sorts_by_the_rounded_average(spark):
    movies = spark.createDataFrame([(1, "a", "X"), (2, "b", "X")], "movie_id int, title string, genres string")
    rows = [(u, 1, 4.0) for u in range(24)] + [(u, 1, 4.5) for u in range(24, 25)] + [(u, 2, 4.0) for u in range(30)]
    ratings = spark.createDataFrame(rows, "user_id int, movie_id int, rating double")
    assert [r["movie_id"] for r in catalog.trending(ratings, movies, 10, 1).collect()] == [2, 1]


def test_explanations(spark, small):
    movies, ratings = small
    pairs = spark.createDataFrame([(1, 1), (1, 99), (2, 1), (5, 1)], "user_id int, movie_id int")
    rows = recommend.explanations(pairs, ratings, movies, 3).orderBy("target_id", "position").collect()
    assert [(r["user_id"], r["target_id"], r["movie_id"], r["shared_genres"]) for r in rows] == [
        (1, 1, 2, []), (1, 1, 3, ["Y"]), (1, 1, 4, []), (1, 99, 2, []), (1, 99, 3, []), (1, 99, 4, []),
    ]
    sharing = recommend.explanations(pairs, ratings, movies, 3, require_shared=True).orderBy("position").collect()
    assert [(r["target_id"], r["movie_id"], r["shared_genres"]) for r in sharing] == [(1, 3, ["Y"]), (1, 1, ["X", "Y"])]


def test_recommendations_lose_items_without_a_movie_after_the_cut(spark, small):
    movies, ratings = small
    users = spark.createDataFrame([(1, [1.0, 0.0])], "user_id int, features array<float>")
    items = spark.createDataFrame([(1, [1.0, 0.1]), (50, [1.0, 0.0]), (3, [0.0, 1.0])], "movie_id int, features array<float>")
    best = recommend.recommendations(users, items, movies, 2).collect()
    assert [(r["rank"], r["movie_id"]) for r in best] == [(2, 1)]
    unseen = recommend.recommendations(users, items, movies, 3, exclude=ratings).collect()
    assert unseen == []
    cards = pages.recommendation_cards(recommend.recommendations(users, items, movies, 3)).orderBy("rank").collect()
    assert [(r["title"], r["year"], r["match_percent"], r["section"]) for r in cards] == [("A", "2000", 100, "shown"), ("C", "", 0, "shown")]


def test_health(spark, small):
    _, ratings = small
    users = spark.createDataFrame([(1,)], "user_id int")
    none = spark.createDataFrame([], "movie_id int")
    assert tuple(reports.health(users, none, ratings).first()) == (1, 0, 6, "missing")
    many = spark.range(12345)
    assert tuple(pages.health_cards(reports.health(many, users, ratings)).first()) == ("12,345", "1", "6", "present")


def test_checkpoints_follow_the_session(spark):
    use_checkpoints(spark)
    first = spark.sparkContext.getCheckpointDir()
    use_checkpoints(spark)
    assert first and spark.sparkContext.getCheckpointDir() == first
