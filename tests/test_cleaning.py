import pytest
from pyspark.sql import functions as F

from marquee.operators.cleaning import (
    clean_movies,
    clean_ratings,
    cleaning_counts,
    min_support,
    movie_rejection,
    null_counts,
    rating_rejection,
)
from marquee.plans.cleaning_run import run_cleaning
from marquee.sources import schemas
from marquee.sources.files import read_raw

# One row per rule of the cleaning; what each shows stands in its title or beside it.
MOVIES = [
    ("71", "Plain", "Noir|Western"),
    (" 72", "Blank in front", "Noir"),
    ("73 ", None, "Western"),
    ("0074", "Leading zeros", None),
    ("75", "", ""),
    (None, "No id", "Noir"),
    ("", "Empty id", "Noir"),
    ("7x", "Letter in the id", "Noir"),
    ("7.0", "Fraction in the id", "Noir"),
    ("-7", "Sign in the id", "Noir"),
]
RATINGS = [
    ("901", "71", "2.5", "86400"),
    ("902", "71", "5", None),  # a whole number, and no time
    (" 903 ", " 72 ", " 0.5 ", " 86401 "),  # blanks around everything
    ("904", "72", "3.75", "yesterday"),  # an unusable time keeps its row
    (None, "71", "2.5", "86400"),
    ("901", None, "2.5", "86400"),
    ("901", "71", None, "86400"),
    ("user", "71", "2.5", "86400"),
    ("90.1", "71", "2.5", "86400"),
    ("901", "film", "2.5", "86400"),
    ("901", " 7.1 ", "2.5", "86400"),
    ("901", "", "2.5", "86400"),
    ("901", "71", "good", "86400"),
    ("901", "71", "2,5", "86400"),
    ("901", "71", "2.5.", "86400"),
    ("901", "71", "5 stars", "86400"),
]


def raw_movies(spark, rows):
    return spark.createDataFrame(rows, schemas.RAW_MOVIES)


def raw_ratings(spark, rows):
    return spark.createDataFrame(rows, schemas.RAW_RATINGS)


def test_movies(spark):
    clean = clean_movies(raw_movies(spark, MOVIES))
    assert clean.schema.simpleString() == schemas.CLEAN_MOVIES.simpleString()
    assert sorted(map(tuple, clean.collect())) == [
        (71, "Plain", "Noir|Western"),
        (72, "Blank in front", "Noir"),
        (73, "Unknown", "Western"),
        (74, "Leading zeros", "Unknown"),
        (75, "", ""),
    ]


def test_ratings(spark):
    clean = clean_ratings(raw_ratings(spark, RATINGS))
    assert clean.schema.simpleString() == schemas.CLEAN_RATINGS.simpleString()
    assert sorted(map(tuple, clean.collect())) == [
        (901, 71, 2.5, 86400),
        (902, 71, 5.0, None),
        (903, 72, 0.5, 86401),
        (904, 72, 3.75, None),
    ]


def test_numbers_too_large_drop_the_row_and_a_bad_time_does_not(spark):
    rows = [
        ("99999999999", "1", "1", "1"),
        ("1", "99999999999", "1", "1"),
        ("2", "2", "1.0", "not a time"),
        ("3", "3", "1.0", "99999999999999999999"),
    ]
    clean = clean_ratings(raw_ratings(spark, rows)).collect()
    assert sorted(map(tuple, clean)) == [(2, 2, 1.0, None), (3, 3, 1.0, None)]
    assert clean_movies(raw_movies(spark, [("2147483648", "t", "g")])).count() == 0


def test_only_spaces_are_trimmed_and_signs_and_exponents_refused(spark):
    rows = [("\t7", "1", "1", "1"), ("1", "1", "-1", "1"), ("1", "1", "+1", "1"), ("1", "1", "1e1", "1"), ("1", "1", ".5", "1")]
    assert clean_ratings(raw_ratings(spark, rows)).count() == 0
    # No range check while cleaning: the contract of the serving table does that.
    assert clean_ratings(raw_ratings(spark, [("1", "1", "99.5", "1")])).first()["rating"] == 99.5


def test_cleaning_keeps_duplicates(spark):
    assert clean_ratings(raw_ratings(spark, [("1", "1", "3", "1")] * 3)).count() == 3


def test_counts(spark):
    counts = cleaning_counts(raw_ratings(spark, RATINGS), rating_rejection(), "ratings").collect()
    assert {r["outcome"]: r["rows"] for r in counts} == {
        "kept": 4,
        "null": 3,
        "malformed userId": 2,
        "malformed movieId": 3,
        "malformed rating": 4,
    }
    movies = cleaning_counts(raw_movies(spark, MOVIES), movie_rejection(), "movies").collect()
    assert {r["outcome"]: r["rows"] for r in movies} == {"kept": 5, "null": 1, "malformed movieId": 4}
    nulls = null_counts(clean_ratings(raw_ratings(spark, RATINGS)), "ratings").collect()
    assert {r["column"]: r["nulls"] for r in nulls} == {"userId": 0, "movieId": 0, "rating": 0, "timestamp": 2}


def test_minimum_support_counts_rows(spark):
    rows = [(u, 1, 3.0, u) for u in range(10)] + [(u, 2, 3.0, u) for u in range(9)] + [(1, 3, 3.0, 7)] * 10
    ratings = spark.createDataFrame(rows, schemas.CLEAN_RATINGS)
    kept = min_support(ratings, 10)
    assert kept.columns == ratings.columns
    assert {r["movieId"]: r["count"] for r in kept.groupBy("movieId").count().collect()} == {1: 10, 3: 10}


@pytest.mark.parametrize("broadcast", ["-1", "10485760"])
def test_minimum_support_spreads_a_hot_item(spark, with_conf, broadcast):
    with_conf(spark__sql__autoBroadcastJoinThreshold=broadcast)
    hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500)
    ratings = spark.range(20_000).select(F.col("id").alias("userId"), hot.cast("int").alias("movieId"), (F.col("id") % 10).alias("x"))
    plain = {r["movieId"]: r["count"] for r in ratings.groupBy("movieId").count().collect()}
    kept = min_support(ratings, 27, rows_per_task=500)
    assert kept.count() == sum(n for n in plain.values() if n >= 27)
    assert kept.distinct().count() == kept.count()


def test_csv_quotes_and_empty_fields(spark, tmp_path):
    (tmp_path / "movies.csv").write_text(
        'movieId,title,genres\n1,"""Quoted"" at Night (1971)",Noir\n2,,\n3,"Last, but (1972)",Noir|Western\n'
    )
    (tmp_path / "ratings.csv").write_text("userId,movieId,rating,timestamp\n1,1,4.0,964982703\n1,2,x,5\n")
    movies, ratings = read_raw(spark, str(tmp_path))
    assert all(kind == "string" for _, kind in movies.dtypes + ratings.dtypes)
    titles = {r["movieId"]: (r["title"], r["genres"]) for r in clean_movies(movies).collect()}
    assert titles == {
        1: ('"Quoted" at Night (1971)', "Noir"),
        2: ("Unknown", "Unknown"),
        3: ("Last, but (1972)", "Noir|Western"),
    }


def test_run_from_files_to_files(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "movies.csv").write_text("movieId,title,genres\n1,A (2000),X|Y\n2,B (2001),Z\nx,C,Z\n")
    lines = [f"{u},1,4.0,{u}" for u in range(12)] + [f"{u},2,3.0,{u}" for u in range(3)] + ["q,1,1,1"]
    (raw / "ratings.csv").write_text("userId,movieId,rating,timestamp\n" + "\n".join(lines) + "\n")
    movies_path, ratings_path, counts = run_cleaning(spark, str(raw), str(tmp_path / "clean"))
    assert spark.read.parquet(movies_path).count() == 2
    stored = spark.read.parquet(ratings_path)
    assert stored.count() == 12
    assert stored.schema.simpleString() == schemas.CLEAN_RATINGS.simpleString()
    assert {(r["table"], r["outcome"]): r["rows"] for r in counts.collect()} == {
        ("movies", "kept"): 2,
        ("movies", "malformed movieId"): 1,
        ("movies", "stored"): 2,
        ("ratings", "kept"): 15,
        ("ratings", "malformed userId"): 1,
        ("ratings", "stored"): 12,
    }
