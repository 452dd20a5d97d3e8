"""Substring search through trigrams against the scan."""

import random

import pytest

from marquee.operators.text_index import TextIndex
from marquee.plans.catalog import search, search_indexed


@pytest.fixture(scope="module")
def movies(spark):
    draw = random.Random(1)
    words = ["Red", "blue", "RING", "Éclair", "50%", "a_b", "x", "the", "Ünder", "ss"]
    rows = [(i, " ".join(draw.choices(words, k=draw.randint(0, 5))), "|".join(draw.choices(words, k=2))) for i in range(300)]
    rows += [(300, None, "Red|x"), (301, "Red", None), (302, None, None), (303, "", ""), (304, "re\\d ring", "blue")]
    return spark.createDataFrame(rows, "movie_id int, title string, genres string")


@pytest.fixture(scope="module")
def index(movies, tmp_path_factory):
    return TextIndex.build(movies, str(tmp_path_factory.mktemp("text") / "index"), places=16)


@pytest.mark.parametrize("query", ["red", "RING", "ed bl", "éCL", "x", "50%", "a_b", "r%g", "ring%the", "_ed", "nothing like it", "%", "", None, "under", "re\\\\d"])
@pytest.mark.parametrize("genre", [None, "blue", "ün"])
def test_same_rows_as_the_scan(movies, index, query, genre):
    assert search_indexed(index, query, 1000, genre).collect() == search(movies, query, 1000, genre).collect()


def test_few_files_are_read(index):
    few, whole = index.files({"title": "ring", "genres": None})
    assert 0 < few <= 2 and whole > 10
    assert index.grams_of({"title": "ab", "genres": "a_b%c"}) == []


def test_without_rows(spark, movies, tmp_path):
    empty = TextIndex.build(movies.limit(0), f"{tmp_path}/empty")
    assert search_indexed(empty, "red").collect() == []
