"""Every registered query against its SQL in DuckDB."""

import os

import pytest

import __spark_entry__ as driver
from compare import duck, duck_rows, spark_rows
from marquee.oracles import ORACLE
from marquee.registry import QUERIES

TESTDATA = "/root/testdata"
# The smallest folder unless told otherwise, such as MARQUEE_SCALES=0.001,0.01.
SCALES = os.environ.get("MARQUEE_SCALES", "0.001").split(",")
WITHOUT_SQL = {"als_factors", "als_rmse", "als_ranking", "recommend_lsh"}

pytestmark = pytest.mark.skipif(not os.path.isdir(TESTDATA), reason="no test tables here")


def test_only_the_named_queries_lack_sql():
    assert set(QUERIES) - set(ORACLE) == WITHOUT_SQL


@pytest.mark.parametrize("name", sorted(ORACLE))
@pytest.mark.parametrize("scale", SCALES)
def test_same_rows(spark, scale, name):
    sf_dir = f"{TESTDATA}/sf{scale}"
    columns, found = spark_rows(QUERIES[name](spark, sf_dir))
    wanted_columns, wanted = duck_rows(duck(sf_dir), ORACLE[name])
    assert columns == wanted_columns
    assert wanted, "an empty comparison proves nothing"
    assert found == wanted


@pytest.mark.parametrize("name", sorted(WITHOUT_SQL))
def test_others_give_rows(spark, name):
    assert QUERIES[name](spark, f"{TESTDATA}/sf0.001").count() > 0


def test_entry(spark):
    trending = driver.entry(spark)
    assert trending.columns == ["movie_id", "title", "genres", "avg_rating", "rating_count"]
    assert trending.count() == 10


def test_the_driver_sees_all_of_them():
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLE) <= set(driver.oracle_sql())
