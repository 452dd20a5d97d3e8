"""The rating domain seen through order tables: customers rate the parts they bought.

Lets every operator run on a star schema that holds no ratings of its own.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marquee.operators.keyed import newest_ratings
from marquee.operators.quantile_sketch import quantile_sketches
from marquee.operators.split import split_arithmetic
from marquee.session import configure, store_once
from marquee.sources.schemas import EMBEDDING_DIM
from marquee.sources.synthetic import arithmetic_vector

# Dirty text columns, as SQL that several engines read alike. Each fault is made from the row's own number.
DIRTY_MOVIE = {
    "movieId": """CASE p_partkey % 11 WHEN 0 THEN NULL WHEN 1 THEN CONCAT('part ', CAST(p_partkey AS STRING))
        WHEN 2 THEN CONCAT(CAST(p_partkey AS STRING), ',0') WHEN 3 THEN CONCAT('   ', CAST(p_partkey AS STRING), ' ')
        WHEN 4 THEN CAST(8000000000 + p_partkey AS STRING) ELSE CAST(p_partkey AS STRING) END""",
    "title": "CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_name END",
    "genres": "CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE CONCAT(p_type, '|', REPLACE(p_name, ' ', '|')) END",
}
DIRTY_RATING = {
    "userId": """CASE l_orderkey % 11 WHEN 0 THEN NULL WHEN 1 THEN CONCAT('customer ', CAST(o_custkey AS STRING))
        WHEN 2 THEN CONCAT(CAST(o_custkey AS STRING), ',5') WHEN 3 THEN CONCAT(' ', CAST(o_custkey AS STRING), '   ')
        WHEN 4 THEN CAST(8000000000 + o_custkey AS STRING) ELSE CAST(o_custkey AS STRING) END""",
    "movieId": """CASE l_partkey % 13 WHEN 0 THEN NULL WHEN 1 THEN CONCAT(CAST(l_partkey AS STRING), '/1')
        WHEN 2 THEN CONCAT('(', CAST(l_partkey AS STRING), ')') WHEN 3 THEN CONCAT('  ', CAST(l_partkey AS STRING))
        ELSE CAST(l_partkey AS STRING) END""",
    "rating": """CASE l_suppkey % 17 WHEN 0 THEN NULL WHEN 1 THEN CONCAT(CAST(CEIL(l_quantity / 5) / 2 AS STRING), ',0')
        WHEN 2 THEN CONCAT(CAST(CEIL(l_quantity / 5) / 2 AS STRING), 'E1') WHEN 3 THEN CAST(70 + CEIL(l_quantity / 5) / 2 AS STRING)
        WHEN 4 THEN CONCAT('   ', CAST(CEIL(l_quantity / 5) / 2 AS STRING), ' ')
        WHEN 5 THEN CONCAT('#', CAST(CEIL(l_quantity / 5) / 2 AS STRING)) ELSE CAST(CEIL(l_quantity / 5) / 2 AS STRING) END""",
    "timestamp": """CASE l_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN CONCAT('order ', CAST(l_orderkey AS STRING))
        WHEN 2 THEN CONCAT('  ', CAST(946684800 + l_orderkey * 60 AS STRING))
        ELSE CAST(946684800 + l_orderkey * 60 AS STRING) END""",
}
MOVIE = {
    "movieId": """CASE p_partkey % 11 WHEN 0 THEN NULL WHEN 1 THEN 'abc' WHEN 2 THEN '12.3'
        WHEN 3 THEN CONCAT('  ', CAST(p_partkey AS STRING), '  ') WHEN 4 THEN '99999999999'
        ELSE CAST(p_partkey AS STRING) END""",
    "title": "CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_name END",
    "genres": "CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE CONCAT(p_type, '|', REPLACE(p_name, ' ', '|')) END",
}
DIRTY_RATING = {
    "userId": """CASE l_orderkey % 11 WHEN 0 THEN NULL WHEN 1 THEN 'abc' WHEN 2 THEN '1.5'
        WHEN 3 THEN CONCAT('  ', CAST(o_custkey AS STRING), '  ') WHEN 4 THEN '99999999999'
        ELSE CAST(o_custkey AS STRING) END""",
    "movieId": """CASE l_partkey % 13 WHEN 0 THEN NULL WHEN 1 THEN '10.5' WHEN 2 THEN '-7'
        WHEN 3 THEN CONCAT(' ', CAST(l_partkey AS STRING)) ELSE CAST(l_partkey AS STRING) END""",
    "rating": """CASE l_suppkey % 17 WHEN 0 THEN NULL WHEN 1 THEN '4.5.6' WHEN 2 THEN '1e1' WHEN 3 THEN '99.5'
        WHEN 4 THEN '  4.0  ' WHEN 5 THEN '+3' ELSE CAST(CEIL(l_quantity / 5) / 2 AS STRING) END""",
    "timestamp": """CASE l_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 'not a time'
        WHEN 2 THEN CONCAT(' ', CAST(946684800 + l_orderkey * 60 AS STRING))
        ELSE CAST(946684800 + l_orderkey * 60 AS STRING) END""",
}
MOVIE = {
    "movie_id": "CAST(p_partkey AS INT)",
    "title": "CONCAT(p_name, ' (', CAST(1950 + p_size AS STRING), ')')",
    "genres": """CASE WHEN p_partkey % 97 = 0 THEN '(no genres listed)' WHEN p_partkey % 89 = 0 THEN NULL
        WHEN p_partkey % 83 = 0 THEN '' ELSE CONCAT(p_type, '|', REPLACE(p_name, ' ', '|')) END""",
}
RAW_RATING = {
    "user_id": "CAST(o_custkey AS INT)",
    "movie_id": "CAST(l_partkey AS INT)",
    "rating": "CEIL(l_quantity / 5) / 2",
    "rated_at": "CASE WHEN l_orderkey % 53 = 0 THEN NULL ELSE l_shipdate END",
}
# Ids folded onto the ids below ``{vectors}``, one more than the largest id among the vectors.
EVAL_RATING = {
    "user_id": "CAST(o_custkey % {vectors} AS INT)",
    "movie_id": "CAST(l_partkey % {vectors} AS INT)",
    "rating": "CEIL(l_quantity / 5) / 2",
}
# Rows that break the rules of the contracts.
SUSPECT_RATING = {
    "user_id": "CASE WHEN movie_id % 31 = 0 THEN NULL ELSE user_id END",
    "movie_id": "CASE WHEN user_id % 7 = 0 THEN movie_id + 1000000 ELSE movie_id END",
    "rating": "CASE WHEN movie_id % 29 = 0 THEN NULL WHEN user_id % 10 = 0 THEN rating + 3 ELSE rating END",
    "rated_at": "rated_at",
}
SUSPECT_MOVIE = {
    "movie_id": "CASE WHEN movie_id % 41 = 0 THEN NULL WHEN movie_id % 43 = 0 THEN 1 ELSE movie_id END",
    "title": "CASE WHEN movie_id % 37 = 0 THEN NULL ELSE title END",
    "genres": "genres",
}
DAMAGED_ID = """CASE WHEN id % 11 = 0 THEN NULL WHEN id % 13 = 0 THEN 1 WHEN id % 29 = 0 THEN id + 10000000 ELSE id END"""

CLUSTERS = 40


def columns(named: dict[str, str]) -> list[str]:
    return [f"{text} AS {name}" for name, text in named.items()]


class Proxies:
    """The tables of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = configure(spark)
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def _order_lines(self) -> DataFrame:
        return self.table("lineitem").join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))

    @cached_property
    def movies(self) -> DataFrame:
        return self.table("part").selectExpr(*columns(MOVIE))

    @cached_property
    def ratings_raw(self) -> DataFrame:
        """One row per purchase; a user may have several for one movie."""
        return self._order_lines.selectExpr(*columns(RAW_RATING))

    def ratings_of(self, orders: Column) -> DataFrame:
        """The purchases of some orders, as ratings."""
        return self._order_lines.filter(orders).selectExpr(*columns(RAW_RATING))

    @cached_property
    def ratings(self) -> DataFrame:
        """The newest rating per user and movie."""
        return newest_ratings(self.ratings_raw, ["user_id", "movie_id"])

    @cached_property
    def dirty_movies(self) -> DataFrame:
        return self.table("part").selectExpr(*columns(DIRTY_MOVIE))

    @cached_property
    def dirty_ratings(self) -> DataFrame:
        return self._order_lines.selectExpr(*columns(DIRTY_RATING))

    def _vectors(self, id_column: str) -> DataFrame:
        vectors = self.table("embeddings")
        return vectors.select(F.col("vec_id").cast("int").alias(id_column), F.col("embedding").alias("features"))

    @cached_property
    def user_factors(self) -> DataFrame:
        """Every stored vector as a user; each is a movie too."""
        return self._vectors("user_id")

    @cached_property
    def movie_factors(self) -> DataFrame:
        return self._vectors("movie_id")

    def _keys(self, table: str, key: str) -> DataFrame:
        """The keys alone, dealt to all cores: one small file may hold a million, each of which makes a vector."""
        return self.table(table).select(key).repartition(2 * self.spark.sparkContext.defaultParallelism, key)

    @cached_property
    def customer_vectors(self) -> DataFrame:
        """A vector for every customer, made from the customer's key."""
        key = F.col("c_custkey").cast("int")
        return self._keys("customer", "c_custkey").select(key.alias("user_id"), arithmetic_vector(key, EMBEDDING_DIM, 42).alias("features"))

    @cached_property
    def part_vectors(self) -> DataFrame:
        """A vector for every part, made from the part's key."""
        key = F.col("p_partkey").cast("int")
        return self._keys("part", "p_partkey").select(key.alias("movie_id"), arithmetic_vector(key, EMBEDDING_DIM, 43).alias("features"))

    def _clustered(self, table: str, key: str, name: str, seed: int) -> DataFrame:
        """Vectors close to one of CLUSTERS centres, the same for every table: key modulo CLUSTERS names the centre."""
        number = F.col(key).cast("int")
        centre, own = arithmetic_vector(number % CLUSTERS, EMBEDDING_DIM, 44), arithmetic_vector(number, EMBEDDING_DIM, seed)
        near = F.zip_with(centre, own, lambda c, o: c.cast("double") + o.cast("double") / 8)
        return self._keys(table, key).select(number.alias(name), near.alias("features"))

    @cached_property
    def clustered_customers(self) -> DataFrame:
        return self._clustered("customer", "c_custkey", "user_id", 45)

    @cached_property
    def clustered_parts(self) -> DataFrame:
        return self._clustered("part", "p_partkey", "movie_id", 46)

    @cached_property
    def ratings_eval(self) -> DataFrame:
        """Ratings with ids folded onto all the vectors there are, so that recommendations can hit."""
        vectors = self.table("embeddings").agg(F.max("vec_id") + 1).scalar()
        folded = {name: (F.col(key) % vectors).cast("int") for name, key in (("user_id", "o_custkey"), ("movie_id", "l_partkey"))}
        lines = self._order_lines.select(*[c.alias(name) for name, c in folded.items()], F.expr(EVAL_RATING["rating"]).alias("rating"))
        return lines.groupBy("user_id", "movie_id").agg(F.max("rating").alias("rating"))

    @cached_property
    def eval_split(self) -> tuple[DataFrame, DataFrame]:
        return split_arithmetic(self.ratings_eval, "user_id", "movie_id")

    @cached_property
    def customer_split(self) -> tuple[DataFrame, DataFrame]:
        return split_arithmetic(self.ratings, "user_id", "movie_id")

    @cached_property
    def stored_split(self) -> tuple[DataFrame, DataFrame]:
        """The same split of ratings computed once, for jobs that read them many times."""
        return split_arithmetic(store_once(self.ratings, "ratings"), "user_id", "movie_id")

    @cached_property
    def latencies(self) -> DataFrame:
        """Event values read as latency measures."""
        return self.table("events").select(F.col("user_id").cast("int").alias("user_id"), F.col("value").alias("ms"))

    @cached_property
    def daily_sketches(self) -> DataFrame:
        """A sketch of each day's measures."""
        measures = self.table("events").select(F.to_date("ts").alias("day"), F.col("value").alias("ms"))
        return store_once(quantile_sketches(measures, ["day"], "ms"), "sketches")
