"""Substring search through a stored table of trigrams.

Each text column of a row is written as its distinct runs of three characters (small letters), one posting a row:
(place, column, gram, id). The place is a hash of column and gram, and each place is a folder of its own. A question's
own trigrams name the places that hold its postings; rows that have all of them are candidates, and the question
itself decides among these, so the answer is that of a scan. A question whose text has no three plain characters in a
row (``%`` and ``_`` are wildcards) has no trigram and scans the rows.

The rows are stored beside the postings, dealt by id, so candidates are read from the folders they lie in.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from marquee.session import store_once

PLACES = 64
SIZE = 3


def trigrams(text: Column) -> Column:
    """The distinct runs of SIZE characters of a text in small letters."""
    small = F.lower(text)
    starts = F.sequence(F.lit(1), F.length(small) - (SIZE - 1))
    runs = F.transform(starts, lambda at: F.substr(small, at, F.lit(SIZE)))
    return F.when(F.length(small) >= SIZE, F.array_distinct(runs)).otherwise(F.array().cast("array<string>"))


def _place(column: Column, gram: Column, places: int) -> Column:
    return F.pmod(F.xxhash64(column, gram), F.lit(places)).cast("int")


class TextIndex:
    """The index in a folder, which ``build`` has written."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        settings = spark.read.parquet(f"{path}/settings").first()
        self.id_column, self.places = settings["id_column"], settings["places"]
        # Told rather than found, as a table without rows has no files.
        self._rows_schema = StructType.fromJson(json.loads(settings["schema"]))
        kind = self._rows_schema[self.id_column].dataType.simpleString()
        self._postings_schema = f"{self.id_column} {kind}, row_place int, column string, gram string, place int"

    @classmethod
    def build(
        cls, rows: DataFrame, path: str, columns: Sequence[str] = ("title", "genres"), id_column: str = "movie_id", places: int = PLACES
    ) -> TextIndex:
        """Write the postings of the text columns, and the rows; the folder must not exist yet."""
        spark = rows.sparkSession
        rows = rows.withColumn("row_place", F.pmod(F.xxhash64(id_column), F.lit(places)).cast("int"))
        grams = [rows.select(id_column, "row_place", F.lit(c).alias("column"), F.explode(trigrams(F.col(c))).alias("gram")) for c in columns]
        postings = grams[0]
        for more in grams[1:]:
            postings = postings.unionByName(more)
        postings = postings.withColumn("place", _place(F.col("column"), F.col("gram"), places))
        # A common gram is cut by ids as well, so that no task holds all of its postings.
        postings.repartition("place", "row_place").sortWithinPartitions("place", "column", "gram").write.partitionBy("place").parquet(f"{path}/postings")
        rows.repartition("row_place").write.partitionBy("row_place").parquet(f"{path}/rows")
        settings = [(id_column, places, rows.schema.json())]
        spark.createDataFrame(settings, "id_column string, places int, schema string").write.parquet(f"{path}/settings")
        return cls(spark, path)

    @property
    def postings(self) -> DataFrame:
        return self.spark.read.schema(self._postings_schema).parquet(f"{self.path}/postings")

    @property
    def rows(self) -> DataFrame:
        return self.spark.read.schema(self._rows_schema).parquet(f"{self.path}/rows")

    def grams_of(self, asked: dict[str, str | None]) -> list[tuple[str, str, int]]:
        """(column, gram, place) of all plain runs in the texts asked for; a text with a backslash has none."""
        runs = [(c, run) for c, text in asked.items() if text and "\\" not in text for run in re.split("[%_]", text) if run]
        if not runs:
            return []
        found = self.spark.createDataFrame(runs, "column string, run string").select("column", F.explode(trigrams(F.col("run"))).alias("gram"))
        found = found.distinct().withColumn("place", _place(F.col("column"), F.col("gram"), self.places))
        return sorted((r["column"], r["gram"], r["place"]) for r in found.collect())

    def read_postings(self, grams: list[tuple[str, str, int]]) -> DataFrame:
        """The postings of these grams; only their places are read."""
        pairs = [(F.col("column") == column) & (F.col("gram") == gram) for column, gram, _ in grams]
        places = sorted({place for _, _, place in grams})
        return self.postings.where(F.col("place").isin(places) & reduce(or_, pairs))

    def candidates(self, asked: dict[str, str | None]) -> DataFrame | None:
        """(id, row_place) of the rows that have every gram asked for; None if none is asked for."""
        grams = self.grams_of(asked)
        if not grams:
            return None
        having = self.read_postings(grams).groupBy(self.id_column, "row_place").agg(F.count_distinct("column", "gram").alias("n"))
        return having.where(F.col("n") == len(grams)).select(self.id_column, "row_place")

    def matching(self, asked: dict[str, str | None]) -> DataFrame:
        """The rows whose columns contain the texts asked for, in any case."""
        rows, found = self.rows, self.candidates(asked)
        if found is not None:
            found = store_once(found, "candidates")
            places = [r[0] for r in found.select("row_place").distinct().collect()]  # at most as many as there are places
            rows = rows.where(F.col("row_place").isin(places)).join(found.select(self.id_column), self.id_column, "left_semi")
        for column, text in asked.items():
            if text:
                rows = rows.where(F.col(column).ilike(f"%{text}%"))
        return rows.drop("row_place")

    def files(self, asked: dict[str, str | None]) -> tuple[int, int]:
        """Files of postings that the question reads, and all there are."""
        count = lambda df: df.select(F.input_file_name().alias("f")).distinct().count()
        places = sorted({place for _, _, place in self.grams_of(asked)})
        return count(self.postings.where(F.col("place").isin(places))), count(self.postings)
