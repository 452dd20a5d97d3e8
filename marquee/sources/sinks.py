"""Writers, and the store of published tables."""

from __future__ import annotations

from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marquee.operators.contracts import (
    MOVIES,
    RATINGS,
    ContractError,
    check,
    check_factors,
    enforce,
    factor_contract,
    split_valid,
)
from marquee.operators.keyed import upsert
from marquee.session import HASH_JOINS, remove_folder, runtime_option
from marquee.sources import schemas


def write_clean(movies: DataFrame, ratings: DataFrame, out_dir: str) -> tuple[str, str]:
    """Store the cleaned tables, straight from the tasks that made them."""
    movies_path, ratings_path = f"{out_dir}/movies_clean.parquet", f"{out_dir}/ratings_clean.parquet"
    movies.write.mode("overwrite").parquet(movies_path)
    ratings.write.mode("overwrite").parquet(ratings_path)
    return movies_path, ratings_path


def write_factors(users: DataFrame, items: DataFrame, out_dir: str, dim: int = schemas.EMBEDDING_DIM) -> tuple[str, str]:
    """Check user and item vectors, then store them; a wrong length or id raises and nothing is overwritten."""
    check_factors(users, items, dim)
    paths = f"{out_dir}/user_factors.parquet", f"{out_dir}/movie_factors.parquet"
    users.withColumnRenamed("user_id", "userId").write.mode("overwrite").parquet(paths[0])
    items.withColumnRenamed("movie_id", "movieId").write.mode("overwrite").parquet(paths[1])
    return paths


def write_report(report: DataFrame, path: str) -> None:
    """Store a report as JSON lines."""
    report.write.mode("overwrite").json(path)


def serving_movies(clean: DataFrame) -> DataFrame:
    return clean.select(
        F.col("movieId").cast("int").alias("movie_id"),
        F.coalesce(F.col("title").cast("string"), F.lit("Unknown")).alias("title"),
        F.coalesce(F.col("genres").cast("string"), F.lit("Unknown")).alias("genres"),
    )


def serving_ratings(clean: DataFrame) -> DataFrame:
    """Ratings rounded to one decimal and epoch seconds as a time.

    A rating too large for the column becomes null and so fails the contract.
    """
    rounded = F.round(F.col("rating").cast("double"), 1).try_cast("decimal(2,1)")
    return clean.select(
        F.col("userId").cast("int").alias("user_id"),
        F.col("movieId").cast("int").alias("movie_id"),
        rounded.alias("rating"),
        F.timestamp_seconds(F.col("timestamp")).alias("rated_at"),
    )


def serving_factors(factors: DataFrame, id_column: str) -> DataFrame:
    """Factors as (id, features, loaded_at), stamped with the time of the load."""
    return factors.select(
        F.col("id").cast("int").alias(id_column),
        F.col("features").cast("array<float>").alias("features"),
        F.current_timestamp().alias("loaded_at"),
    )


class Store:
    """The published state of the four serving tables under one folder.

    A publication writes all four tables into a folder of its own, checks what was written, and then makes one
    small file, ``published/<number>``, that names the folder; the number is one more than that of the state it was
    made from. The file is made without overwriting, so of two loads that started from one state exactly one
    gets the number, and the other is refused. Readers take the highest number. A load that fails or is killed
    before has changed nothing.

    The folder has to be on a file system that makes a file only once when asked not to overwrite (HDFS, or an
    object store's connector with conditional writes).
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def _files(self, folder: str) -> list[tuple[str, int]]:
        """Names and sizes of what lies in a folder."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{folder}")
        files = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return [(s.getPath().getName(), s.getLen()) for s in files.listStatus(path)] if files.exists(path) else []

    def _newest(self) -> int:
        """The number of the published state, 0 for none. A file without its content yet is not published."""
        return max((int(name) for name, size in self._files("published") if name.isdigit() and size), default=0)

    def _claim(self, number: int, version: str) -> bool:
        """Make ``version`` the state of this number, unless another load was first."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/published/{number:012d}")
        files = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        try:
            out = files.create(path, False)
        except Py4JJavaError:
            if files.exists(path):
                return False
            raise
        out.write(bytearray(version.encode()))
        out.close()
        return True

    def _version(self, number: int) -> str:
        return self.spark.read.text(f"{self.root}/published/{number:012d}").first()[0]

    def current(self) -> str | None:
        """The version that is published."""
        number = self._newest()
        return self._version(number) if number else None

    def clean_up(self) -> list[str]:
        """Remove what belongs to no published state: folders of loads that failed, and staged input; gives what was removed.

        Call it when no load is under way: a load in progress is not published yet.
        """
        listed = {self._version(int(name)) for name, size in self._files("published") if name.isdigit() and size}
        removed = []
        for version, _ in self._files("versions"):
            folder = f"{self.root}/versions/{version}"
            if version not in listed:
                removed.append(folder)
            elif any(name == "incoming" for name, _ in self._files(f"versions/{version}")):
                removed.append(f"{folder}/incoming")
        for folder in removed:
            remove_folder(self.spark, folder)
        return removed

    def path(self, version: str, table: str) -> str:
        return f"{self.root}/versions/{version}/{table}"

    def read(self, table: str, version: str | None = None) -> DataFrame:
        version = version or self.current()
        if version is None:
            raise LookupError(f"nothing is published under {self.root}")
        return self.spark.read.schema(schemas.SERVING[table]).parquet(self.path(version, table))

    def tables(self) -> dict[str, DataFrame]:
        version = self.current()
        if version is None:
            raise LookupError(f"nothing is published under {self.root}")
        return {name: self.read(name, version) for name in schemas.SERVING}

    def publish(
        self,
        movies: DataFrame,
        ratings: DataFrame,
        user_factors: DataFrame,
        movie_factors: DataFrame,
        dim: int = schemas.EMBEDDING_DIM,
        replace: bool = False,
        strict: bool = True,
    ) -> str:
        """Merge (or put in place of) the published tables; gives the new version.

        Inputs have the serving columns. Repeated keys always refuse the load. A rating out
        of range or without its movie refuses it too, unless ``strict`` is off: then such
        rows go to the table ``ratings_refused`` of the version and the others are published.
        """
        number = self._newest()
        before = self._version(number) if number and not replace else None
        version = uuid4().hex
        contracts = {
            "movies": MOVIES,
            "ratings": RATINGS,
            "user_factors": factor_contract("user_factors", "user_id", dim),
            "movie_factors": factor_contract("movie_factors", "movie_id", dim),
        }
        incoming = {"movies": movies, "ratings": ratings, "user_factors": user_factors, "movie_factors": movie_factors}
        staged: dict[str, DataFrame] = {}
        # Joins, also those of the inputs, sort nothing if each part of a side can be held by a task; larger parts are sorted and merged.
        with runtime_option(self.spark, HASH_JOINS, "64MB"):
            for name, df in incoming.items():
                # Keys are checked on the input: a merge would hide a key that comes twice.
                loaded = self._stage(version, f"incoming/{name}", df)
                if not strict and name == "ratings":
                    loaded = self._set_aside(version, loaded, staged["movies"])
                rules = contracts[name]
                parents = {"movies": staged["movies"]} if rules.references else None
                enforce(check(loaded, rules, parents))
                if before is not None:
                    kept = ["loaded_at"] if name.endswith("factors") else []
                    loaded = upsert(self.read(name, before), loaded, rules.key, kept)
                self._write(version, name, loaded)
                staged[name] = self.read(name, version)
            if before is not None:
                enforce(check(staged["ratings"], RATINGS, {"movies": staged["movies"]}))
        if not self._claim(number + 1, version):
            raise ContractError(f"another load was published on top of state {number} meanwhile; run this one again")
        return version

    def _stage(self, version: str, table: str, df: DataFrame) -> DataFrame:
        df.write.parquet(self.path(version, table))
        return self.spark.read.schema(df.schema).parquet(self.path(version, table))

    def _write(self, version: str, table: str, df: DataFrame) -> None:
        """Store a table ordered by key, so that file statistics serve a lookup by user or movie."""
        place = _place(table)
        typed = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.SERVING[table].fields])
        typed.repartitionByRange(place).sortWithinPartitions(place).write.parquet(self.path(version, table))

    def _set_aside(self, version: str, ratings: DataFrame, movies: DataFrame) -> DataFrame:
        """The ratings to publish; the others are stored with the rule they break."""
        sound, broken = split_valid(ratings, RATINGS)
        known = movies.select("movie_id")
        orphans = sound.join(known, "movie_id", "left_anti").withColumn("broken_rule", F.lit("orphan movie_id"))
        broken.unionByName(orphans).write.parquet(self.path(version, "ratings_refused"))
        return sound.join(known, "movie_id", "left_semi")


def _place(table: str) -> Column:
    """A number that orders rows like their key. Of two ids the first takes the high half: one whole number is sorted by its
    bits, two columns by comparing rows."""
    ids = [F.col(c).cast("bigint") for c in ("user_id", "movie_id") if c in schemas.SERVING[table].names]
    return ids[0] if len(ids) == 1 else F.shiftleft(ids[0], 32).bitwiseOR(ids[1] + (1 << 31))
