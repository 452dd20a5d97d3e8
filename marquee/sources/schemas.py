"""Schemas of the stored tables."""

from __future__ import annotations

from pyspark.sql import types as T

EMBEDDING_DIM = 50


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_INT, _LONG, _TEXT, _FLOAT = T.IntegerType(), T.LongType(), T.StringType(), T.FloatType()
VECTOR = T.ArrayType(_FLOAT)

RAW_MOVIES = _table(movieId=_TEXT, title=_TEXT, genres=_TEXT)
RAW_RATINGS = _table(userId=_TEXT, movieId=_TEXT, rating=_TEXT, timestamp=_TEXT)
CLEAN_MOVIES = _table(movieId=_INT, title=_TEXT, genres=_TEXT)
CLEAN_RATINGS = _table(userId=_INT, movieId=_INT, rating=_FLOAT, timestamp=_LONG)
FACTORS = _table(id=_INT, features=VECTOR)

MOVIES = _table(movie_id=_INT, title=_TEXT, genres=_TEXT)
RATINGS = _table(user_id=_INT, movie_id=_INT, rating=T.DecimalType(2, 1), rated_at=T.TimestampType())
USER_FACTORS = _table(user_id=_INT, features=VECTOR, loaded_at=T.TimestampType())
MOVIE_FACTORS = _table(movie_id=_INT, features=VECTOR, loaded_at=T.TimestampType())

SERVING = {"movies": MOVIES, "ratings": RATINGS, "user_factors": USER_FACTORS, "movie_factors": MOVIE_FACTORS}
