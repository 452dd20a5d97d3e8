"""Texts and numbers as a page shows them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from marquee.functions.genres import shown_genres

# The texts shown in place of missing data, and the title pattern.
UNTITLED = "Untitled"
NO_GENRE_TEXT = "Genres unavailable"
TITLE_YEAR = r"(?U)^(.*)\s+\((\d{4})\)$"


def _full_title(raw: Column) -> Column:
    return F.when(raw.isNull() | (raw == ""), UNTITLED).otherwise(raw)


def title_part(raw: Column) -> Column:
    """The title without its trailing year."""
    return F.when(raw.rlike(TITLE_YEAR), F.regexp_extract(raw, TITLE_YEAR, 1)).otherwise(_full_title(raw))


def year_part(raw: Column) -> Column:
    """The trailing year, or an empty text."""
    return F.coalesce(F.regexp_extract(raw, TITLE_YEAR, 2), F.lit(""))


def genre_text(genres: Column, most: int = 3) -> Column:
    text = F.array_join(shown_genres(genres, most), ", ")
    return F.when(F.coalesce(text, F.lit("")) == "", NO_GENRE_TEXT).otherwise(text)


def meta_text(title: Column, genres: Column, most: int) -> Column:
    """Year and genres joined by a bullet; an empty part is left out."""
    empty = F.lit("")
    return F.concat_ws(" • ", F.nullif(year_part(title), empty), F.nullif(genre_text(genres, most), empty))


def match_percent(similarity: Column) -> Column:
    """Similarity clamped to 0..1 as a whole percentage, halves to even; null counts as 0."""
    clamped = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(similarity, F.lit(0.0))))
    return F.bround(clamped * 100).cast("int")


def bar_percent(value: Column) -> Column:
    """A percentage cut to a whole number between 0 and 100."""
    return F.greatest(F.lit(0), F.least(F.lit(100), to_number(value).cast("int")))


def to_number(value: Column, default: float = 0.0) -> Column:
    """The value as a double; null or text that is no number gives the default."""
    return F.coalesce(value.try_cast("double"), F.lit(default))


def grouped_number(value: Column) -> Column:
    """Whole number with thousands separators; what is no whole number shows as 0."""
    return F.format_number(F.coalesce(value.try_cast("bigint"), F.lit(0).cast("bigint")), 0)


def readable_list(items: Column) -> Column:
    return F.array_join(items, ", ")


def one_decimal(value: Column) -> Column:
    return F.format_string("%.1f", to_number(value))
