"""The genre list: one string joined by pipes at rest, an array inside queries."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: what the catalogue writes when it knows no genre.
NO_GENRES = "(no genres listed)"


def genre_list(genres: Column) -> Column:
    """Elements of the list; an empty text has none, a null stays null."""
    return F.when(genres == "", F.array().cast("array<string>")).otherwise(F.split(genres, r"\|"))


def shared_genres(a: Column, b: Column) -> Column:
    """Distinct genres in both lists, in order; empty when either side is null."""
    common = F.array_sort(F.array_intersect(genre_list(a), genre_list(b)))
    return F.coalesce(common, F.array().cast("array<string>"))


# Bits of a mask in one number.
WORD = 63


def genre_mask(codes: Column, words: int) -> Column:
    """One bit for each code, in ``words`` numbers."""
    bit = lambda c: F.call_function("shiftleft", F.lit(1).cast("bigint"), (c % WORD).cast("int"))
    held = lambda w: F.filter(codes, lambda c: F.floor(c / WORD) == w)
    return F.transform(
        F.sequence(F.lit(0), F.lit(words - 1)), lambda w: F.aggregate(held(w), F.lit(0).cast("bigint"), lambda m, c: m.bitwiseOR(bit(c)))
    )


def genres_in_mask(codes: Column, mask: Column, dictionary: list[str]) -> Column:
    """The names of the codes whose bits the mask has, in the order of the codes; none for null codes or a null mask."""
    bit = lambda c: F.call_function("shiftright", F.get(mask, F.floor(c / WORD).cast("int")), (c % WORD).cast("int"))
    names = F.array(*[F.lit(g) for g in dictionary]).cast("array<string>")
    held = F.filter(codes, lambda c: F.coalesce(bit(c).bitwiseAND(F.lit(1)) == 1, F.lit(False)))
    return F.coalesce(F.transform(held, lambda c: F.get(names, c)), F.array().cast("array<string>"))


def shown_genres(genres: Column, most: int) -> Column:
    """The first ``most`` genres worth showing."""
    named = F.filter(genre_list(genres), lambda g: (g != "") & (g != NO_GENRES))
    return F.slice(named, 1, most)
