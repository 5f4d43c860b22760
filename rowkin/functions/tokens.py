"""Tokens, numbers and character n-grams of normalized texts as array Columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words that tell businesses and streets apart too little: fixed values.
STOPWORDS = (
    "the and of in for on at to a an or by with pvt ltd private limited inc llc corp corporation co company services "
    "solutions enterprises group holdings international global national associates consultants center road street "
    "avenue drive lane court highway floor suite apartment block sector phase plot no near opp behind beside state "
    "city town district"
).split()


def tokens(c: Column) -> Column:
    """T5: split at spaces, none for the empty text."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), " "), lambda t: t != "")


def numbers(c: Column, longest: int | None = None, ascii_digits: bool = False) -> Column:
    """T2, or T1 with longest=10: tokens of decimal digits of any script. ascii_digits: of 0 to 9 only."""
    digits = r"^[0-9]+$" if ascii_digits else r"^\p{Nd}+$"
    found = F.filter(tokens(c), lambda t: t.rlike(digits))
    return found if longest is None else F.filter(found, lambda t: F.length(t) <= longest)


def distinctive_tokens(c: Column, least: int = 3) -> Column:
    """Tokens of at least `least` characters that aren't stopwords; order and repetitions stay."""
    stop = F.array(*[F.lit(w) for w in STOPWORDS])
    return F.filter(tokens(c), lambda t: (F.length(t) >= least) & ~F.array_contains(stop, t))


def first_word(c: Column) -> Column:
    """T4."""
    return F.coalesce(F.get(tokens(c), F.lit(0)), F.lit(""))


def char_ngrams(c: Column, n: int) -> Column:
    """The set of n-character substrings; a shorter text is its own only one, an empty text has none."""
    size = F.length(c)
    grams = F.transform(F.sequence(F.lit(1), F.greatest(size - n + 1, F.lit(1))), lambda i: F.substring(c, i, F.lit(n)))
    return F.array_distinct(F.when(size == 0, F.array().cast("array<string>")).when(size < n, F.array(c)).otherwise(grams))


def postal_codes(nums: Column) -> Column:
    """Numbers of five or six digits."""
    return F.filter(nums, lambda t: F.length(t).isin(5, 6))


def source_of(entity_id: Column) -> Column:
    """The two-character source tag of an id."""
    return F.substring(entity_id, 1, 2)


def with_tokens(df: DataFrame, ascii_digits: bool = False) -> DataFrame:
    """Everything that pair features need from one record, computed once per record before any join. ascii_digits: as for numbers."""
    return df.withColumns(
        {
            "name_tok": tokens(F.col("name_n")),
            "addr_tok": tokens(F.col("addr_n")),
            "name_2g": char_ngrams(F.col("name_n"), 2),
            "name_3g": char_ngrams(F.col("name_n"), 3),
            "addr_3g": char_ngrams(F.col("addr_n"), 3),
            "addr_nums": numbers(F.col("addr_n"), ascii_digits=ascii_digits),
        }
    )
