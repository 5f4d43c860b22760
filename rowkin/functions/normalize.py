"""Text normalization as Column expressions.

Only Unicode decomposition leaves the JVM: Spark SQL has no NFKD. The Arrow function behind it gets a null for
every ASCII value, so that pure ASCII data crosses the border as a validity bitmap.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ASCII = r"^[\x00-\x7F]*$"

#: Legal forms by token: fixed values.
LEGAL_TOKENS = {"limited": "ltd", "incorporated": "inc", "corporation": "corp", "company": "co"}
#: Spellings of "private limited" that become "pvt ltd": fixed values.
PRIVATE_LIMITED = ["pvtltd", "private limited", "privatelimited"]
#: Street words by token: fixed values.
STREET_TOKENS = {
    "rd": "road",
    "st": "street",
    "ave": "avenue",
    "dr": "drive",
    "blvd": "boulevard",
    "ln": "lane",
    "ct": "court",
    "hwy": "highway",
    "apt": "apartment",
    "ste": "suite",
    "fl": "floor",
}


@F.pandas_udf(T.StringType())
def _nfkd(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFKD", x), na_action="ignore")


def nfkd(c: Column, ascii_only: bool = False) -> Column:
    """Compatibility decomposition. ascii_only: the caller knows that there is nothing to decompose."""
    if ascii_only:
        return c
    return F.coalesce(_nfkd(F.when(~c.rlike(ASCII), c)), c)


def normalize_text(c: Column, ascii_only: bool = False) -> Column:
    """N1. Null is empty; what remains are letters and digits in tokens with single spaces between."""
    x = F.lower(nfkd(F.coalesce(c, F.lit("")), ascii_only))
    x = F.regexp_replace(x, r"[&+]", " and ")
    x = F.regexp_replace(x, r"[/,_\-;:|]", " ")
    x = F.regexp_replace(x, r"[\s\x{1c}-\x{1f}\x{85}\x{1680}\x{2028}\x{2029}]+", " ")
    x = F.regexp_replace(x, r"[^\p{L}\p{N} ]", "")
    return F.trim(F.regexp_replace(x, " +", " "))


#: Characters of a word where only ASCII counts, as in N1's results.
_WORD = "[0-9a-z]"


def _map_tokens(c: Column, of: dict[str, str], ascii_words: bool) -> Column:
    table = F.create_map(*[F.lit(x) for kv in of.items() for x in kv])
    cut, glue = (rf"(?<={_WORD})(?!{_WORD})|(?<!{_WORD})(?={_WORD})", "") if ascii_words else (" ", " ")
    return F.array_join(F.transform(F.split(c, cut), lambda t: F.coalesce(F.try_element_at(table, t), t)), glue)


def standardize_legal_forms(c: Column, ascii_words: bool = False) -> Column:
    """N2 on a text that N1 has normalized. ascii_words: a word ends where its ASCII letters and digits end, not only at spaces."""
    whole, other = "|".join(PRIVATE_LIMITED), _WORD if ascii_words else "[^ ]"
    return _map_tokens(F.regexp_replace(c, rf"(?<!{other})(?:{whole})(?!{other})", "pvt ltd"), LEGAL_TOKENS, ascii_words)


def expand_street_words(c: Column, ascii_words: bool = False) -> Column:
    """N3 on a text that N1 has normalized. ascii_words: as for N2."""
    return _map_tokens(c, STREET_TOKENS, ascii_words)


def normalize_name(c: Column, ascii_only: bool = False, ascii_words: bool = False) -> Column:
    return standardize_legal_forms(normalize_text(c, ascii_only), ascii_words)


def normalize_address(c: Column, ascii_only: bool = False, ascii_words: bool = False) -> Column:
    return expand_street_words(normalize_text(c, ascii_only), ascii_words)


def normalize_country(c: Column) -> Column:
    """N4. Blank or null is "unknown"; otherwise trimmed and in upper case."""
    spaces = F.lit(" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000")
    return F.when(F.coalesce(c, F.lit("")) == "", F.lit("unknown")).otherwise(F.upper(F.btrim(c, spaces)))


NORMALIZED = {
    "business_name": ("name_n", normalize_name),
    "business_address": ("addr_n", normalize_address),
}


def normalize_table(df: DataFrame, ascii_only: bool = False, ascii_words: bool = False) -> DataFrame:
    """Adds name_n, addr_n and country_n for those input columns that exist.

    A filter on these columns would make Catalyst run the Arrow function twice: write or persist the result first.
    """
    made = {out: of(F.col(c), ascii_only, ascii_words) for c, (out, of) in NORMALIZED.items() if c in df.columns}
    if "country" in df.columns:
        made["country_n"] = normalize_country(F.col("country"))
    return df.withColumns(made)
