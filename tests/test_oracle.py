"""Registered linkage queries against their oracle SQL, on rows planted where the two engines have differed."""

import collections
import re

import pytest
from pyspark.sql import functions as F

from rowkin.functions import normalize
from rowkin.plans import catalog

duckdb = pytest.importorskip("duckdb")


def edges():
    """Texts whose places of words (first, third, half, two thirds, last) hold words with letters beyond ASCII at either end."""
    words = ["stß", "verstß", "co", "coß", "ßst", "rd", "ßrd", "limitedß", "privatelimited", "ßcompany", "straße", "flß", "über", "inc", "aveßct", "est"]
    return [(i, " ".join(words[(i * 7 + k * (1 + i % 5)) % len(words)] for k in range(3 + i % 11)), ("en", "de", "fr", "es")[i % 4]) for i in range(240)]


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("planted")
    spark.createDataFrame(edges(), "doc_id long, text string, lang string").write.parquet(str(folder / "documents.parquet"))
    return str(folder)


def differences(spark, name, folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')")
    found = con.execute(catalog.ORACLES[name])
    names = [c[0] for c in found.description]
    expected = collections.Counter(found.fetchall())
    got = collections.Counter(tuple(r) for r in catalog.QUERIES[name](spark, folder).select(names).collect())
    assert got
    return list((got - expected).items())[:3], list((expected - got).items())[:3]


def test_words_end_at_ascii_letters(spark):
    words = [w for _, text, _ in edges()[:16] for w in (text, text.replace(" ", "ß"))] + ["private limited", "ßprivate limitedß st", "éprivatelimited", "", " "]
    df = spark.createDataFrame(enumerate(words), "i int, x string")
    rows = df.select("x", normalize.standardize_legal_forms(F.col("x"), True).alias("n"), normalize.expand_street_words(F.col("x"), True).alias("a")).collect()
    for r in rows:
        name, addr = re.sub(rf"\b(?:{'|'.join(normalize.PRIVATE_LIMITED)})\b", "pvt ltd", r["x"], flags=re.ASCII), r["x"]
        for k, v in normalize.LEGAL_TOKENS.items():
            name = re.sub(rf"\b{k}\b", v, name, flags=re.ASCII)
        for k, v in normalize.STREET_TOKENS.items():
            addr = re.sub(rf"\b{k}\b", v, addr, flags=re.ASCII)
        assert (r["n"], r["a"]) == (name, addr)


def test_rounding_is_the_engines(spark):
    numbers = [n / 6400 * f for n in range(0, 6400, 7) for f in (0.85, 1.0, -0.45)] + [0.0640625, 2.5e-6, 1e9 + 0.0000005]
    df = spark.createDataFrame([(x,) for x in numbers], "x double")
    for places in (4, 6):
        expected = [r[0] for r in duckdb.execute(f"SELECT round(x, {places}) FROM (SELECT unnest(?::DOUBLE[]) AS x)", [numbers]).fetchall()]
        assert [r[0] for r in df.select(catalog._round(F.col("x"), places)).collect()] == expected


@pytest.mark.parametrize("name", ["normalized_tables", "token_arrays", "blocking_key_table", "bucket_caps", "pair_features", "features_file", "best_anchor", "match_file", "match_lists", "match_summary", "pair_scores"])
def test_like_its_sql(spark, planted, name):
    assert differences(spark, name, planted) == ([], [])
