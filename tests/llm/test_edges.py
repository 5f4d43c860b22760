"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names, for every operator and stage."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rowkin.llm import jaccard_tiles, license_scan, poisson_mix, ppm, pu_quality, quality_mcd, toxicity, url_cascade, warc, winnow

SF = "/root/testdata/sf0.001"
CLASHES = "score predicted held_out n_words kept base_failed d2 node key _t _w _l labels rate copy n_copies shuffle_key host path rule verdict piece n_hit contaminated spans segments".split()
LONG = "lorem ipsum " * 30_000

ROWS = [
    (1, "the quick brown fox jumps over the lazy dog again and again", "en", "a"),
    (1, "the quick brown fox jumps over the lazy dog again and again", "en", "a"),
    (2, None, None, None),
    (3, "", "en", "a"),
    (None, "the quick brown fox jumps over the lazy dog again and again", "en", None),
    (4, LONG, "fr", "b"),
    (5, " \t\r\n ", "en", "b"),
    (6, "word", "de", "b"),
    (7, "MIT License Ünïcode # $ ### \U0001f600 naïve", "de", "c"),
]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame([(*r, len(r[1] or "")) for r in ROWS], "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit("x") for c in CLASHES}).coalesce(2).cache()


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (1, 0, 1), (2, 1, 1), (3, None, None), (None, 1, 1), (4, 0, 1), (7, 1, 0), (99, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int").withColumn("label", F.lit("x"))


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, "quick brown fox jumps over the lazy dog again and"), (2, None), (None, "word"), (3, "")], "item_id long, text string")


def test_toxicity(docs, labels):
    rows = toxicity.toxicity(docs, labels, keep=("lang", "score")).collect()
    assert len(rows) == len(ROWS) and all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in rows)
    assert toxicity.toxicity(docs.limit(0), labels.limit(0)).count() == 0
    assert all(r["score"] < 1e-9 for r in toxicity.toxicity(docs, labels.limit(0)).collect())


def test_quality_classifier(docs, labels):
    rows = pu_quality.quality_classifier(docs, labels, keep=("text", "lang", "score")).collect()
    assert len(rows) == len(ROWS) and all(0 <= r["score"] <= 1 for r in rows)
    assert pu_quality.quality_classifier(docs.limit(0), labels).count() == 0
    assert {r["score"] for r in pu_quality.quality_classifier(docs, labels.limit(0)).collect()} == {0.5}


def test_ppm(docs):
    rows = ppm.ppm_score(docs).collect()
    assert len(rows) == len(ROWS)
    by_text = {r["doc_id"]: r for r in rows}
    assert by_text[2]["n_tokens"] == by_text[3]["n_tokens"] == by_text[5]["n_tokens"] == 1 and by_text[2]["score"] == by_text[3]["score"] < 0
    assert ppm.ppm_score(docs.limit(0)).count() == 0


def test_url_filter(spark):
    urls = [None, "", "no scheme", "http://", "https://A.Net/x", "ftp://b.example.net:80/en/?q", "x://net", "x://net/", "http://evilnet/", "http://org/fr/a", "http://example.com?a=/de/", "http://n\nn.net/\n", "a://b://c.net/"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string").withColumns({c: F.lit("x") for c in ("host", "path", "rule", "verdict", "_hit", "key")})
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_cascade.url_filter(df, url_cascade.RULES).collect()}
    assert got[0] == got[1] == got[2] == got[3] == ("", "", None, "allow")
    assert got[4] == ("a.net", "/x", "net/", "block")
    assert got[5] == ("b.example.net:80", "/en/", None, "allow")
    assert got[6] == ("net", "", None, "allow") and got[7] == ("net", "/", "net/", "block")
    assert got[8][2] is None and got[9][2:] == ("org/fr/", "allow") and got[10] == ("example.com", "", None, "allow")
    assert got[11] == ("n\nn.net", "/\n", "net/", "block") and got[12] == ("b:", "//c.net/", None, "allow")
    assert url_cascade.url_filter(df.limit(0), url_cascade.RULES).count() == 0


def test_poisson(docs):
    rows = poisson_mix.poisson_mix(docs).collect()
    assert all(1 <= r["copy"] <= r["n_copies"] for r in rows)
    assert poisson_mix.poisson_mix(docs.limit(0)).count() == 0
    only = poisson_mix.poisson_mix(docs, weights={"a": 1.0}, epochs=3).collect()
    assert {r["source"] for r in only} <= {"a"}
    assert poisson_mix.poisson_mix(docs, weights={None: 1.0}, epochs=2).filter("source is not null").count() == 0
    with pytest.raises(ValueError):
        poisson_mix.poisson_mix(docs, epochs=1e6)


def test_warc(spark, tmp_path):
    rows = [(1, "http://a.b/x", "é"), (2, None, None), (3, "http://a.b/x\r\ny", ""), (4, "http://A.b/y#f", "é"), (5, "u", "\r\n\r\nWARC/1.1\r\n\r\n"), (5, "u", "z" * 300_000), (None, "", "z")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("x") for c in ("digest", "first", "id", "bytes", "payload")})
    warc.write_warc(df, str(tmp_path / "w"))
    got = warc.merge_index(warc.read_warc(spark, str(tmp_path / "w"))).collect()
    kinds = {(r["page_id"], r["payload_bytes"]): (r["record_type"], r["refers_to"]) for r in got}
    assert len(got) == len(rows) and kinds["1", 2] == ("revisit", "4") and kinds["2", 0] == ("revisit", "3") and kinds["4", 2] == ("response", None)
    assert kinds["null", 1] == ("response", None) and all(len(r["payload_digest"]) == 32 for r in got)
    order = [(r["range"], r["place"]) for r in got]
    keys = [k for _, k in sorted(zip(order, [(r["url_key"], r["date"], r["number"]) for r in got], strict=True))]
    assert keys == sorted(keys)
    warc.write_warc(df.limit(0), str(tmp_path / "e"))
    assert warc.read_warc(spark, str(tmp_path / "e")).count() == 0


def test_license(docs):
    rows = {r["doc_id"]: r for r in license_scan.license_scan(docs).collect()}
    assert rows[7]["base_labels"] == "mit" and rows[7]["first_word"] == rows[7]["last_word"] == 0 and rows[7]["score"] == 1.0
    assert rows[2]["n_words"] == 0 and rows[2]["labels"] == "" and rows[2]["first_word"] is None and rows[4]["n_words"] == 60_000
    assert license_scan.license_scan(docs.limit(0)).count() == 0


def test_winnowing(docs, benchmark):
    for block_words in (1_000_000, 5):
        rows = winnow.decontaminate(docs, benchmark, keep=("doc_id", "lang"), block_words=block_words).collect()
        hit = {r["doc_id"]: (r["n_hit"], r["n_items"], r["contaminated"]) for r in rows}
        assert len(rows) == len(ROWS) and hit[1] == (10, 1, True) and hit[6] == (1, 1, True) and hit[2] == hit[3] == (0, 0, False)
    assert winnow.decontaminate(docs.limit(0), benchmark, keep=("doc_id",)).count() == 0
    assert winnow.decontaminate(docs, benchmark.limit(0), keep=("doc_id",)).filter("contaminated").count() == 0


def test_quality_rules(docs):
    rows = {r["doc_id"]: r for r in quality_mcd.quality_rules(docs, keep=("doc_id", "score")).collect()}
    assert not any(r["kept"] for r in rows.values()) and rows[4]["n_words"] == 60_000 and rows[4]["n_repeat_words"] == 60_000
    assert rows[2]["n_words"] == 0 and rows[2]["base_failed"]
    assert quality_mcd.quality_rules(docs.limit(0)).count() == 0


def test_jaccard(docs):
    rows = jaccard_tiles.jaccard_groups(docs).collect()
    assert len(rows) == len(ROWS)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}
    assert got[1] == (10, 1) and got[None] == (10, 1) and got[2] == (0, 2) and got[3] == (0, 3) and got[5] == (0, 5) and got[6] == (1, 6) and got[4] == (2, 4)
    assert jaccard_tiles.jaccard_groups(docs.limit(0)).count() == 0


@pytest.mark.skipif(not Path(SF).exists(), reason="needs the test tables")
def test_pipeline_stages(spark, docs):
    import corpus_pipeline

    for _, stage in corpus_pipeline.STAGES:
        for df in (docs, docs.limit(0)):
            out = stage(spark, df, SF)
            assert out.columns[:5] == corpus_pipeline.COLUMNS or set(corpus_pipeline.COLUMNS) <= set(out.columns)
            assert out.count() <= 4 * len(ROWS)
