"""Registered linkage queries against their oracle SQL, on addresses with digits of other scripts, which the SQL's [0-9] doesn't know."""

import pytest

from tests.test_oracle import differences


@pytest.fixture(scope="module")
def digits(spark, tmp_path_factory):
    words = ["٣٤٥٦٧", "haus", "१२३४५", "river", "12345", "bridge", "٧", "maison", "123456", "x٣", "casa", "12345678901", "٣٤5", "green"]
    texts = [(i, " ".join(words[(i * 5 + k * (1 + i % 6)) % len(words)] for k in range(3 + i % 9)), ("en", "de", "fr", "es")[i % 4]) for i in range(240)]
    folder = tmp_path_factory.mktemp("digits")
    spark.createDataFrame(texts, "doc_id long, text string, lang string").write.parquet(str(folder / "documents.parquet"))
    return str(folder)


@pytest.mark.parametrize("name", ["token_arrays", "blocking_key_table", "bucket_caps", "candidate_scores", "candidates_topk"])
def test_like_its_sql(spark, digits, name):
    assert differences(spark, name, digits) == ([], [])
