"""The plans from end to end on the smallest tables."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rowkin.config import LinkageConfig
from rowkin.operators import validate
from rowkin.plans import linkage
from rowkin.sources import fixtures
from rowkin.streaming import incremental

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="needs the test tables")


def test_train_infer_validate(spark, tmp_path):
    raw = fixtures.entities(spark, SF).cache()
    ids, truth = fixtures.truth(raw)
    s1, s2, s3 = (raw.filter(F.col("source") == s).drop("truth_doc") for s in ("S1", "S2", "S3"))
    out = linkage.train(s1, s2, s3, truth, trees=False)
    report = out["reports"]["logistic"]
    assert report["macro"]["macro_f"] > 0.7 and len(report["importances"]) == 31
    result = linkage.infer(out["models"]["logistic"], s1, s2, s3, threshold=report["threshold"])
    linkage.write_results(result, str(tmp_path / "c"), str(tmp_path / "m"))
    found = validate.validate_files(spark, str(tmp_path / "m"), ids, str(tmp_path / "c"), raw.select("entity_id"))
    assert found.ok and not found.warnings, found
    checked = linkage.verify_threshold(out["models"]["logistic"], out["features"], ids, truth)
    assert checked["sweep"].count() == 10 and checked["breakdown"].count() >= 2
    recall = linkage.evaluate_blocking(s1, s2, s3, truth)["recall"].first()
    assert recall["recall_pct"] > 90 and recall["reduction_pct"] > 50
    s2.drop("source").limit(40).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(s2.drop("source").schema).parquet(str(tmp_path / "in"))
    config = LinkageConfig(threshold=report["threshold"])
    incremental.match_stream(stream, out["prepared"].s1, out["models"]["logistic"], str(tmp_path / "hits"), str(tmp_path / "ck"), config).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "hits")).count() > 10


def test_entry_point_without_optional_parts(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 200
    assert set(entry.oracle_sql()) <= set(entry.queries())
