"""One broken file per rule."""

import pytest

from rowkin.operators import validate

HEAD = "source1_entity_id\tmatched_entity_ids"
CASES = {
    "V1": "",
    "V2": "source1_entity_id,matched_entity_ids\nS1-1,S2-1\n",
    "V3": "id\tmatched_entity_ids\nS1-1\tS2-1\n",
    "V4": f"{HEAD}\nS1-1\tS2-1\nS1-2\n",
    "V5": f"{HEAD}\nS1-1\tS2-1\nS1-1\t\nS1-2\t\n",
    "V6": f"{HEAD}\nS1-1\tS2-1,S2-1\nS1-2\t\n",
    "V7": f"{HEAD}\nS1-1\tS1-2\nS1-2\t\n",
    "V8": f"{HEAD}\nS1-1\tS2-1, S3-1\nS1-2\t\n",
    "V9": f"{HEAD}\nS1-1\tS2-9\nS1-2\t\n",
    "V10": f"{HEAD}\nS1-1\t\n",
    "V11": f"{HEAD}\nS1-1\t\nS1-2\t\nS1-9\t\n",
}


@pytest.fixture
def known(spark):
    required = spark.createDataFrame([("S1-1",), ("S1-2",)], "s1_id string")
    return required, spark.createDataFrame([("S2-1",), ("S3-1",)], "entity_id string")


@pytest.mark.parametrize("rule", CASES)
def test_each_rule(spark, known, tmp_path, rule):
    (tmp_path / "m.tsv").write_text(CASES[rule])
    report = validate.validate_files(spark, str(tmp_path / "m.tsv"), known[0], targets=known[1])
    assert report.exit_code == 1 and any(e.startswith(rule + " ") for e in report.errors), report


def test_good_and_missing_files(spark, known, tmp_path):
    (tmp_path / "m.tsv").write_text(f"{HEAD}\nS1-1\tS2-1,S3-1\n\nS1-2\t\n")
    (tmp_path / "c.tsv").write_text("source1_entity_id\tcandidate_entity_ids\nS1-1\tS2-1,S3-1\nS1-2\t\n")
    report = validate.validate_files(spark, str(tmp_path / "m.tsv"), known[0], str(tmp_path / "c.tsv"), known[1])
    assert report.ok and not report.warnings
    assert not validate.validate_files(spark, str(tmp_path / "none.tsv"), known[0]).ok


def test_match_outside_candidates_warns(spark, known, tmp_path):
    (tmp_path / "m.tsv").write_text(f"{HEAD}\nS1-1\tS3-1\nS1-2\t\n")
    (tmp_path / "c.tsv").write_text("source1_entity_id\tcandidate_entity_ids\nS1-1\tS2-1\nS1-2\t\n")
    report = validate.validate_files(spark, str(tmp_path / "m.tsv"), known[0], str(tmp_path / "c.tsv"), known[1])
    assert report.ok and any(w.startswith("V12") for w in report.warnings)


def test_ids_of_first_column(spark, tmp_path):
    (tmp_path / "s.tsv").write_text("entity_id\tbusiness_name\n S2-1 \tx\nS2-2\ty\n")
    assert {r[0] for r in validate.read_ids(spark, str(tmp_path / "s.tsv")).collect()} == {"S2-1", "S2-2"}
