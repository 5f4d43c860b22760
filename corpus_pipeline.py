"""A corpus pipeline of five stages over `documents`, each with one operator of rowkin.llm.

quality rules -> quality classifier -> n-gram Jaccard join -> benchmark decontamination -> mixing to target weights

Each stage takes (spark, docs, sf_dir), docs being what its predecessor kept, and returns a DataFrame; run() writes it as
Parquet in the shared folder and hands the reread table on. All stages but the last return the columns of
documents.

Every decision is one on a row, so rows with a null id or with an id that repeats are judged as any other; rows that
repeat as a whole are near duplicates of each other, and one stays. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowkin.llm import jaccard_tiles, poisson_mix, pu_quality, quality_mcd, winnow
from rowkin.llm.common import begun, removed_since, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: robust outliers of text statistics go, and texts that fail the base rule."""
    judged = quality_mcd.quality_rules(docs, keep=tuple(COLUMNS))
    return judged.filter("kept").select(COLUMNS)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that are likelier of bad quality go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    kept = tuple(c for c in COLUMNS if c != "doc_id")
    return pu_quality.quality_classifier(docs, labels, keep=kept).filter("predicted = 1").select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10, on five words and a similarity of 0.8: of each group the document with the smallest id stays."""
    rows = docs.withColumn("row", F.monotonically_increasing_id())  # docs are files: the same numbers each time
    named = rows.select(F.struct("doc_id", "row").alias("id"), "text")
    groups = jaccard_tiles.jaccard_groups(named, id_col="id", ngram=5, percent=80)
    first = groups.filter("doc_id.row = component_id.row").select("doc_id.row")
    return rows.join(first, "row", "left_semi").select(COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents that share ten words in a row, or a whole shorter item, with the benchmark go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return winnow.decontaminate(docs, benchmark, keep=tuple(COLUMNS)).filter("not contaminated").select(COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: sources mixed in equal shares, one epoch's rows, in random order."""
    return poisson_mix.poisson_mix(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing),
]

#: The classifier's fit and the groups of similar texts have no SQL form; tests hold the stages' decisions against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, first = spark.read.parquet(f"{sf_dir}/documents.parquet"), begun()
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
        removed_since(spark, first, docs)  # the stage's scratch tables and its input, which nothing reads any more
    return docs
