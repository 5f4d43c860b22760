"""The queries of this package's operators, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import jaccard_tiles, license_scan, poisson_mix, ppm, pu_quality, quality_mcd, toxicity, url_cascade, warc, winnow
from .common import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_segment_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.toxicity(docs, _table(spark, sf_dir, "labels")).drop("segments")


def op2_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.ppm_score(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return url_cascade.url_filter(pages, url_cascade.RULES).select("page_id", "host", "path", "rule", "verdict")


def op4_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pu_quality.quality_classifier(docs, _table(spark, sf_dir, "labels"))


def op5_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return poisson_mix.poisson_mix(_table(spark, sf_dir, "documents")).withColumn("rate", F.round("rate", 6))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    path = scratch_path(spark, "warc")
    warc.write_warc(pages, path)
    merged = warc.merge_index(warc.read_warc(spark, path))
    numbers = {c: F.expr(f"try_cast({c} as bigint)") for c in ("page_id", "refers_to")}
    return merged.withColumns(numbers).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return license_scan.license_scan(docs)


def op8_winnow(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return winnow.decontaminate(docs, _table(spark, sf_dir, "benchmark"), keep=("doc_id",)).drop("spans")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    out = quality_mcd.quality_rules(docs, keep=("doc_id",))
    return out.select("doc_id", *quality_mcd.STATS, "base_failed", "kept")


def op10_jaccard_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_tiles.jaccard_groups(_table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_segment_toxicity": op1_segment_toxicity,
    "op2_ppm": op2_ppm,
    "op3_url_cascade": op3_url_cascade,
    "op4_pu_quality": op4_pu_quality,
    "op5_poisson_mix": op5_poisson_mix,
    "op6_warc": op6_warc,
    "op7_license_scan": op7_license_scan,
    "op8_winnow": op8_winnow,
    "op9_quality_rules": op9_quality_rules,
    "op10_jaccard_tiles": op10_jaccard_tiles,
}

ORACLES: dict[str, str] = {
    "op3_url_cascade": url_cascade.ORACLE_SQL,
    "op5_poisson_mix": poisson_mix.ORACLE_SQL,
    "op6_warc": warc.ORACLE_SQL,
}
