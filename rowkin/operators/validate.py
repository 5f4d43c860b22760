"""Checks of the two list files that a linkage run writes.

A file is read as text, one record per line, so that every malformed line is seen. findings() are DataFrame
operations; validate_files() adds the checks of headers and of presence and returns messages.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MATCH_HEADER = ["source1_entity_id", "matched_entity_ids"]
CANDIDATE_HEADER = ["source1_entity_id", "candidate_entity_ids"]

#: What each rule means.
RULES = {
    "V4": "line without a tab",
    "V5": "id with several rows",
    "V6": "id repeated in a list",
    "V7": "match with a record of the same source",
    "V8": "id of an unknown form",
    "V9": "id that no source has",
    "V10": "required id without a row",
    "V11": "row of an id that isn't required",
    "V12": "match that isn't a candidate",
}


def parsed_lines(lines: DataFrame) -> DataFrame:
    """(value, s1_id, raw, bad) of the non-blank lines below the header; list members aren't trimmed."""
    rows = lines.filter(F.trim(F.regexp_replace("value", r"[\t\r]", " ")) != "")
    bad = F.instr("value", "\t") == 0
    cut = F.split(F.regexp_replace("value", r"[\r\n]+$", ""), "\t")
    return rows.select("value", F.trim(cut[0]).alias("s1_id"), F.coalesce(F.get(cut, F.lit(1)), F.lit("")).alias("raw"), bad.alias("bad"))


def listed(rows: DataFrame) -> DataFrame:
    """(s1_id, ids) of well-formed rows."""
    ids = F.when(F.trim("raw") == "", F.array().cast("array<string>")).otherwise(F.split("raw", ","))
    return rows.filter("not bad").select("s1_id", ids.alias("ids"))


def findings(rows: DataFrame, required: DataFrame, targets: DataFrame | None = None, candidates: DataFrame | None = None, examples: int = 5) -> DataFrame:
    """(rule, severity, offenders, examples) of the rules that are broken.

    rows: of parsed_lines. required: s1_id. targets: entity_id of all known records (V9). candidates: (s1_id, ids) (V12).
    Examples are the smallest offenders, found by a bounded top-n per rule and never by collecting all.
    """
    lists = listed(rows)
    flat = lists.select("s1_id", F.explode("ids").alias("id"))
    own, form = F.col("id").startswith("S1-"), F.col("id").rlike("^S[23]-")
    seen = lists.select("s1_id").distinct()
    parts = {
        "V4": rows.filter("bad").select(F.col("value").alias("x")),
        "V5": lists.groupBy("s1_id").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("s1_id").alias("x")),
        "V6": lists.filter(F.size("ids") != F.size(F.array_distinct("ids"))).select(F.col("s1_id").alias("x")),
        "V7": flat.filter(own).select(F.concat_ws(" ", "s1_id", "id").alias("x")),
        "V8": flat.filter(~own & ~form).select(F.concat_ws(" ", "s1_id", "id").alias("x")),
        "V10": required.select("s1_id").distinct().join(seen, "s1_id", "left_anti").select(F.col("s1_id").alias("x")),
        "V11": seen.join(required.select("s1_id"), "s1_id", "left_anti").select(F.col("s1_id").alias("x")),
    }
    if targets is not None:
        known = targets.select(F.col("entity_id").alias("id")).distinct()
        parts["V9"] = flat.filter(form).join(known, "id", "left_anti").select(F.concat_ws(" ", "s1_id", "id").alias("x"))
    if candidates is not None:
        some = candidates.select("s1_id", F.col("ids").alias("c"))
        joined = lists.join(some, "s1_id", "left")
        outside = F.size(F.array_except("ids", F.coalesce("c", F.array().cast("array<string>")))) > 0
        parts["V12"] = joined.filter(outside).select(F.col("s1_id").alias("x"))
    every = None
    for rule, df in parts.items():
        part = df.select(F.lit(rule).alias("rule"), "x")
        every = part if every is None else every.unionByName(part)
    counted = every.groupBy("rule").agg(F.count("*").alias("offenders"))
    first = None
    for rule, df in parts.items():
        part = df.distinct().orderBy("x").limit(examples).agg(F.array_sort(F.collect_list("x")).alias("examples")).withColumn("rule", F.lit(rule))
        first = part if first is None else first.unionByName(part)
    severity = F.when(F.col("rule") == "V12", "warning").otherwise("error")
    return counted.join(first, "rule").select("rule", severity.alias("severity"), "offenders", "examples")


@dataclass
class Report:
    errors: list[str] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)

    @property
    def ok(self) -> bool:
        return not self.errors

    @property
    def exit_code(self) -> int:
        """V16."""
        return int(bool(self.errors))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """entity_id, the trimmed first column below the header."""
    lines = _body(spark, path)
    return lines.select(F.trim(F.split("value", "\t")[0]).alias("entity_id")).filter("entity_id <> ''").distinct()


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).withColumn("_at", F.struct(F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("m")))


def _body(spark: SparkSession, path: str) -> DataFrame:
    """Lines without the header: the first line of each file."""
    lines = _lines(spark, path)
    heads = lines.groupBy("_at.f").agg(F.min("_at").alias("_at"))
    return lines.join(heads.select("_at"), "_at", "left_anti").drop("_at")


def _header(spark: SparkSession, path: str) -> str | None:
    first = _lines(spark, path).orderBy("_at").limit(1).collect()
    return first[0]["value"].lstrip("﻿") if first else None


def _check_header(spark: SparkSession, path: str, expected: list[str], report: Report) -> bool:
    """V1-V3, and V16 for the encoding."""
    try:
        head = _header(spark, path)
    except PySparkException as e:
        report.errors.append(f"V1 {path}: can't be read ({type(e).__name__})")
        return False
    broken = _lines(spark, path).filter(~F.is_valid_utf8("value")).count()
    if broken:
        report.errors.append(f"V16 {path}: {broken} lines aren't UTF-8")
        return False
    if head is None:
        report.errors.append(f"V1 {path}: empty")
    elif "\t" not in head and "," in head:
        report.errors.append(f"V2 {path}: separated by commas, not tabs")
    elif [c.strip().lower() for c in head.split("\t")] != expected:
        report.errors.append(f"V3 {path}: header {head!r}")
    else:
        return True
    return False


def validate_files(spark: SparkSession, matches: str, required: DataFrame, candidates: str | None = None, targets: DataFrame | None = None) -> Report:
    """V1-V17 on files; required: s1_id, targets: entity_id (None: ids aren't checked, V13)."""
    report = Report()
    if targets is None:
        report.warnings.append("V13 ids aren't checked against the sources")
    lists = None
    if candidates is None:
        report.warnings.append("V13 no candidate file")
    elif _check_header(spark, candidates, CANDIDATE_HEADER, report):
        rows = parsed_lines(_body(spark, candidates))
        lists = listed(rows)
        _add(report, findings(rows, required, targets), candidates)
    if _check_header(spark, matches, MATCH_HEADER, report):
        _add(report, findings(parsed_lines(_body(spark, matches)), required, targets, lists), matches)
    return report


def _add(report: Report, found: DataFrame, path: str) -> None:
    for r in found.orderBy("rule").collect():  # at most one row a rule
        text = f"{r['rule']} {path}: {r['offenders']} x {RULES[r['rule']]}, as {', '.join(r['examples'])}"
        (report.errors if r["severity"] == "error" else report.warnings).append(text)
