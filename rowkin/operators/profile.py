"""Profiles of tables and of the truth (P1-P10) and normalization quality (A1): aggregates, one job a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Texts that count as missing, case-sensitive: fixed values.
MISSING = ["", "nan", "None", "NULL"]
PERCENTILES = {"p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99}


def missing_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, missing, pct)."""
    total = F.count("*")
    one = df.agg(total.alias("n"), *[F.count_if(F.coalesce(F.col(c).cast("string"), F.lit("")).isin(MISSING)).alias(c) for c in columns])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("missing")) for c in columns]))
    return one.select("n", rows.alias("r")).select("r.column", "r.missing", (100.0 * F.col("r.missing") / F.greatest("n", F.lit(1))).alias("pct"))


def id_counts(df: DataFrame, id_col: str = "entity_id") -> DataFrame:
    """Rows, distinct ids, duplicates."""
    return df.agg(F.count("*").alias("n_rows"), F.countDistinct(id_col).alias("unique_ids")).withColumn("duplicate_ids", F.col("n_rows") - F.col("unique_ids"))


def value_frequency(df: DataFrame, column: str) -> DataFrame:
    """P4."""
    return df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))


def _word_count(c: Column) -> Column:
    return F.size(F.filter(F.split(c, r"\s+"), lambda w: w != ""))


def length_stats(df: DataFrame, columns: list[str], chunk_rows: int | None = None, first_rows: int = 50_000, most_rows: int = 300_000, ordinal: str = "ord") -> DataFrame:
    """P5: exact statistics of lengths in characters and words: (column, measure, n, min, max, mean, p25, median, p75, p95, p99).

    chunk_rows (P6): only the first first_rows of each chunk of so many rows, until most_rows are reached, which is
    what a sampling profiler sees.
    """
    if chunk_rows is not None:
        chunk = F.floor(F.col(ordinal) / chunk_rows)
        df = df.filter((F.pmod(F.col(ordinal), F.lit(chunk_rows)) < first_rows) & (chunk * first_rows < most_rows))
    measures = []
    for c in columns:
        text = F.coalesce(F.col(c).cast("string"), F.lit(""))
        measures += [F.struct(F.lit(c).alias("column"), F.lit(m).alias("measure"), v.cast("bigint").alias("v")) for m, v in (("chars", F.length(text)), ("words", _word_count(text)))]
    long = df.select(F.explode(F.array(*measures)).alias("m")).select("m.*")
    q = F.percentile("v", F.array(*[F.lit(p) for p in PERCENTILES.values()])).alias("q")
    out = long.groupBy("column", "measure").agg(F.count("*").alias("n"), F.min("v").alias("min"), F.max("v").alias("max"), F.avg("v").alias("mean"), q)
    return out.select("column", "measure", "n", "min", "max", "mean", *[F.col("q")[i].alias(k) for i, k in enumerate(PERCENTILES)])


def samples(df: DataFrame, n: int = 5, ordinal: str = "ord") -> DataFrame:
    """The first n rows."""
    return df.orderBy(ordinal).limit(n)


def memory_estimate(size_bytes: int, factor: float = 1.25) -> float:
    """P7."""
    return size_bytes * factor


def profile_source(df: DataFrame, text_columns: list[str], category: str = "country", id_col: str = "entity_id") -> dict[str, DataFrame]:
    """A table's profiles, each lazy."""
    out = {"ids": id_counts(df, id_col), "missing": missing_counts(df, df.columns), "lengths": length_stats(df, text_columns)}
    return out | {"frequency": value_frequency(df, category)} if category in df.columns else out


def profile_truth(lists: DataFrame, s1: DataFrame, s2: DataFrame, s3: DataFrame) -> DataFrame:
    """One row. lists: (s1_id, ids: array, repetitions kept); s1, s2, s3: entity_id."""
    n = F.size("ids")
    per = lists.agg(
        F.count("*").alias("n_rows"),
        F.countDistinct("s1_id").alias("unique_s1"),
        *[F.count_if(n == k).alias(f"matches_{k}") for k in range(3)],
        F.count_if(n >= 3).alias("matches_3plus"),
        F.sum(n).alias("pairs"),
        F.avg(n).alias("mean_matches"),
        F.percentile(n, F.lit(0.5)).alias("median_matches"),
        F.max(n).alias("max_matches"),
    )
    ids = lists.select(F.explode("ids").alias("id"))
    known = s2.select("entity_id").unionByName(s3.select("entity_id")).distinct().select(F.col("entity_id").alias("id"), F.lit(1).alias("known"))
    ids = ids.join(known, "id", "left")
    of = {s: F.col("id").startswith(f"{s}-") for s in ("S1", "S2", "S3")}
    seen = ids.agg(
        F.countDistinct(F.when(of["S2"], F.col("id"))).alias("unique_s2"),
        F.countDistinct(F.when(of["S3"], F.col("id"))).alias("unique_s3"),
        F.count_if(of["S1"]).alias("self_matches"),
        F.count_if(~of["S1"] & F.col("known").isNull()).alias("unknown_ids"),
    )
    listed, source = lists.select("s1_id").distinct(), s1.select(F.col("entity_id").alias("s1_id")).distinct()
    sets = source.join(listed, "s1_id", "left_anti").agg(F.count("*").alias("s1_without_row"))
    sets = sets.join(F.broadcast(listed.join(source, "s1_id", "left_anti").agg(F.count("*").alias("rows_without_s1"))))
    out = per.join(F.broadcast(seen)).join(F.broadcast(sets))
    return out.withColumn("duplicate_s1", F.col("n_rows") - F.col("unique_s1"))


def normalization_quality(df: DataFrame, original: str = "business_name", normalized: str = "name_n") -> DataFrame:
    """A1 for one column: one row. Collisions are normalized texts that several distinct originals share."""
    o = F.coalesce(F.col(original), F.lit(""))
    per = df.select(o.alias("o"), F.col(normalized).alias("n"))
    groups = per.groupBy("n").agg(F.countDistinct("o").alias("k")).agg(F.count_if(F.col("k") > 1).alias("collisions"))
    out = per.agg(
        F.count("*").alias("records"),
        F.countDistinct("o").alias("unique_original"),
        F.countDistinct("n").alias("unique_normalized"),
        F.count_if(F.col("o") != F.col("n")).alias("changed"),
        F.count_if(F.col("n") == "").alias("empty"),
    )
    out = out.withColumns({f"{c}_pct": 100.0 * F.col(c) / F.greatest("records", F.lit(1)) for c in ("changed", "empty")})
    return out.join(F.broadcast(groups))


def as_table(spark, report: dict) -> DataFrame:
    """P10: a report as (key, value) rows for display; nested keys are joined by dots."""

    def flat(prefix: str, x):
        for k, v in x.items():
            if isinstance(v, dict):
                yield from flat(f"{prefix}{k}.", v)
            else:
                yield f"{prefix}{k}", str(v)

    return spark.createDataFrame(list(flat("", report)), "key string, value string")
