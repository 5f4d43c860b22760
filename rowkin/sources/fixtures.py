"""Linkage tables with known truth, made from the `documents` table.

Names and streets are words from the beginning, the middle and the end of each whole text, accents and all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_SQL = """
WITH base AS (
  SELECT doc_id, upper(lang) AS lang, {split}(trim({replace}), ' ') AS w FROM {documents}),
sized AS (SELECT *, CAST({size}(w) AS BIGINT) AS n FROM base),
clean AS (
  SELECT doc_id, CASE lang WHEN 'EN' THEN 'US' WHEN 'FR' THEN 'France' ELSE 'India' END AS country,
         concat_ws(' ', {w1}, {w2}, {w3}) AS nm, concat_ws(' ', {w4}, {w5}) AS street,
         CAST((doc_id * 37) % 900 + 1 AS {text}) AS house, CAST(10000 + (doc_id * 7919) % 90000 AS {text}) AS zip
  FROM sized),
s1 AS (
  SELECT concat('S1-', doc_id) AS entity_id, concat(nm, ' Inc') AS business_name,
         concat(house, ' ', street, ' Rd, ', zip) AS business_address, country, doc_id AS ord, doc_id AS truth_doc
  FROM clean),
s2 AS (
  SELECT concat('S2-', doc_id) AS entity_id,
         CASE doc_id % 6 WHEN 0 THEN concat({upper_nm}, ' Incorporated') WHEN 1 THEN concat('-- ', nm)
           WHEN 2 THEN concat(substring(nm, 1, 1), substring(nm, 3), ' Inc.') WHEN 3 THEN concat('Inc ', nm)
           WHEN 4 THEN concat(nm, ' Private Limited') ELSE concat({first}, '.com') END AS business_name,
         CASE WHEN doc_id % 30 = 7 THEN '' ELSE concat({upper_street}, ' ROAD, ', house, ', ', zip) END AS business_address,
         country, doc_id AS ord, doc_id AS truth_doc
  FROM clean WHERE doc_id % 5 <> 0),
s3 AS (
  SELECT concat('S3-', doc_id + k * 1000000) AS entity_id,
         CASE WHEN k = 1 THEN concat(nm, ' & Co') ELSE concat(nm, ' Corp.') END AS business_name,
         CASE WHEN doc_id % 30 = 11 THEN '' ELSE concat(house, '/', CAST(k + 1 AS {text}), ' ', street, ' St., ', zip) END AS business_address,
         country, doc_id + k * 1000000 AS ord, doc_id AS truth_doc
  FROM clean CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 AS k) v
  WHERE doc_id % 4 <> 0 AND (k = 0 OR doc_id % 7 = 1) AND doc_id % 20 <> 15),
entities AS (
  SELECT 'S1' AS source, * FROM s1 UNION ALL SELECT 'S2' AS source, * FROM s2 UNION ALL SELECT 'S3' AS source, * FROM s3)
"""

#: Places of the words w1..w5, from 1, in a text of n words.
_PLACES = ["1", "1 + {third}", "1 + 2 * {third}", "1 + {half}", "n"]
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
#: Only ASCII letters in upper case: engines differ on others.
_UPPER = {f"upper_{c}": f"translate({c}, '{_LETTERS}', '{_LETTERS.upper()}')" for c in ("nm", "street")}
_SPARK = dict(
    split="split",
    size="size",
    replace=r"regexp_replace(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+', ' ')",
    text="STRING",
    first="substring_index(nm, ' ', 1)",
    **{f"w{i}": f"try_element_at(w, CAST({p.format(third='(n div 3)', half='(n div 2)')} AS INT))" for i, p in enumerate(_PLACES, 1)},
    **_UPPER,
)
_DUCKDB = dict(
    split="string_split",
    size="len",
    replace=r"regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}]+', ' ', 'g')",
    text="VARCHAR",
    first="split_part(nm, ' ', 1)",
    documents="documents",
    **{f"w{i}": f"w[{p.format(third='(n // 3)', half='(n // 2)')}]" for i, p in enumerate(_PLACES, 1)},
    **_UPPER,
)

#: The fixture as a WITH clause (ending in the table `entities`) for another engine.
ORACLE_WITH = _SQL.format(**_DUCKDB)


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three sources: source, entity_id, business_name, business_address, country, ord, truth_doc."""
    sql = _SQL.format(**_SPARK, documents=f"parquet.`{sf_dir}/documents.parquet`")
    return spark.sql(f"{sql} SELECT * FROM entities")


def truth(all_entities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(s1_ids, truth_pairs) of the fixture."""
    s1 = all_entities.filter("source = 'S1'").selectExpr("entity_id AS s1_id", "truth_doc")
    others = all_entities.filter("source <> 'S1'").selectExpr("entity_id AS cand_id", "truth_doc")
    return s1.select("s1_id"), s1.join(others, "truth_doc").select("s1_id", "cand_id")
