"""Mixing sources to target weights by Poisson replication, in DataFrame functions only.

A source with n of N rows and target weight w (of total W) is to be repeated w / W * N * epochs / n times on
average. Each row's copies are a Poisson number of that mean, found by inverting the distribution at a
uniform number that is a hash of seed and id: the same on every run, on every cluster and for every order of
rows. exp(-mean) has no double for large means: one above PART is the sum of independent Poisson numbers of equal
means of at most PART, each from a hash of its own, which has exactly the distribution wanted. Rows are exploded by their count, dealt to partitions by a hash of (seed, id, copy) and sorted by it
there, which is a uniform shuffle of the whole mix.

Scale: one partial-aggregated count per source, one join with that small table (broadcast only up to
max_broadcast sources; else a shuffled join whose hot sources adaptive execution splits), one shuffle of the
result. No group is gathered. A row takes rate / PART inversions, so their number follows the rows of the
result. The copies of one row are made in blocks of BLOCK, by the task that has the row.

Nulls and odd rows: a null source is a source of its own (target weights name it by None); a null id counts
as the empty text; rows that repeat get the same count each. A source without a target weight gets none of
the mix. The mean has no bound; copies are counted as int, as in the SQL, and a row of over 2^31 - 1 fails. `epochs`,
the mean over all rows of the mix, may be at most MOST_EPOCHS: a check of the argument, which the data don't change.
Columns named like the results are replaced. ORACLE_SQL inverts in one part: it says the same up to a mean of PART.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Largest mean that is inverted at once.
PART = 500.0
MOST_EPOCHS = 500.0
BLOCK = 100_000
#: 52 bits of a hash make the uniform number.
HEX, SCALE = 13, float(1 << 52)


def source_rates(docs: DataFrame, weights: dict | None = None, epochs: float = 1.0, source_col: str = "source") -> DataFrame:
    """(source, n, rate): one row per source. weights: by source; None: all sources alike."""
    counts = docs.groupBy(F.col(source_col).alias("source")).agg(F.count("*").alias("n"))
    if weights is None:
        counts = counts.withColumn("w", F.lit(1.0))
    else:
        if any(w < 0 for w in weights.values()):
            raise ValueError("weights are not negative")
        w = F.lit(0.0)
        for k, v in weights.items():
            w = F.when(F.col("source").eqNullSafe(F.lit(k)), F.lit(float(v))).otherwise(w)
        counts = counts.withColumn("w", w)
    total = counts.agg(F.sum("w").alias("sw"), F.sum("n").alias("sn"))
    rate = F.coalesce(F.try_divide(F.col("w") * F.col("sn") * F.lit(float(epochs)), F.col("sw") * F.col("n")), F.lit(0.0))
    return counts.join(F.broadcast(total)).select("source", "n", rate.alias("rate"))


def poisson_mix(
    docs: DataFrame,
    weights: dict | None = None,
    epochs: float = 1.0,
    seed: int = 42,
    id_col: str = "doc_id",
    source_col: str = "source",
    max_broadcast: int = 100_000,
) -> DataFrame:
    """docs, each row as often as its count, with rate, n_copies, copy (from 1) and shuffle_key."""
    if epochs > MOST_EPOCHS:
        raise ValueError(f"{epochs:g} epochs; at most {MOST_EPOCHS:g}")
    rates = source_rates(docs, weights, epochs, source_col)
    rates = rates.withColumn("_parts", F.greatest(F.ceil(F.col("rate") / PART), F.lit(1))).withColumn("_mean", F.col("rate") / F.col("_parts"))
    highest = rates.agg(F.max("_mean"), F.count("*")).first()
    most = math.ceil((highest[0] or 0.0) + 12 * math.sqrt(highest[0] or 0.0) + 30)
    step = lambda a, k: F.struct(
        (a["p"] * F.col("_mean") / k).alias("p"),
        (a["c"] + a["p"] * F.col("_mean") / k).alias("c"),
        F.array_append(a["cdf"], a["c"] + a["p"] * F.col("_mean") / k).alias("cdf"),
    )
    start = F.exp(-F.col("_mean"))
    cdf = F.aggregate(
        F.sequence(F.lit(1), F.lit(most)), F.struct(start.alias("p"), start.alias("c"), F.array(start).alias("cdf")), step, lambda a: a["cdf"]
    )
    table = rates.select(F.col("source").alias("_s"), "rate", "_parts", cdf.alias("_cdf"))
    table = F.broadcast(table) if highest[1] <= max_broadcast else table
    docs = docs.drop("rate", "n_copies", "copy", "shuffle_key", "_s", "_cdf", "_parts", "_block")
    the_id = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    number = lambda *c: F.conv(F.substring(F.md5(F.concat_ws(":", *c).cast("binary")), 1, HEX), 16, 10).cast("bigint")
    hashed = lambda *c: number(F.lit(str(seed)), the_id, *c)
    uniform = lambda part: F.when(part == 1, hashed()).otherwise(number(F.lit(f"{seed}:part"), part.cast("string"), the_id)).cast("double") / F.lit(SCALE)
    counted = docs.join(table, F.col(source_col).eqNullSafe(F.col("_s")))
    below = lambda part: F.aggregate(
        "_cdf",
        F.struct(uniform(part).alias("u"), F.lit(0).alias("n")),  # the hash is taken once a part
        lambda a, c: F.struct(a["u"].alias("u"), (a["n"] + (c <= a["u"]).cast("int")).alias("n")),
        lambda a: a["n"],
    )
    total = F.aggregate(F.sequence(F.lit(1).cast("bigint"), F.col("_parts")), F.lit(0), lambda n, part: n + below(part))
    counted = counted.withColumn("n_copies", total).drop("_cdf", "_s", "_parts")
    blocks = counted.filter("n_copies > 0").withColumn("_block", F.explode(F.sequence(F.lit(0), F.expr(f"cast((n_copies - 1) div {BLOCK} as int)"))))
    first, left = F.col("_block") * BLOCK, F.col("n_copies") - F.col("_block") * BLOCK
    copies = blocks.withColumn("copy", F.explode(F.transform(F.sequence(F.lit(1), F.least(F.lit(BLOCK), left)), lambda k: first + k))).drop("_block")
    keyed = copies.withColumn("shuffle_key", hashed(F.col("copy").cast("string")))
    return keyed.repartition("shuffle_key").sortWithinPartitions("shuffle_key")


ORACLE_SQL = r"""
WITH RECURSIVE counts AS (
  SELECT source, count(*) AS n FROM documents GROUP BY source),
rates AS (
  SELECT source, 1.0::DOUBLE * (SELECT sum(n)::DOUBLE FROM counts) * 1.0::DOUBLE / ((SELECT count(*)::DOUBLE FROM counts) * n) AS rate
  FROM counts),
most AS (SELECT ceil(max(rate) + 12 * sqrt(max(rate)) + 30)::INT AS k FROM rates),
cdf AS (
  SELECT source, rate, 0 AS k, exp(-rate) AS p, exp(-rate) AS c FROM rates
  UNION ALL
  SELECT source, rate, k + 1, p * rate / (k + 1), c + p * rate / (k + 1) FROM cdf WHERE k < (SELECT k FROM most)),
table_of AS (SELECT source, rate, list(c ORDER BY k) AS cdf FROM cdf GROUP BY source, rate),
hashed AS (
  SELECT *, ('0x' || substr(md5('42:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS u
  FROM documents),
counted AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, t.rate, len(list_filter(t.cdf, lambda x: x <= d.u))::INT AS n_copies
  FROM hashed d JOIN table_of t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, text, lang, source, n_chars, round(rate, 6) AS rate, n_copies, copy::INT AS copy,
       ('0x' || substr(md5('42:' || coalesce(doc_id::VARCHAR, '') || ':' || copy::VARCHAR), 1, 13))::BIGINT AS shuffle_key
FROM (SELECT *, unnest(generate_series(1, n_copies)) AS copy FROM counted WHERE n_copies > 0)
"""
