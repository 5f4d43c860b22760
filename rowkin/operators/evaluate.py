"""Metrics per entity and per pair, threshold sweeps and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def entity_counts(predicted: DataFrame, s1_ids: DataFrame, truth_pairs: DataFrame) -> DataFrame:
    """(s1_id, n_pred, n_true, n_both) for every id of s1_ids; predictions for other ids are left out."""
    p = predicted.select("s1_id", "cand_id").distinct().withColumn("p", F.lit(1))
    t = truth_pairs.select("s1_id", "cand_id").distinct().withColumn("t", F.lit(1))
    both = p.join(t, ["s1_id", "cand_id"], "full_outer")
    n = both.groupBy("s1_id").agg(F.count("p").alias("n_pred"), F.count("t").alias("n_true"), F.count(F.col("p") + F.col("t")).alias("n_both"))
    return s1_ids.select("s1_id").distinct().join(n, "s1_id", "left").na.fill(0)


def f_beta(p: Column, r: Column, beta: float) -> Column:
    return F.coalesce(F.try_divide((1 + beta * beta) * p * r, beta * beta * p + r), F.lit(0.0))


def entity_scores(counts: DataFrame, beta: float = 0.5) -> DataFrame:
    """Adds precision, recall, f. Nothing true and nothing predicted is perfect; nothing on one side only is nil."""
    empty = (F.col("n_true") == 0) & (F.col("n_pred") == 0)
    part = lambda n: F.when(empty, 1.0).otherwise(F.coalesce(F.try_divide("n_both", n), F.lit(0.0)))
    out = counts.withColumns({"precision": part("n_pred"), "recall": part("n_true")})
    return out.withColumn("f", f_beta(F.col("precision"), F.col("recall"), beta))


def _macro() -> list[Column]:
    single = F.col("n_true") == 0
    return [
        F.avg("f").alias("macro_f"),
        F.avg("precision").alias("macro_precision"),
        F.avg("recall").alias("macro_recall"),
        F.count("*").alias("entities"),
        F.count_if(single).alias("singletons"),
        F.count_if(single & (F.col("n_pred") == 0)).alias("singletons_right"),
    ]


def _with_accuracy(df: DataFrame) -> DataFrame:
    return df.withColumn("singleton_accuracy_pct", 100.0 * F.col("singletons_right") / F.greatest("singletons", F.lit(1)))


def macro_scores(counts: DataFrame, beta: float = 0.5) -> DataFrame:
    """One row of means over entities, unrounded."""
    return _with_accuracy(entity_scores(counts, beta).agg(*_macro()))


def pair_scores(scored: DataFrame, predicted: Column, label: Column | None = None, beta: float = 0.5) -> DataFrame:
    """Confusion counts of pairs, precision, recall, F-beta and F1; recall is of the pairs that blocking left."""
    y = F.coalesce(label if label is not None else F.col("label") == 1, F.lit(False))
    p = F.coalesce(predicted, F.lit(False))
    out = scored.agg(
        F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"), F.count("*").alias("pairs")
    )
    out = out.withColumns(
        {
            "precision": F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), F.lit(0.0)),
            "recall": F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")), F.lit(0.0)),
        }
    )
    return out.withColumns({"f_beta": f_beta(F.col("precision"), F.col("recall"), beta), "f1": f_beta(F.col("precision"), F.col("recall"), 1.0)})


def matched(scored: DataFrame, threshold: float, score: str = "p") -> DataFrame:
    """M8: (s1_id, cand_id) of pairs at or above the threshold."""
    return scored.filter(F.col(score) >= threshold).select("s1_id", "cand_id")


def best_anchor(pairs: DataFrame, score: str = "p") -> DataFrame:
    """Extension, off by default: of a target's anchors only the best-scored one, ties by the smaller id."""
    best = pairs.groupBy("cand_id").agg(F.min_by(F.struct(*pairs.columns), F.struct(-F.col(score), F.col("s1_id"))).alias("b"))
    return best.select("b.*")


def threshold_sweep(scored: DataFrame, s1_ids: DataFrame, truth_pairs: DataFrame, thresholds: tuple[float, ...], beta: float = 0.5, score: str = "p") -> DataFrame:
    """M9: macro_scores per threshold, in one pass over the pairs instead of one job a threshold.

    A pair falls in the interval between two thresholds; counts per (entity, interval) are summed from the top, so that a
    pair is one row however many thresholds it reaches.
    """
    cuts = sorted(thresholds)
    n_true = truth_pairs.select("s1_id", "cand_id").distinct().groupBy("s1_id").agg(F.count("*").alias("n_true"))
    hit = truth_pairs.select("s1_id", "cand_id").distinct().withColumn("hit", F.lit(1))
    at = F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]), lambda c: F.col(score) >= c))
    pairs = scored.select("s1_id", "cand_id", at.alias("at")).filter("at > 0").join(hit, ["s1_id", "cand_id"], "left")
    per = pairs.groupBy("s1_id").agg(
        *[F.count_if(F.col("at") > i).alias(f"p{i}") for i in range(len(cuts))],
        *[F.count(F.when(F.col("at") > i, F.col("hit"))).alias(f"b{i}") for i in range(len(cuts))],
    )
    every = s1_ids.select("s1_id").distinct().join(n_true, "s1_id", "left").join(per, "s1_id", "left").na.fill(0)
    rows = F.explode(F.array(*[F.struct(F.lit(float(c)).alias("threshold"), F.col(f"p{i}").alias("n_pred"), F.col(f"b{i}").alias("n_both")) for i, c in enumerate(cuts)]))
    long = every.select("s1_id", "n_true", rows.alias("r")).select("s1_id", "n_true", "r.*")
    return _with_accuracy(entity_scores(long, beta).groupBy("threshold").agg(*_macro()))


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The sweep's row with the best macro F; of equal ones the lowest threshold."""
    return sweep.orderBy(F.desc("macro_f"), "threshold").limit(1)


def by_cardinality(counts: DataFrame, beta: float = 0.5) -> DataFrame:
    """E5: entities by number of true matches (0, 1, 2+): share, exact and false-positive rates, means."""
    group = F.when(F.col("n_true") == 0, "0").when(F.col("n_true") == 1, "1").otherwise("2+")
    exact = (F.col("n_pred") == F.col("n_true")) & (F.col("n_both") == F.col("n_true"))
    out = entity_scores(counts, beta).groupBy(group.alias("true_matches")).agg(
        F.count("*").alias("entities"),
        (100.0 * F.avg(exact.cast("int"))).alias("exact_pct"),
        (100.0 * F.avg((F.col("n_pred") > F.col("n_both")).cast("int"))).alias("false_positive_pct"),
        F.avg("f").alias("mean_f"),
        F.avg("precision").alias("mean_precision"),
        F.avg("recall").alias("mean_recall"),
    )
    total = counts.agg(F.count("*").alias("_n"))
    return out.join(F.broadcast(total)).withColumn("share_pct", 100.0 * F.col("entities") / F.col("_n")).drop("_n")


def class_balance(labelled: DataFrame) -> DataFrame:
    """E6."""
    total = labelled.agg(F.count("*").alias("_n"))
    n = labelled.groupBy("label").agg(F.count("*").alias("pairs"))
    return n.join(F.broadcast(total)).withColumn("pct", 100.0 * F.col("pairs") / F.col("_n")).drop("_n")


def match_summary(matches: DataFrame, s1_ids: DataFrame) -> DataFrame:
    """How many anchors have no, one and several matches, and averages."""
    n = matches.groupBy("s1_id").agg(F.count("*").alias("n"))
    per = s1_ids.select("s1_id").distinct().join(n, "s1_id", "left").na.fill(0)
    out = per.agg(
        F.count("*").alias("entities"),
        F.sum("n").alias("matches"),
        F.count_if(F.col("n") == 0).alias("none"),
        F.count_if(F.col("n") == 1).alias("single"),
        F.count_if(F.col("n") > 1).alias("multiple"),
        F.avg("n").alias("mean_matches"),
    )
    return out.withColumns({f"{c}_pct": 100.0 * F.col(c) / F.greatest("entities", F.lit(1)) for c in ("none", "single", "multiple")})


def candidates_by_source(pairs: DataFrame) -> DataFrame:
    """E8."""
    return pairs.groupBy(F.substring("cand_id", 1, 2).alias("source")).agg(F.count("*").alias("pairs"))
