"""The plans of section 3: train, infer, evaluate blocking, verify thresholds, profile."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowkin.config import LinkageConfig
from rowkin.functions.normalize import normalize_table
from rowkin.functions.tokens import with_tokens
from rowkin.operators import blocking, evaluate, features, models, profile, splits
from rowkin.sources import sinks


def prepared(df: DataFrame, ascii_only: bool = False) -> DataFrame:
    """Normalized and tokenized records, persisted: blocking and features both read them, the Arrow function runs once."""
    return with_tokens(normalize_table(df, ascii_only)).persist(StorageLevel.MEMORY_AND_DISK)


@dataclass
class Prepared:
    s1: DataFrame
    targets: DataFrame
    candidates: DataFrame

    def features(self, keep: tuple[str, ...] = ("s1_id", "cand_id")) -> DataFrame:
        return features.pair_features(features.paired(self.candidates.select("s1_id", "cand_id"), self.s1, self.targets), keep)


def prepare(s1: DataFrame, s2: DataFrame, s3: DataFrame, config: LinkageConfig, ascii_only: bool = False) -> Prepared:
    """One scan of each table; country is part of the join key, so every S1 row takes part, also one without a country."""
    a, t = prepared(s1, ascii_only), prepared(blocking.targets_in_order(s2, s3), ascii_only)
    pairs = blocking.candidates(a, t, config.blocking).persist(StorageLevel.MEMORY_AND_DISK)
    return Prepared(a, t, pairs)


def train(s1: DataFrame, s2: DataFrame, s3: DataFrame, truth_pairs: DataFrame, config: LinkageConfig | None = None, trees: bool = True, rounds: int = 200, ascii_only: bool = False) -> dict:
    """Fit both classifiers on the training entities, choose a threshold on the tuning ones, report on the test ones."""
    config = config or LinkageConfig()
    p = prepare(s1, s2, s3, config, ascii_only)
    data = features.labelled(p.features(), truth_pairs).withColumn("part", splits.three_way(seed=config.seed)).persist(StorageLevel.MEMORY_AND_DISK)
    learn = data.filter("part = 'train'")
    ids = p.s1.select(F.col("entity_id").alias("s1_id")).withColumn("part", splits.three_way(seed=config.seed))
    out: dict = {"features": data, "models": {}, "reports": {}, "prepared": p}
    kinds = {"logistic": models.logistic_regression(n=learn.count())} | ({"trees": models.boosted_trees(rounds=rounds, seed=config.seed)} if trees else {})
    for name, pipeline in kinds.items():
        model = models.fit(pipeline, learn)
        scored = models.with_probability(model, data.filter("part <> 'train'")).select("s1_id", "cand_id", "label", "part", "p").persist(StorageLevel.MEMORY_AND_DISK)
        tune, test = (ids.filter(F.col("part") == x).select("s1_id") for x in ("tune", "test"))
        best = evaluate.best_threshold(evaluate.threshold_sweep(scored.filter("part = 'tune'"), tune, truth_pairs.join(tune, "s1_id", "left_semi"), config.thresholds, config.beta)).first()
        threshold = best["threshold"] if best else config.threshold
        of_test = scored.filter("part = 'test'")
        counts = evaluate.entity_counts(evaluate.matched(of_test, threshold), test, truth_pairs.join(test, "s1_id", "left_semi"))
        out["models"][name] = model
        out["reports"][name] = {
            "threshold": threshold,
            "macro": evaluate.macro_scores(counts, config.beta).first().asDict(),
            "pairs": evaluate.pair_scores(of_test, F.col("p") >= threshold, beta=config.beta).first().asDict(),
            "importances": models.importances(model),
        }
        scored.unpersist()
    return out


def infer(model: PipelineModel, s1: DataFrame, s2: DataFrame, s3: DataFrame, config: LinkageConfig | None = None, threshold: float | None = None, ascii_only: bool = False, one_to_one: bool = False) -> dict[str, DataFrame]:
    """Candidates and matches of every S1 row, and their summary."""
    config = config or LinkageConfig()
    p = prepare(s1, s2, s3, config, ascii_only)
    scored = models.with_probability(model, p.features()).select("s1_id", "cand_id", "p")
    matches = scored.filter(F.col("p") >= (config.threshold if threshold is None else threshold))
    matches = (evaluate.best_anchor(matches) if one_to_one else matches).select("s1_id", "cand_id")
    ids = s1.select(F.col("entity_id").alias("s1_id"))
    return {"candidates": p.candidates, "matches": matches, "summary": evaluate.match_summary(matches, ids), "by_source": evaluate.candidates_by_source(p.candidates), "s1_ids": ids}


def write_results(result: dict[str, DataFrame], candidates_path: str, matches_path: str) -> None:
    """Two list files with a row per S1 id."""
    sinks.write_candidates(result["candidates"], result["s1_ids"], candidates_path)
    sinks.write_matches(result["matches"], result["s1_ids"], matches_path)


def evaluate_blocking(s1: DataFrame, s2: DataFrame, s3: DataFrame, truth_pairs: DataFrame, config: LinkageConfig | None = None, ascii_only: bool = False) -> dict[str, DataFrame]:
    """Normalization quality per source and blocking recall."""
    config = config or LinkageConfig()
    p = prepare(s1, s2, s3, config, ascii_only)
    ids = s1.select(F.col("entity_id").alias("s1_id"))
    out = {"recall": blocking.blocking_recall(p.candidates, ids, truth_pairs, p.s1.count() * p.targets.count())}
    for name, df in (("s1", p.s1), ("targets", p.targets)):
        out |= {f"{name}_{k}": profile.normalization_quality(df, o, n) for k, o, n in (("names", "business_name", "name_n"), ("addresses", "business_address", "addr_n"))}
    return out


def verify_threshold(model: PipelineModel, feature_table: DataFrame, s1_ids: DataFrame, truth_pairs: DataFrame, config: LinkageConfig | None = None) -> dict[str, DataFrame]:
    """A fine sweep over held-out entities and a breakdown by true matches at its best threshold."""
    config = config or LinkageConfig()
    held = feature_table.filter(splits.is_held_out(percent=config.validation_pct, seed=config.seed))
    ids = s1_ids.filter(splits.is_held_out(percent=config.validation_pct, seed=config.seed))
    true = truth_pairs.join(ids, "s1_id", "left_semi")
    scored = models.with_probability(model, held).select("s1_id", "cand_id", "p").persist(StorageLevel.MEMORY_AND_DISK)
    sweep = evaluate.threshold_sweep(scored, ids, true, config.fine_thresholds, config.beta)
    best = evaluate.best_threshold(sweep).first()
    counts = evaluate.entity_counts(evaluate.matched(scored, best["threshold"]), ids, true)
    return {"sweep": sweep, "breakdown": evaluate.by_cardinality(counts, config.beta)}
