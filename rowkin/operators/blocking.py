"""Candidate generation by weighted, capped key agreement (B1-B7, B9-B15) and its recall.

Keys are a bag: a repeated token is a repeated key, on both sides, so its weight and its share of a bucket multiply.
Buckets larger than their cap are left out before the join, which bounds what a skewed key can produce; the exact
name has no cap, and its hot buckets are left to adaptive skew-join splitting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rowkin.config import BlockingConfig
from rowkin.functions.tokens import STOPWORDS, distinctive_tokens, first_word, numbers, postal_codes

#: Keys per strategy, in the order in which ties of score are broken.
STRATEGIES = ("B1", "B2", "B3", "B4", "B5", "B6", "B7")


def blocking_keys(df: DataFrame, carry: tuple[str, ...] = ("ord",), ascii_digits: bool = False) -> DataFrame:
    """One row a key: entity_id, country_n, strategy, key, pos (number of the key within its record), carried columns.

    df has entity_id, name_n, addr_n, country_n. One narrow pass, no union of scans. ascii_digits: as for numbers().
    """
    name = F.col("name_n")
    word = first_word(name)
    stop = F.array(*[F.lit(w) for w in STOPWORDS])
    name_tokens, addr_tokens = distinctive_tokens(name), distinctive_tokens(F.col("addr_n"))
    nums = numbers(F.col("addr_n"), longest=10, ascii_digits=ascii_digits)
    none = F.array().cast("array<string>")
    keys = {
        "B1": F.when(name != "", F.array(name)).otherwise(none),
        "B2": F.when((F.length(word) >= 4) & ~F.array_contains(stop, word), F.array(word)).otherwise(none),
        "B3": F.when(F.length(name) >= 5, F.array(F.left(name, F.lit(5)))).otherwise(none),
        "B4": F.slice(name_tokens, 1, 5),
        "B5": F.when(
            F.size(nums) > 0, F.transform(F.slice(addr_tokens, 1, 3), lambda t: F.concat(F.get(nums, F.lit(0)), F.lit(" "), t))
        ).otherwise(none),
        "B6": F.slice(addr_tokens, 1, 4),
        "B7": postal_codes(nums),
    }
    tagged = [_tagged(keys[s], s) for s in STRATEGIES]
    flat = F.posexplode(F.concat(*tagged)).alias("pos", "k")
    return df.select("entity_id", "country_n", *carry, flat).select("entity_id", "country_n", *carry, "k.strategy", "k.key", "pos")


def _tagged(keys, strategy: str):
    return F.transform(keys, lambda k: F.struct(F.lit(strategy).alias("strategy"), k.alias("key")))


def _by_strategy(values: dict):
    table = F.create_map(*[F.lit(x) for kv in values.items() if kv[1] is not None for x in kv])
    return F.try_element_at(table, F.col("strategy"))


BUCKET = ["strategy", "country_n", "key"]


def bucket_sizes(target_keys: DataFrame) -> DataFrame:
    """Entries per bucket: a partial aggregate, so that hot buckets cost a row a task."""
    return target_keys.groupBy(*BUCKET).agg(F.count("*").alias("size"))


def within_caps(target_keys: DataFrame, config: BlockingConfig) -> DataFrame:
    """Target keys of buckets that aren't larger than their strategy's cap."""
    cap = _by_strategy(config.caps)
    full = bucket_sizes(target_keys).filter(cap.isNotNull() & (F.col("size") > cap)).select(*BUCKET)
    return target_keys.join(full, BUCKET, "left_anti")


def candidate_scores(anchor_keys: DataFrame, target_keys: DataFrame, config: BlockingConfig) -> DataFrame:
    """(s1_id, cand_id, score, first_pos, ord) of every anchor and target that share a key.

    Only the keys cross the join. A pair's order among equal scores is its first key's position, then the target's ord.
    """
    anchors = anchor_keys.select(F.col("entity_id").alias("s1_id"), *BUCKET, "pos")
    targets = within_caps(target_keys, config).select(F.col("entity_id").alias("cand_id"), *BUCKET, "ord")
    weight = _by_strategy(config.weights)
    pairs = anchors.join(targets, BUCKET)
    return pairs.groupBy("s1_id", "cand_id").agg(F.sum(weight).cast("bigint").alias("score"), F.min("pos").alias("first_pos"), F.min("ord").alias("ord"))


def top_candidates(scores: DataFrame, k: int, by_hash: bool = False) -> DataFrame:
    """The k best candidates per anchor with their rank. by_hash: ties go by a hash of the id and not by ingest order."""
    tie = [F.xxhash64("cand_id"), "cand_id"] if by_hash else ["first_pos", "ord"]
    w = Window.partitionBy("s1_id").orderBy(F.desc("score"), *tie)
    return scores.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def targets_in_order(s2: DataFrame, s3: DataFrame) -> DataFrame:
    """both noisy sources as one, all of S2 before all of S3 in ord."""
    shift = F.lit(1 << 40)
    return s2.unionByName(s3.withColumn("ord", F.col("ord") + shift), allowMissingColumns=True)


def candidates(s1: DataFrame, targets: DataFrame, config: BlockingConfig | None = None, by_hash: bool = False, ascii_digits: bool = False) -> DataFrame:
    """B1-B15 on normalized tables: s1_id, cand_id, score, first_pos, ord, rank. Country is part of every key: no loop over countries."""
    config = config or BlockingConfig()
    scores = candidate_scores(blocking_keys(s1, (), ascii_digits), blocking_keys(targets, ascii_digits=ascii_digits), config)
    return top_candidates(scores, config.top_k, by_hash)


def candidate_lists(s1: DataFrame, pairs: DataFrame) -> DataFrame:
    """(s1_id, candidates) for every anchor, the list empty where there are none."""
    lists = pairs.groupBy("s1_id").agg(F.array_sort(F.collect_set("cand_id")).alias("candidates"))
    found = s1.select(F.col("entity_id").alias("s1_id")).join(lists, "s1_id", "left")
    return found.withColumn("candidates", F.coalesce("candidates", F.array().cast("array<string>")))


def blocking_recall(pairs: DataFrame, s1_ids: DataFrame, truth_pairs: DataFrame, cartesian: int | None = None) -> DataFrame:
    """One row of counts and percentages, unrounded. Anchors without candidates count in the means."""
    hits = truth_pairs.join(pairs.select("s1_id", "cand_id", F.lit(1).alias("hit")), ["s1_id", "cand_id"], "left")
    is_ = {s: F.col("cand_id").startswith(f"{s}-") for s in ("S2", "S3")}
    found = F.col("hit").isNotNull()
    truth = hits.agg(
        F.count("*").alias("true_pairs"),
        F.count_if(found).alias("found_pairs"),
        *[F.count_if(c).alias(f"true_{s.lower()}") for s, c in is_.items()],
        *[F.count_if(c & found).alias(f"found_{s.lower()}") for s, c in is_.items()],
    )
    per = pairs.groupBy("s1_id").agg(F.count("*").alias("n"))
    per = s1_ids.select("s1_id").join(per, "s1_id", "left").select(F.coalesce("n", F.lit(0)).alias("n"))
    counts = per.agg(
        F.count("*").alias("s1_entities"),
        F.sum("n").alias("candidate_pairs"),
        F.avg("n").alias("mean_candidates"),
        F.percentile("n", F.lit(0.5)).alias("median_candidates"),
        F.max("n").alias("max_candidates"),
        F.count_if(F.col("n") == 0).alias("zero_candidates"),
    )
    out = truth.join(F.broadcast(counts))
    share = lambda a, b: 100.0 * F.col(a) / F.greatest(F.col(b), F.lit(1))
    out = out.withColumns({"recall_pct": share("found_pairs", "true_pairs"), "recall_s2_pct": share("found_s2", "true_s2"), "recall_s3_pct": share("found_s3", "true_s3"), "zero_pct": share("zero_candidates", "s1_entities")})
    return out.withColumn("reduction_pct", (1.0 - F.col("candidate_pairs") / F.lit(float(cartesian))) * 100.0) if cartesian else out
