"""The 31 features of a pair (0-30), their labels and checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowkin.functions.similarity import jaccard, levenshtein_ratio, overlap, prefix_ratio
from rowkin.functions.tokens import postal_codes

#: Names in the order of the feature vector: fixed values.
FEATURES = (
    "name_exact_match name_norm_exact_match name_len_diff name_len_ratio name_token_count_diff name_token_overlap "
    "name_token_jaccard name_char_2gram_jaccard name_char_3gram_jaccard name_levenshtein_sim name_prefix_sim "
    "name_first_token_match addr_is_missing addr_exact_match addr_norm_exact_match addr_len_diff addr_len_ratio "
    "addr_token_overlap addr_token_jaccard addr_char_3gram_jaccard addr_levenshtein_sim addr_num_overlap_count "
    "addr_first_num_match addr_postal_code_match country_match name_sim_avg name_sim_max addr_sim_avg addr_sim_max "
    "name_addr_combined_score source_is_s3"
).split()

#: What pair features need of a record, beside its id.
RECORD = "business_name business_address name_n addr_n country_n name_tok addr_tok name_2g name_3g addr_3g addr_nums".split()


def paired(pairs: DataFrame, s1: DataFrame, targets: DataFrame) -> DataFrame:
    """pairs (s1_id, cand_id, ...) with both records' columns as structs a and b; pairs with an unknown id are left out."""
    a = s1.select(F.col("entity_id").alias("s1_id"), F.struct(*RECORD).alias("a"))
    b = targets.select(F.col("entity_id").alias("cand_id"), F.struct(*RECORD).alias("b"))
    return pairs.join(a, "s1_id").join(b, "cand_id")


def _flag(c: Column) -> Column:
    return F.coalesce(c, F.lit(False)).cast("int")


def _same(a: Column, b: Column) -> Column:
    return _flag((a == b) & (a != ""))


def pair_features(df: DataFrame, keep: tuple[str, ...] = ("s1_id", "cand_id"), narrow: bool = True) -> DataFrame:
    """keep and the features of df (of paired()). narrow: as 32-bit floats (F4), else as doubles.

    Built-in expressions only. The composite features read the single ones as columns of an earlier projection.
    """
    a, b = (lambda c: F.col(f"a.{c}")), (lambda c: F.col(f"b.{c}"))
    la, lb = F.length(a("name_n")), F.length(b("name_n"))
    ra, rb = F.length(a("addr_n")), F.length(b("addr_n"))
    ratio = lambda x, y: (F.least(x, y) + 1) / (F.greatest(x, y) + 1)
    first = lambda c: F.coalesce(F.get(c, F.lit(0)), F.lit(""))
    single = {
        "name_exact_match": _same(a("business_name"), b("business_name")),
        "name_norm_exact_match": _same(a("name_n"), b("name_n")),
        "name_len_diff": F.abs(la - lb),
        "name_len_ratio": ratio(la, lb),
        "name_token_count_diff": F.abs(F.size(a("name_tok")) - F.size(b("name_tok"))),
        "name_token_overlap": overlap(a("name_tok"), b("name_tok")),
        "name_token_jaccard": jaccard(a("name_tok"), b("name_tok")),
        "name_char_2gram_jaccard": jaccard(a("name_2g"), b("name_2g")),
        "name_char_3gram_jaccard": jaccard(a("name_3g"), b("name_3g")),
        "name_levenshtein_sim": levenshtein_ratio(a("name_n"), b("name_n")),
        "name_prefix_sim": prefix_ratio(a("name_n"), b("name_n")),
        "name_first_token_match": _same(first(a("name_tok")), first(b("name_tok"))),
        "addr_is_missing": _flag(b("addr_n") == ""),
        "addr_exact_match": _same(a("business_address"), b("business_address")),
        "addr_norm_exact_match": _same(a("addr_n"), b("addr_n")),
        "addr_len_diff": F.abs(ra - rb),
        "addr_len_ratio": ratio(ra, rb),
        "addr_token_overlap": overlap(a("addr_tok"), b("addr_tok")),
        "addr_token_jaccard": jaccard(a("addr_tok"), b("addr_tok")),
        "addr_char_3gram_jaccard": jaccard(a("addr_3g"), b("addr_3g")),
        "addr_levenshtein_sim": levenshtein_ratio(a("addr_n"), b("addr_n")),
        "addr_num_overlap_count": overlap(a("addr_nums"), b("addr_nums")),
        "addr_first_num_match": _same(first(a("addr_nums")), first(b("addr_nums"))),
        "addr_postal_code_match": _flag(F.arrays_overlap(postal_codes(a("addr_nums")), postal_codes(b("addr_nums")))),
        "country_match": _same(a("country_n"), b("country_n")),
        "source_is_s3": _flag(F.col("cand_id").startswith("S3-")),
    }
    df = df.select(*keep, *[v.cast("double").alias(k) for k, v in single.items()])
    of = lambda *names: [F.col(n) for n in names]
    mean = lambda *names: sum(of(*names), F.lit(0.0)) / len(names)
    missing = F.col("addr_is_missing") == 1
    names = "name_token_jaccard", "name_char_3gram_jaccard", "name_levenshtein_sim"
    addrs = "addr_token_jaccard", "addr_char_3gram_jaccard", "addr_levenshtein_sim"
    df = df.withColumns(
        {
            "name_sim_avg": mean(*names, "name_prefix_sim"),
            "name_sim_max": F.greatest(*of("name_norm_exact_match", *names)),
            "addr_sim_avg": F.when(missing, 0.0).otherwise(mean(*addrs, "addr_first_num_match")),
            "addr_sim_max": F.when(missing, 0.0).otherwise(F.greatest(*of("addr_norm_exact_match", *addrs))),
        }
    )
    both = 0.55 * F.col("name_sim_avg") + 0.45 * F.col("addr_sim_avg")
    df = df.withColumn("name_addr_combined_score", F.when(missing, 0.85 * F.col("name_sim_avg")).otherwise(both))
    return df.select(*keep, *[F.col(f).cast("float" if narrow else "double").alias(f) for f in FEATURES])


def labelled(pairs: DataFrame, truth_pairs: DataFrame) -> DataFrame:
    """label 1 for pairs of the truth."""
    true = truth_pairs.select("s1_id", "cand_id", F.lit(1).alias("label")).distinct()
    return pairs.join(true, ["s1_id", "cand_id"], "left").na.fill(0, ["label"])


def not_finite(features: DataFrame) -> DataFrame:
    """rows with a null, NaN or infinite feature; of a sound table none."""
    odd = [F.col(f).isNull() | F.isnan(f) | (F.abs(F.col(f)) == float("inf")) for f in FEATURES if f in features.columns]
    any_ = odd[0]
    for c in odd[1:]:
        any_ = any_ | c
    return features.filter(any_)
