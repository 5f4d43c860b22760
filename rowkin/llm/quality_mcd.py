"""Quality rules: robust multivariate outliers per language and source, in DataFrame functions only.

Text statistics (quality_stats) are array functions within a row. They are transformed (shares and logs), and
for each (lang, source) group a minimum-covariance-determinant estimate of location and scatter is found by
concentration steps: from the coordinatewise median and spread, keep the h = support share of the group's
rows with the smallest Mahalanobis distance, re-estimate from them, and repeat until no group's determinant falls
any more. There is one start a group, so that the minimum found is a local one. A row is rejected if its
squared distance from its group's estimate exceeds the chi-square quantile of `confidence`, and the statistic
vector lies on a bad side: a document isn't rejected for having unusually few symbols, but for words that are
unusually long or short.

Every group is judged by an estimate of its own, regularised as in the minimum regularised covariance determinant: location
and scatter of a group of n rows are weighted n to prior_rows with its language's, and those of a language with the overall
ones. So a group of any size, down to one row, has an estimate, without a size at which another rule would hold.

Scale: texts are read once and leave the scan as five numbers a row, kept in the shared folder. Every step is
one partial aggregate of d + d(d+1)/2 sums by group, so that a hot source moves as many rows as any other;
the distance that cuts off h rows is an approximate percentile of relative error 1 / accuracy, a mergeable
sketch. Cholesky factors are Column arithmetic on the groups' table, which is broadcast up to a number of groups
that is counted first, and joined by shuffle beyond.

Nulls and odd rows: a null text has no words and fails the base rule; a null lang or source is a group of its
own; repeated rows count as often as they occur; an empty table gives an empty result. Columns of the input
named like the results are replaced.
"""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import begun, removed, removed_since, sized_broadcast, written

SPACE = r"[\x20\x09-\x0D]+"
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def quality_stats(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (bigint).

    For n_repeat_words, 3-word windows become 64-bit hashes. If a text repeats any, (hash, position) pairs are sorted, so
    that equal windows stand together: n log n for a text of any length.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    docs = docs.drop(*STATS, "_w", "_h", "_s", "_q", "_l")
    out = docs.withColumn("_w", words_of(F.col(text_col)))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, " \t\n\x0b\x0c\r", "")) > 0)
    out = out.withColumns(
        {
            "n_words": F.size("_w").cast("bigint"),
            "word_chars": F.length(F.array_join("_w", "")).cast("bigint"),
            "n_symbols": (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]", ""))).cast("bigint"),
            "_l": lines,
            "_h": F.when(
                F.size("_w") >= 4,
                F.transform(
                    F.sequence(F.lit(0), F.size("_w") - 3),
                    lambda i: F.coalesce(F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2)), F.lit(0)),
                ),
            ),
        }
    )
    pairs = F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    out = out.withColumn("_s", F.when(F.size(F.array_distinct("_h")) < F.size("_h"), pairs))
    twin = F.filter(
        "_s",
        lambda x, i: ((i > 0) & (x["h"] == F.get("_s", i - 1)["h"])) | F.coalesce(x["h"] == F.get("_s", i + 1)["h"], F.lit(False)),
    )
    out = out.withColumn("_q", F.sort_array(F.transform(twin, lambda x: x["p"])))
    covered = F.aggregate(
        "_q",
        F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
        lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(p - a["last"], F.lit(3))).alias("n")),
        lambda a: a["n"],
    )
    return out.withColumns(
        {
            "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("bigint"),
            "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("bigint"),
        }
    ).drop("_w", "_h", "_s", "_q", "_l")


def base_failed(min_words: int = 50, max_repeat: int = 50) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))


#: Coordinates of the statistic vector, made by vector().
XS = ("x0", "x1", "x2", "x3")


def vector() -> dict[str, Column]:
    """Transformed statistics. A high value of symbols, repeats or duplicate lines is bad; word length is odd at either side."""
    per = lambda a, b: F.try_divide(F.col(a), F.greatest(F.col(b), F.lit(1)))
    return {
        "x0": F.log1p(100.0 * per("n_symbols", "word_chars")),
        "x1": F.log1p(100.0 * per("n_repeat_words", "n_words")),
        "x2": F.log1p(F.col("n_dup_lines").cast("double")),
        "x3": F.log(1.0 + per("word_chars", "n_words")),
    }


HIGH_IS_BAD = ("x0", "x1", "x2")
ODD_IS_BAD = ("x3",)
#: Least standard deviation of each coordinate: a group whose rows are all alike would else reject any other row.
#: Shares and lines are zero in most rows, so that their scatter says little: at a confidence of 0.999 a text is cut
#: for one statistic alone from about 2 % symbols, 25 % repeated words, 4 repeated lines or words a fifth longer or shorter.
FLOOR = {"x0": 0.25, "x1": 0.75, "x2": 0.35, "x3": 0.04}


def chi2_quantile(p: float, d: int) -> float:
    """Wilson and Hilferty's approximation."""
    z = NormalDist().inv_cdf(p)
    return d * (1 - 2 / (9 * d) + z * math.sqrt(2 / (9 * d))) ** 3


def _moments(xs: list[str]) -> list[Column]:
    out = [F.count("*").alias("n")] + [F.avg(x).alias(f"m_{x}") for x in xs]
    return out + [F.avg(F.col(a) * F.col(b)).alias(f"s_{a}_{b}") for i, a in enumerate(xs) for b in xs[i:]]


def _factor(xs: list[str], scale: float) -> dict[str, Column]:
    """Columns c_i_j of scale * covariance, floors added to the diagonal."""
    cov = {}
    for i, a in enumerate(xs):
        for b in xs[i:]:
            c = scale * (F.col(f"s_{a}_{b}") - F.col(f"m_{a}") * F.col(f"m_{b}"))
            cov[b, a] = F.greatest(c, F.lit(0.0)) + FLOOR[a] ** 2 if a == b else c
    return {f"c_{b}_{a}": c for (b, a), c in cov.items()}


def _with_factor(groups: DataFrame, xs: list[str], scale: float) -> DataFrame:
    return _cholesky(groups.withColumns(_factor(xs, scale)), xs)


def _cholesky(groups: DataFrame, xs: list[str]) -> DataFrame:
    """groups with l_i_j, the Cholesky factor of their c_i_j."""
    for j, b in enumerate(xs):  # column by column; each withColumn uses the ones before
        rest = F.col(f"c_{b}_{b}")
        for k in xs[:j]:
            rest = rest - F.col(f"l_{b}_{k}") * F.col(f"l_{b}_{k}")
        groups = groups.withColumn(f"l_{b}_{b}", F.sqrt(F.greatest(rest, F.lit(1e-9))))
        below = {}
        for a in xs[j + 1 :]:
            dot = F.col(f"c_{a}_{b}")
            for k in xs[:j]:
                dot = dot - F.col(f"l_{a}_{k}") * F.col(f"l_{b}_{k}")
            below[f"l_{a}_{b}"] = dot / F.col(f"l_{b}_{b}")
        if below:
            groups = groups.withColumns(below)
    return groups


def _distance(rows: DataFrame, xs: list[str]) -> DataFrame:
    """rows with d2, by forward substitution with their group's factor."""
    for j, b in enumerate(xs):
        z = F.col(b) - F.col(f"m_{b}")
        for k in xs[:j]:
            z = z - F.col(f"l_{b}_{k}") * F.col(f"z_{k}")
        rows = rows.withColumn(f"z_{b}", z / F.col(f"l_{b}_{b}"))
    d2 = F.lit(0.0)
    for b in xs:
        d2 = d2 + F.col(f"z_{b}") * F.col(f"z_{b}")
    return rows.withColumn("d2", d2).drop(*[f"z_{b}" for b in xs])


def mcd_by_group(rows: DataFrame, key: str, xs: list[str], support: float = 0.75, tolerance: float = 1e-3, accuracy: int = 2000, max_broadcast: int = 50_000) -> DataFrame:
    """One row per group: key, n, means and factor of the minimum-covariance-determinant estimate.

    The start is the coordinatewise median with scatter from the medians of absolute deviation: robust while
    under half of a group is off. Each concentration step lowers the determinant or leaves it, but for the error of
    the approximate cut; steps end when no group's determinant falls by more than the share `tolerance` below its
    lowest so far, which every further step lowers by as much, and which the floors bound. The groups are
    counted once; their tables are broadcast if there are at most max_broadcast (of some 40 numbers each), so that rows
    never move by group, and joined by shuffle beyond.
    """
    scale, mark = 1.0, begun()
    d = len(xs)
    med = written(rows.groupBy(key).agg(F.count("*").alias("n"), *[F.percentile_approx(x, 0.5, accuracy).alias(f"m_{x}") for x in xs]), "mcd-start")
    small = med.limit(max_broadcast + 1).count() <= max_broadcast
    of = F.broadcast if small else (lambda t: t)
    groups = rows.join(of(med), key).groupBy(key).agg(
        *[F.first(f"m_{x}").alias(f"m_{x}") for x in xs],
        *[F.percentile_approx(F.abs(F.col(x) - F.col(f"m_{x}")), 0.5, accuracy).alias(f"a_{x}") for x in xs],
    )
    for i, a in enumerate(xs):
        for b in xs[i:]:
            square = F.col(f"m_{a}") * F.col(f"m_{b}")
            groups = groups.withColumn(f"s_{a}_{b}", square + (1.4826 * F.col(f"a_{a}")) ** 2 if a == b else square)
    log_det = sum(2.0 * F.log(f"l_{x}_{x}") for x in xs)
    groups = groups.withColumn("low", F.lit(None).cast("double"))
    steps = 0
    while True:
        groups = written(_with_factor(groups, xs, scale).withColumn("now", log_det), "mcd-step")
        if steps > 1:  # the start's scatter isn't of chosen rows
            fall = groups.agg(F.max(F.col("low") - F.col("now"))).first()[0]
            if fall is None or fall <= tolerance:
                break
        lowest = groups.select(key, (F.least("low", "now") if steps else F.lit(None).cast("double")).alias("low"))
        near = _distance(rows.join(of(groups.drop("low", "now")), key), xs).select(key, *xs, "d2")
        cut = written(near.groupBy(key).agg(F.percentile_approx("d2", support, accuracy).alias("cut")), "mcd-cut")
        groups = near.join(of(cut), key).filter("d2 <= cut").groupBy(key).agg(*_moments(xs)).join(of(lowest), key)
        # the chosen rows' scatter is too small by a factor that depends on the support (Croux and Haesbroeck)
        scale = support / _chi2_cdf(chi2_quantile(support, d), d + 2)
        steps += 1
    groups = groups.drop("low", "now")
    out = written(groups.drop("n").join(med.select(key, F.col("n").alias("n_all")), key), "mcd")
    removed_since(rows.sparkSession, mark, out)
    return out


def _chi2_cdf(x: float, d: int) -> float:
    z = ((x / d) ** (1 / 3) - (1 - 2 / (9 * d))) / math.sqrt(2 / (9 * d))
    return NormalDist().cdf(z)


def regularised(groups: DataFrame, xs: list[str], prior_rows: float, max_broadcast: int) -> DataFrame:
    """groups of mcd_by_group whose keys g are 0, 1 language, 2 language source: (g, means and factors) of the last
    kind, each weighted with its language's, which is weighted with the overall estimate."""
    names = [f"m_{x}" for x in xs] + [f"c_{b}_{a}" for i, a in enumerate(xs) for b in xs[i:]]
    level = groups.select("g", F.split("g", "\x00")[1].alias("lang"), "n_all", *names)
    above = level.filter("g = '0'").select(*[F.col(c).alias(f"p_{c}") for c in names])

    def weighted(mine: DataFrame) -> DataFrame:
        own = F.col("n_all") / (F.col("n_all") + F.lit(float(prior_rows)))
        return mine.select("g", "lang", *[(own * F.col(c) + (1 - own) * F.col(f"p_{c}")).alias(c) for c in names])

    lang = weighted(level.filter("g like '1%'").join(F.broadcast(above)))  # one row above
    lang = lang.select("lang", *[F.col(c).alias(f"p_{c}") for c in names])
    return _cholesky(weighted(level.filter("g like '2%'").join(sized_broadcast(lang, max_broadcast), "lang")).drop("lang"), xs)


def quality_rules(
    docs: DataFrame,
    text_col: str = "text",
    group_cols: tuple[str, str] = ("lang", "source"),
    confidence: float = 0.999,
    support: float = 0.75,
    prior_rows: float = 50.0,
    max_broadcast: int = 50_000,
    keep: tuple[str, ...] | None = None,
) -> DataFrame:
    """One row per row of docs: the columns `keep` (all but the text by default), the statistics, base_failed, d2, kept."""
    keep = tuple(c for c in docs.columns if c != text_col) if keep is None else keep
    made = {*STATS, "base_failed", "kept", "d2", "g", "g0", "g1", "_w", "_h", "_s", "_q", "_l"} | set(XS)
    keep = tuple(c for c in keep if c.lower() not in made and not c.lower().startswith(("m_x", "c_x", "l_x", "z_x")))
    xs = list(XS)
    used = dict.fromkeys([*keep, *group_cols, text_col])
    flat = quality_stats(docs.select(*[F.col(f"`{c}`") for c in used]), text_col)
    g = {f"g{i}": F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("null")) for i, c in enumerate(group_cols)}
    flat = flat.withColumns(g).select(*keep, *STATS, *g)
    flat = flat.withColumn("base_failed", base_failed()).withColumns(vector())
    rows = written(flat, "quality-stats")
    # each row counts in its (lang, source) group, in its language's and in the whole
    levels = F.array(F.concat_ws("\x00", F.lit("2"), "g0", "g1"), F.concat_ws("\x00", F.lit("1"), "g0"), F.lit("0"))
    fit = rows.filter("not base_failed").select(F.explode(levels).alias("g"), *xs)
    groups = mcd_by_group(fit, "g", xs, support, max_broadcast=max_broadcast)
    own = written(regularised(groups, xs, prior_rows, max_broadcast), "mcd-own")
    removed(docs.sparkSession, groups)
    joined = rows.withColumn("g", levels[0]).join(sized_broadcast(own, max_broadcast), "g", "left").drop("g")
    judged = _distance(joined, xs)
    worse = F.lit(False)
    for x in HIGH_IS_BAD:
        worse = worse | (F.col(x) - F.col(f"m_{x}") > 2 * FLOOR[x])
    for x in ODD_IS_BAD:
        worse = worse | (F.abs(F.col(x) - F.col(f"m_{x}")) > 2 * FLOOR[x])
    limit = chi2_quantile(confidence, len(xs))
    outlier = F.coalesce((F.col("d2") > limit) & worse, F.lit(False))
    return judged.withColumn("kept", ~F.col("base_failed") & ~outlier).select(*keep, *STATS, "base_failed", "d2", "kept")
