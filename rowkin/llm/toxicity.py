"""Toxicity by maximum-scoring segments.

Tokens are words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the lower-cased (A-Z) text. A word is known by itself and by its
beginnings of PREFIXES bytes, since toxic stems take endings. The log-odds of toxic against other training text are
taken for each of these, with a Dirichlet prior in proportion to its frequency in both, and count only if they are
away from zero by `sure` standard errors (the signed root of the likelihood ratio, which holds for small counts, too); a word has the log-odds of the surest of its forms. Every word also
pays a drift, so that clean text has a negative expected score. The linear-time scan of Ruzzo and Tompa finds all maximal segments of a text: its passages
whose score can't be improved by moving either end. By Karlin and Altschul's theory the best score of a clean text
of n tokens has an extreme-value distribution in lambda * score - log n; lambda solves E[exp(lambda s)] = 1 over clean
tokens, and location and scale are fitted to clean training texts that the log-odds haven't seen. Segments add up as
evidence sum max(0, lambda * score - log n - location); a logistic of (evidence, significant segments, extreme-value
tail) turns them into the probability of a toxic label.

Scale: learned from at most n_toxic + n_clean labelled rows (documented bounds), chosen by a hash of their ids, which
are broadcast; their texts are written once and the model is fitted from those. Token counts are aggregated in Spark, and all
tokens that are sure enough make the model: what comes to the driver is bounded by the sample. Scoring is one scan in Arrow batches without a shuffle; a text's scan only visits its positive tokens.

Nulls and odd rows: a null or empty text has no segments and the score of no evidence; a null id isn't learned from;
repeated rows are scored alike; without toxic rows to learn from every score is 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, removed, written
from .labelled import learning_labels, logistic, sample_ids, scan_texts
from .textvec import Words, chunks


def maximal_segments(up: np.ndarray, sums: np.ndarray) -> list[tuple[int, int, float]]:
    """(first, last, score) of all maximal segments; up: the places with a positive score, sums: of the scores before each place.

    Ruzzo and Tompa (1999): each candidate keeps the cumulative score before its start and at its end. A new one is
    merged with the nearest earlier candidate that starts lower, while that one ends lower than it.
    """
    stack: list[tuple[float, float, int, int]] = []  # sum before, sum at the end, first, last
    for p in up.tolist():
        left, right, first = sums[p], sums[p + 1], p
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][0] >= left:
                j -= 1
            if j < 0 or stack[j][1] >= right:
                stack.append((left, right, first, p))
                break
            left, first = stack[j][0], stack[j][2]
            del stack[j:]
    return [(int(a), int(b), float(right - left)) for left, right, a, b in stack]


#: Beginnings of words, in bytes, that are tokens beside the words.
PREFIXES = (4, 5, 6, 7, 8)


def forms(w: Words) -> np.ndarray:
    """Hashes of the words and of their beginnings: one row a kind, one column a word; 0: no such beginning."""
    return np.stack([w.hash, *[w.prefix_hash(size) for size in PREFIXES]])


class Model:
    """Token scores and their calibration."""

    def __init__(self, tokens: np.ndarray, scores: np.ndarray, sure: np.ndarray, drift: float):
        order = np.argsort(tokens)
        self.tokens, self.scores, self.sure, self.drift = tokens[order], scores[order], np.abs(sure[order]), drift
        self.rate, self.place, self.spread = 1.0, 0.0, 1.0
        self.weights = np.array([-30.0, 0.0, 0.0, 0.0])

    def word_scores(self, w: Words) -> np.ndarray:
        """Each word's log-odds, 0 if none of its forms has any."""
        out, sure = np.zeros(len(w)), np.zeros(len(w))
        if len(self.tokens):
            for kind in forms(w):
                at = np.searchsorted(self.tokens, kind)
                at[at == len(self.tokens)] = 0
                better = (self.tokens[at] == kind) & (self.sure[at] > sure)
                out[better], sure[better] = self.scores[at][better], self.sure[at][better]
        return out

    def segments(self, odds: np.ndarray) -> list[tuple[int, int, float]]:
        """odds: the text's words' log-odds."""
        s = odds - self.drift
        up = np.flatnonzero(s > 0)
        return maximal_segments(up, np.concatenate([[0.0], np.cumsum(s)])) if len(up) else []

    def evidence(self, odds: np.ndarray) -> tuple[float, float, float]:
        """(sum of significant scores, their number, the best score's normalised value)."""
        n = max(len(odds), 1)
        x = [self.rate * s - np.log(n) - self.place for _, _, s in self.segments(odds)]
        over = [v / self.spread for v in x if v > 0]
        best = max(x, default=-10.0) / self.spread
        return float(np.log1p(sum(over))), float(np.log1p(len(over))), float(np.clip(best, -10, 20))

    def tail(self, best: float) -> float:
        """Extreme-value probability that a clean text's best segment is as good, as -log."""
        return float(-np.log(max(-np.expm1(-np.exp(-best)), 1e-12)))

    def probability(self, e: np.ndarray) -> np.ndarray:
        x = np.column_stack([e[:, 0], e[:, 1], [self.tail(b) for b in e[:, 2]]])
        z = x @ self.weights[1:] + self.weights[0]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def token_counts(docs: DataFrame) -> DataFrame:
    """(token, label, n): in how many of docs (_t, label) a token is, summed within a batch before the shuffle.

    A text counts once, because words come in bursts: one text that repeats a word is not much evidence.
    """

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for label, rows in b.groupby("label"):
                for _, block in chunks(rows["_t"].tolist()):
                    w = Words(block, "alnum")
                    kinds = forms(w)
                    once = [np.unique(kinds[:, x:y]) for x, y in zip(w.first[:-1], w.first[1:], strict=True)]
                    token, n = np.unique(np.concatenate(once), return_counts=True)
                    token, n = token[token != 0], n[token != 0]
                    yield pd.DataFrame({"token": token.view(np.int64), "label": np.int32(label), "n": n})

    return docs.mapInPandas(scan, "token bigint, label int, n bigint").groupBy("token", "label").agg(F.sum("n").alias("n"))


def log_odds(counts: pd.DataFrame, strength: float = 0.05) -> pd.DataFrame:
    """counts: token, bad, good. Adds odds: log-odds with a Dirichlet prior.

    The prior's mass is `strength` times all counts, dealt in proportion to a token's frequency in both classes.
    """
    bad, good = counts["bad"].to_numpy(float), counts["good"].to_numpy(float)
    prior = strength * (bad + good)
    odds = lambda y: np.log((y + prior) / np.maximum(y.sum() + prior.sum() - y - prior, 1e-9))
    return counts.assign(odds=odds(bad) - odds(good))


def sureness(ratio: float) -> Column:
    """Signed root of the likelihood ratio of a token's counts bad and good against the common share `ratio` of bad."""
    n = F.col("bad") + F.col("good")
    part = lambda c, p: F.when(F.col(c) > 0, F.col(c) * F.log(F.col(c) / (n * p))).otherwise(F.lit(0.0))
    root = F.sqrt(F.greatest(F.lit(0.0), 2 * (part("bad", ratio) + part("good", 1 - ratio))))
    return F.when(F.col("bad") >= ratio * n, root).otherwise(-root)


def karlin_rate(scores: np.ndarray, weights: np.ndarray) -> float:
    """lambda > 0 with sum weights * exp(lambda * scores) = 1; the expected score is negative."""
    f = lambda x: float((weights * np.exp(np.minimum(x * scores, 700))).sum()) - 1
    low, high = 1e-6, 1.0
    while f(high) < 0 and high < 64:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if f(mid) < 0 else (low, mid)
    return (low + high) / 2


def fit(docs: DataFrame, labels: DataFrame, folds: int, held_out: int, n_toxic: int = 6000, n_clean: int = 12000, sure: float = 4.0, least_odds: float = 1.0, seed: int = 42) -> Model:
    """docs: doc_id, _t. Two thirds of the sampled rows give the log-odds, the rest the calibration."""
    known = learning_labels(labels, "toxic", folds, held_out)
    ids = None
    for label, n in ((1, n_toxic), (0, n_clean)):
        part = sample_ids(known.filter(F.col("label") == label), n, seed).withColumn("label", F.lit(label))
        ids = part if ids is None else ids.unionByName(part)
    ids = ids.withColumn("third", F.pmod(F.xxhash64("doc_id", F.lit(seed + 1)), F.lit(3)))
    rows = written(docs.join(F.broadcast(ids), "doc_id").select("_t", "label", "third"), "toxic-sample")
    counts = token_counts(rows.filter("third > 0")).groupBy("token").agg(
        F.sum(F.expr("if(label = 1, n, 0)")).alias("bad"), F.sum(F.expr("if(label = 0, n, 0)")).alias("good")
    )
    counts = written(counts, "toxic-counts")
    totals = counts.agg(F.sum("bad"), F.sum("good")).first()
    if not totals[0] or not totals[1]:
        return Model(np.zeros(0, dtype=np.uint64), np.zeros(0), np.zeros(0), 0.1)
    ratio = totals[0] / (totals[0] + totals[1])
    top = counts.withColumn("z", sureness(ratio)).filter(F.abs("z") >= sure).orderBy("token").toPandas()
    rest = pd.DataFrame({"token": [0], "bad": [totals[0] - top["bad"].sum()], "good": [totals[1] - top["good"].sum()]})
    scored = log_odds(pd.concat([top, rest], ignore_index=True)).iloc[: len(top)]
    scored = scored[scored["odds"].abs() >= least_odds]
    odds = scored["odds"].to_numpy()
    share = scored["good"].to_numpy(float) / max(1, totals[1])
    # drift: what makes the expected score of clean text clearly negative
    drift = float(max(0.1, 2 * (odds * share).sum() + 0.02))
    model = Model(scored["token"].to_numpy(np.int64).view(np.uint64), odds, scored["z"].to_numpy(), drift)
    model.rate = karlin_rate(np.r_[odds - drift, -drift], np.r_[share, max(0.0, 1 - share.sum())])

    kept = docs.sparkSession.sparkContext.broadcast(model)

    def of(texts: list[str | None]) -> Iterator[pd.DataFrame]:
        for _, block in chunks(texts):
            w = Words(block, "alnum")
            odds = kept.value.word_scores(w)
            best = [max((s for _, _, s in kept.value.segments(odds[a:b])), default=0.0) for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
            yield pd.DataFrame({"best": best, "n": np.diff(w.first)})

    held = rows.filter("third = 0")
    seen = scan_texts(held.select("label", "_t"), "best double, n bigint", of).toPandas()
    clean = seen[(seen["label"] == 0) & (seen["n"] > 0)]
    x = (model.rate * clean["best"] - np.log(clean["n"])).to_numpy(float)
    if len(x) >= 20:  # moments of a Gumbel distribution, from the middle half: clean rows hold some wrong labels
        low, mid, high = np.quantile(x, [0.25, 0.5, 0.75])
        model.spread = float(max(0.2, (high - low) / 1.5725))
        model.place = float(mid + model.spread * np.log(np.log(2)))
    kept = docs.sparkSession.sparkContext.broadcast(model)
    of = evidence_of(kept)
    seen = scan_texts(held.select("label", "_t"), "e0 double, e1 double, e2 double", of).toPandas()
    e = seen[["e0", "e1", "e2"]].to_numpy(float)
    if len(e) and 0 < seen["label"].sum() < len(e):
        share_bad = ids_share(known)
        y = seen["label"].to_numpy(float)
        x = np.column_stack([e[:, 0], e[:, 1], [model.tail(b) for b in e[:, 2]]])
        model.weights = logistic(x, y)
        # sampled classes are not as frequent as in the labels: move the intercept to their frequency
        model.weights[0] += np.log(share_bad / (1 - share_bad)) - np.log(y.mean() / (1 - y.mean()))
    removed(docs.sparkSession, rows)
    removed(docs.sparkSession, counts)
    return model


def ids_share(known: DataFrame) -> float:
    n, bad = known.agg(F.count("*"), F.sum("label")).first()
    return float(np.clip((bad or 0) / max(n, 1), 1e-4, 1 - 1e-4))


def evidence_of(kept):
    def of(texts: list[str | None]) -> Iterator[pd.DataFrame]:
        for _, block in chunks(texts):
            w = Words(block, "alnum")
            odds = kept.value.word_scores(w)
            rows = [kept.value.evidence(odds[a:b]) for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
            yield pd.DataFrame(rows, columns=["e0", "e1", "e2"])

    return of


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: tuple[str, ...] = (),
    folds: int = 4,
    held_out: int = 2,
    threshold: float = 0.3,
    **bounds,
) -> DataFrame:
    """One row per row of docs: doc_id, the columns keep, held_out, score, predicted, and the significant segments
    (first and last token, score), the passages that make the text toxic."""
    keep = tuple(c for c in keep if c.lower() not in ("doc_id", "held_out", "score", "predicted", "segments", "_t", id_col.lower()))
    whole = docs.select(F.col(id_col).alias("doc_id"), *[F.col(f"`{c}`") for c in keep], F.col(text_col).alias("_t"))
    model = fit(whole.select("doc_id", "_t"), labels, folds, held_out, **bounds)
    kept = docs.sparkSession.sparkContext.broadcast(model)

    def of(texts: list[str | None]) -> Iterator[pd.DataFrame]:
        for _, block in chunks(texts):
            w, m = Words(block, "alnum"), kept.value
            odds = m.word_scores(w)
            rows, found = [], []
            for a, b in zip(w.first[:-1], w.first[1:], strict=True):
                segments = m.segments(odds[a:b])
                rows.append(m.evidence(odds[a:b]))
                floor = np.log(max(b - a, 1)) + m.place
                found.append([{"first": x, "last": y, "score": s} for x, y, s in segments if m.rate * s > floor])
            yield pd.DataFrame({"score": m.probability(np.array(rows)), "segments": found})

    scored = scan_texts(whole, "score double, segments array<struct<first:int,last:int,score:double>>", of)
    return scored.select(
        "doc_id",
        *keep,
        (crc_mod(F.col("doc_id"), folds) == held_out).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "segments",
    )
