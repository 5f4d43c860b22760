"""Quality classifier by positive-unlabelled learning.

Trusted positives are labelled rows of good quality; the other set is web text without regard to labels. The
class prior is the largest share of positives that the unlabelled text can hold: the least ratio of tail
masses, unlabelled over positive, along the scores of a positive-versus-unlabelled model (best bin estimate).
A logistic model then minimises the non-negative unbiased risk
    prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives))
by gradient steps that turn round, as usual, where the bracket is negative. Negative labels are never used.

Features of a whole text: frequencies of pairs of byte classes (letters by case, digits, space, line ends, kinds of
punctuation and symbols, other bytes), shares of repeated words, word triples and lines, word length and text length.

Scale: the model is fitted on at most n_positive + n_unlabelled rows (documented bounds), chosen by a hash of their
ids; their ids are broadcast, their features, WIDTH numbers a row, come to the driver. Scoring is one scan in
Arrow batches without a shuffle.

Nulls and odd rows: a null or empty text has all features zero but gets a score; a null id isn't learned from;
repeated rows are scored alike; without any positive to learn from every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod
from .labelled import learning_labels, logistic, sample_ids, scan_texts
from .textvec import CHUNK, Words, gram_hash

#: Byte classes: every byte that isn't named is of class 0.
KINDS = ["", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\n\r", ".,;:", "!?", "'\"()-", "#*$%&", "|<>", "{}[]_=+~^@/\\`"]
CLASS = np.zeros(256, dtype=np.uint8)
for _i, _chars in enumerate(KINDS):
    CLASS[list(_chars.encode())] = _i
CLASS[128:] = len(KINDS)
N_KINDS = len(KINDS) + 1
WIDTH = N_KINDS * N_KINDS + 7


def _share_repeated(keys: np.ndarray) -> float:
    return 1 - len(np.unique(keys)) / len(keys) if len(keys) else 0.0


def features(texts: list[str | None]) -> Iterator[np.ndarray]:
    """Rows of WIDTH numbers for the texts, in pieces of about CHUNK bytes."""
    held: list[bytes] = []
    size = 0
    for t in [*texts, None]:
        b = t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b""
        if held and size + len(b) > CHUNK:
            yield _features(held)
            held, size = [], 0
        held.append(b)
        size += len(b) + 1
    held.pop()  # the sentinel
    if held:
        yield _features(held)


def _features(block: list[bytes]) -> np.ndarray:
    n = len(block)
    w = Words([b.lower() for b in block])
    kind = CLASS[np.frombuffer(b"\n".join(block) + b"\n", dtype=np.uint8)].astype(np.int64)
    row = np.repeat(np.arange(n), [len(b) + 1 for b in block])
    pair = kind[:-1] * N_KINDS + kind[1:] + row[:-1] * (N_KINDS * N_KINDS)
    inside = np.ones(len(pair), dtype=bool)
    inside[np.cumsum([len(b) + 1 for b in block])[:-1] - 1] = False  # from one text to the next
    pairs = np.bincount(pair[inside], minlength=n * N_KINDS * N_KINDS).reshape(n, -1)
    out = np.zeros((n, WIDTH))
    total = pairs.sum(axis=1, keepdims=True)
    out[:, : N_KINDS * N_KINDS] = np.sqrt(pairs / np.maximum(total, 1))
    triples = gram_hash(w.hash, 3)
    lengths = (w.end - w.start).astype(float)
    for i, b in enumerate(block):
        x, y = w.first[i], w.first[i + 1]
        lines = [s for s in b.split(b"\n") if s.strip()]
        count = y - x
        out[i, -7:] = (
            np.log1p(len(b)) / 10,
            np.log1p(count) / 10,
            _share_repeated(w.hash[x:y]),
            _share_repeated(triples[x : y - 2]) if count > 2 else 0.0,
            1 - len(set(lines)) / len(lines) if lines else 0.0,
            lengths[x:y].mean() / 10 if count else 0.0,
            lengths[x:y].std() / 10 if count else 0.0,
        )
    return out


def class_prior(positive: np.ndarray, unlabelled: np.ndarray, least: float = 0.5) -> float:
    """The least ratio of unlabelled to positive mass above a score, over scores that `least` of the positives reach.

    A positive's score distribution is inside the unlabelled one with weight prior, so each ratio bounds the prior from
    above; a term for the samples' chance is added to the ratio before the least is taken and left out of it afterwards.
    """
    cuts = np.quantile(positive, np.linspace(0.0, 1 - least, 200))
    p = np.array([(positive >= c).mean() for c in cuts])
    u = np.array([(unlabelled >= c).mean() for c in cuts])
    slack = np.sqrt(np.log(4 / 0.1) / 2 / len(unlabelled)) + np.sqrt(np.log(4 / 0.1) / 2 / len(positive))
    best = int(np.argmin((u + slack) / p))
    return float(np.clip(u[best] / p[best], 0.01, 0.99))


def fit_nnpu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 600, rate: float = 0.05, decay: float = 1e-3) -> np.ndarray:
    """Weights (intercept first) that minimise the non-negative risk with logistic loss, by Adam on the whole sample."""
    p, u = (np.column_stack([np.ones(len(x)), x]) for x in (positive, unlabelled))
    w, m, v = (np.zeros(p.shape[1]) for _ in range(3))
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for t in range(1, steps + 1):
        zp, zu = p @ w, u @ w
        good = -prior * p.T @ (1 - sig(zp)) / len(p)  # of prior * R+(positives)
        bad = u.T @ sig(zu) / len(u) - prior * p.T @ sig(zp) / len(p)
        left = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        g = (good + bad if left >= 0 else -bad) + decay * np.r_[0, w[1:]]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


class Model:
    def __init__(self, mean: np.ndarray, spread: np.ndarray, weights: np.ndarray, prior: float):
        self.mean, self.spread, self.weights, self.prior = mean, spread, weights, prior

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -8, 8) @ self.weights[1:] + self.weights[0]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _collected(docs: DataFrame, ids: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(features, good) of the documents with ids (doc_id, good); one scan of docs. They come as Arrow: as rows, each number is an object."""
    of = lambda texts: (pd.DataFrame({"x": list(f)}) for f in features(texts))
    found = scan_texts(docs.join(F.broadcast(ids), "doc_id").select("good", "_t"), "x array<double>", of).toArrow().combine_chunks()
    x = [c.flatten().to_numpy() for c in found["x"].chunks]
    return np.concatenate([np.zeros(0), *x]).reshape(-1, WIDTH), found["good"].to_numpy().astype(bool)


def fit(docs: DataFrame, labels: DataFrame, folds: int, held_out: int, n_positive: int = 3000, n_unlabelled: int = 6000, seed: int = 42) -> Model:
    """docs: doc_id, _t. Learns from at most n_positive good rows and n_unlabelled rows of the folds that aren't held out."""
    good = learning_labels(labels, "quality", folds, held_out).filter("label = 1")
    web = docs.filter(crc_mod(F.col("doc_id"), folds) != held_out)
    ids = sample_ids(good, n_positive, seed).withColumn("good", F.lit(True)).unionByName(sample_ids(web, n_unlabelled, seed + 1).withColumn("good", F.lit(False)))
    x, is_good = _collected(docs, ids)
    positive, unlabelled = x[is_good], x[~is_good]
    if not len(positive) or not len(unlabelled):
        return Model(np.zeros(WIDTH), np.ones(WIDTH), np.zeros(WIDTH + 1), 0.5)
    mean, spread = unlabelled.mean(axis=0), unlabelled.std(axis=0) + 0.02
    p, u = (np.clip((x - mean) / spread, -8, 8) for x in (positive, unlabelled))
    first = logistic(np.vstack([p, u]), np.r_[np.ones(len(p)), np.zeros(len(u))], ridge=1e-2)
    prior = class_prior(p @ first[1:], u @ first[1:])
    return Model(mean, spread, fit_nnpu(p, u, prior), prior)


def quality_classifier(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: tuple[str, ...] = (),
    folds: int = 3,
    held_out: int = 1,
    threshold: float = 0.5,
    n_positive: int = 3000,
    n_unlabelled: int = 6000,
) -> DataFrame:
    """One row per row of docs: doc_id, the columns keep, held_out, score, predicted."""
    keep = tuple(c for c in keep if c.lower() not in ("doc_id", "held_out", "score", "predicted", "_t", id_col.lower()))
    whole = docs.select(F.col(id_col).alias("doc_id"), *[F.col(f"`{c}`") for c in keep], F.col(text_col).alias("_t"))
    model = fit(whole.select("doc_id", "_t"), labels, folds, held_out, n_positive, n_unlabelled)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def of(texts: list[str | None]) -> Iterator[pd.DataFrame]:
        for f in features(texts):
            yield pd.DataFrame({"score": shared.value.score(f)})

    scored = scan_texts(whole, "score double", of)
    return scored.select(
        "doc_id",
        *keep,
        (crc_mod(F.col("doc_id"), folds) == held_out).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
