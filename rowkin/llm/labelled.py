"""Bounded samples of labelled rows, and scans that keep a row's columns beside what is computed from its text."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod


def sample_ids(rows: DataFrame, n: int, seed: int, id_col: str = "doc_id") -> DataFrame:
    """At most n distinct ids: those with the smallest hash of (id, seed). A top-n of ids alone, no text."""
    ids = rows.select(F.col(id_col).alias("doc_id")).filter("doc_id is not null")
    return ids.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(n).distinct()


def learning_labels(labels: DataFrame, label_col: str, folds: int, held_out: int, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, label) of the rows that may be learned from; of several labels of an id the largest counts."""
    known = labels.filter(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("doc_id")).agg(F.max(label_col).cast("int").alias("label"))
    return known.filter(crc_mod(F.col("doc_id"), folds) != held_out)


def scan_texts(docs: DataFrame, fields: str, of: Callable[[list[str | None]], Iterator[np.ndarray | pd.DataFrame]]) -> DataFrame:
    """docs (with a text column _t, dropped) and the fields that `of` yields for its texts, in order, piece by piece."""
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema.fields if f.name != "_t")

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            at = 0
            rest = b.drop(columns="_t")
            for piece in of(b["_t"].tolist()):
                more = rest.iloc[at : at + len(piece)].reset_index(drop=True)
                at += len(piece)
                yield pd.concat([more, piece], axis=1)

    return docs.mapInPandas(scan, kept + fields)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Weights (intercept first) of a ridge logistic regression, by Newton's method."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + ridge * len(y) * np.r_[0, w[1:]]
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * len(y) * np.eye(len(w)) + 1e-9 * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w
