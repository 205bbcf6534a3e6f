"""Bounded samples of labelled documents, and the fold that no model sees."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared_folder import broadcast_up_to, written

#: The part of the rows that no model sees: crc32(doc_id) mod FOLDS is 0.
FOLDS = 5
BROADCAST_ROWS = 1_000_000


def held_out(doc_id) -> F.Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0


def sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> tuple[DataFrame, float] | None:
    """(doc_id, label) of labelled documents outside the held-out part, and the share of label 1; None if a class has none.

    The rows of smallest hash in each class, at most ``per_class`` of each, whatever
    the size of the tables.  Labels that contradict each other, repeat or lack a
    document are left out.
    """
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias(label)).where(f"doc_id is not null and {label} in (0, 1)").where(~held_out(F.col("doc_id")))
    counts = {r[label]: r.n for r in rows.groupBy(label).agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return None
    rows = rows.groupBy("doc_id").agg(F.max(label).alias(label), F.min(label).alias("other")).where(F.col(label) == F.col("other"))
    # Labelled rows can lack a document, so the bound is put on those that have one.
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id")).join(broadcast_up_to(rows, BROADCAST_ROWS), "doc_id").groupBy("doc_id").agg(F.max(label).alias(label))
    order = F.xxhash64("doc_id", F.lit(3))
    some = [known.where(F.col(label) == k).orderBy(order, "doc_id").limit(per_class) for k in (0, 1)]
    return written(some[0].unionByName(some[1]), f"{label}-sample"), counts[1] / (counts[0] + counts[1])


def logistic(x: np.ndarray, y: np.ndarray, weights: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Weights of a logistic curve in the columns of x, by Newton's steps."""
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weights * (y - p)) - ridge * beta
        curve = (x * (weights * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        beta = beta + np.linalg.solve(curve, slope)
    return beta
