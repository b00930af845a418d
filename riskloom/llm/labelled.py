"""Bounded samples of labelled documents, and calibration of scores to probabilities."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sample(
    docs: DataFrame, labels: DataFrame, label: str, bounds: tuple[int, int], where: Column | None = None
) -> list[tuple[str, int]]:
    """Texts and labels of labelled documents, up to a bound for label 0 and one for 1.

    The rows with the lowest hash of their id are taken, so the sample is the same in each
    run. ``where`` is a condition on ``doc_id``. Labels other than 0 and 1 and null ids are
    left out. The ids are no more than that, so they are broadcast and only the
    chosen texts come to the driver. Of repeated rows of an id the smallest text counts, once;
    an id with both labels may count under each.
    """
    rows = labels.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")
    ).where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
    if where is not None:
        rows = rows.where(where)
    rows = rows.distinct().withColumn("draw", F.xxhash64("doc_id", F.lit(label)))
    chosen = None
    for value in (0, 1):
        some = rows.where(F.col("label") == value).orderBy("draw", "doc_id").limit(bounds[value])
        chosen = some if chosen is None else chosen.unionByName(some)
    texts = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
        .where(F.col("text").isNotNull())
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "draw", "label")
        .agg(F.min("text").alias("text"))
        .select("draw", "text", "label")
        .toArrow()
        .sort_by([("draw", "ascending"), ("text", "ascending")])
    )
    return list(zip(texts["text"].to_pylist(), texts["label"].to_pylist(), strict=True))


def calibrate(scores: np.ndarray, labels: np.ndarray, rounds: int = 200) -> tuple[float, float]:
    """Slope and offset with which a sigmoid turns scores to probabilities.

    Newton's method on the likelihood of smoothed targets; with one class missing the
    probability is a constant.
    """
    pos, neg = int(labels.sum()), int(len(labels) - labels.sum())
    if not pos or not neg:
        return 0.0, float(np.log((pos + 0.5) / (neg + 0.5)))
    target = np.where(labels > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    shift, scale = scores.mean(), scores.std() or 1.0
    x = np.stack([(scores - shift) / scale, np.ones(len(scores))], 1)
    beta = np.array([0.0, np.log(pos / neg)])
    for _ in range(rounds):
        p = _sigmoid(x @ beta)
        curve = (x.T * (p * (1 - p))) @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, x.T @ (p - target) + 1e-6 * beta)
        beta -= step * min(1.0, 4 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0] / scale), float(beta[1] - beta[0] * shift / scale)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def probability(score: np.ndarray, slope: float, offset: float) -> np.ndarray:
    return _sigmoid(slope * score + offset)
