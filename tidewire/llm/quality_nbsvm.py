"""Quality classifier: support vectors over naive Bayes features.

Every n-gram indicator is scaled by its class log-count ratio, and a linear hinge-loss model is fitted
to the scaled indicators by dual coordinate descent.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.textmodels import QualityFeatures, fold, score_texts, training_set

#: The bound of the labelled sample; the driver gathers about 5 KB a document.
SAMPLE_ROWS = 8_000


def log_count_ratios(y: np.ndarray, x: list[np.ndarray], smooth: float = 1.0) -> np.ndarray:
    counts = np.full((2, 1 << QualityFeatures.bits), smooth)
    for label, i in zip(y, x):
        counts[label, i] += 1
    share = counts / counts.sum(axis=1, keepdims=True)
    return np.log(share[1] / share[0])


def dual_coordinate_descent(y: np.ndarray, x: list[np.ndarray], scale: np.ndarray, c: float = 1.0, rounds: int = 20, tolerance: float = 1e-3, seed: int = 7) -> tuple[np.ndarray, float]:
    """L2-regularized hinge loss; rows are normalized, and a constant feature carries the bias.

    Each class gets the same total cost. Returns the weights of the scaled, normalized indicators
    and the bias.
    """
    rng, w, b = np.random.default_rng(seed), np.zeros(len(scale)), 0.0
    sign = np.where(y == 1, 1.0, -1.0)
    values = [scale[i] / (np.linalg.norm(scale[i]) or 1.0) for i in x]
    upper = np.where(y == 1, c * len(y) / (2 * max(1, (y == 1).sum())), c * len(y) / (2 * max(1, (y == 0).sum())))
    alpha, q = np.zeros(len(y)), np.array([v @ v + 1 for v in values])
    for _ in range(rounds):
        worst = 0.0
        for k in rng.permutation(len(y)):
            i, v, s = x[k], values[k], sign[k]
            g = s * (w[i] @ v + b) - 1
            pg = min(g, 0) if alpha[k] == 0 else max(g, 0) if alpha[k] == upper[k] else g
            if abs(pg) < 1e-12:
                continue
            worst = max(worst, abs(pg))
            new = min(max(alpha[k] - g / q[k], 0.0), upper[k])
            step = (new - alpha[k]) * s
            alpha[k] = new
            w[i] += step * v
            b += step
        if worst < tolerance:
            break
    return w, b


def fit(docs: DataFrame, labels: DataFrame, learn: Column, sample_rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, np.ndarray, float]:
    """Scale ``r``, weights ``w`` and bias; without both classes in the sample a constant model."""
    y, x = training_set(docs, labels, "quality", learn, QualityFeatures, sample_rows)
    r = log_count_ratios(y, x)
    if len(np.unique(y)) < 2:
        return r, np.zeros(1 << QualityFeatures.bits), 1.0 if not len(y) or y[0] == 1 else -1.0
    w, b = dual_coordinate_descent(y, x, r)
    return r, w, b


def score_quality(docs: DataFrame, labels: DataFrame, modulus: int = 3, held_out: int = 1, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of every document.

    Labels of held-out rows are never read into the fit. Null and empty texts get the score of the
    bias; texts of any length are read whole; repeated rows get equal scores; other columns are not
    read, so clashing names do no harm; an empty table gives an empty result.
    """
    r, w, b = fit(docs, labels, fold(modulus) != held_out, sample_rows)
    out = score_texts(docs, w * r, b, QualityFeatures, norm=r, sharpness=4.0)
    return out.select("doc_id", (fold(modulus) == held_out).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
