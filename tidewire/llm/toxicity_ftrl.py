"""Toxicity: logistic regression by FTRL-proximal over hashed word n-grams and skip-grams.

Per-coordinate learning rates and L1 leave few non-zero weights, which are small to broadcast.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.textmodels import ToxicFeatures, fold, score_texts, training_set

#: The bound of the labelled sample; the driver gathers about 8 KB a document.
SAMPLE_ROWS = 7_000


def ftrl(y: np.ndarray, x: list[np.ndarray], alpha: float = 1.0, beta: float = 1.0, l1: float = 20.0, l2: float = 1.0, rounds: int = 6, seed: int = 11) -> tuple[np.ndarray, float]:
    """Weights and bias; the rarer class is weighted up to at most ten times."""
    rng = np.random.default_rng(seed)
    z, n = np.zeros((1 << ToxicFeatures.bits) + 1), np.zeros((1 << ToxicFeatures.bits) + 1)
    bias = 1 << ToxicFeatures.bits
    positive = max(1, int((y == 1).sum()))
    heavy = min(10.0, max(1.0, (len(y) - positive) / positive))

    def weights(i: np.ndarray) -> np.ndarray:
        zi, l1_ = z[i], np.where(i == bias, 0.0, l1)
        return np.where(np.abs(zi) <= l1_, 0.0, -(zi - np.sign(zi) * l1_) / ((beta + np.sqrt(n[i])) / alpha + l2))

    for _ in range(rounds):
        for k in rng.permutation(len(y)):
            i = np.append(x[k], np.int32(bias))
            w = weights(i)
            p = 1 / (1 + np.exp(-min(max(w.sum(), -35.0), 35.0)))
            g = (p - y[k]) * (heavy if y[k] else 1.0)
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            z[i] += g - sigma * w
            n[i] += g * g
    out = np.zeros(bias + 1)
    used = np.flatnonzero(z)
    out[used] = weights(used)
    return out[:bias], float(out[bias])


def score_toxicity(docs: DataFrame, labels: DataFrame, modulus: int = 5, held_out: int = 0, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of every document.

    Labels of held-out rows are never read into the fit. Null and empty texts get the score of the
    bias; texts of any length are read whole; repeated rows get equal scores; other columns are not
    read, so clashing names do no harm; an empty table gives an empty result. Without both classes
    in the sample the model is constant.
    """
    y, x = training_set(docs, labels, "toxic", fold(modulus) != held_out, ToxicFeatures, sample_rows)
    w, b = ftrl(y, x) if len(np.unique(y)) == 2 else (np.zeros(1 << ToxicFeatures.bits), 1.0 if len(y) and y[0] == 1 else -1.0)
    out = score_texts(docs, w, b, ToxicFeatures)
    return out.select("doc_id", (fold(modulus) == held_out).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
