"""Nearest neighbours by inner product on vectors of very different lengths, odd first rows and few rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewire.llm import ann_partitions

VECTORS = "vec_id bigint, embedding array<double>"


def recall(spark, x, more=()):
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + list(more)
    got = ann_partitions.nearest_neighbours(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 20 == 0).collect()
    found = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append(r.vec_id)
        assert r.score == ann_partitions.exact_scores(x[r.query_id], x[r.vec_id : r.vec_id + 1])[0]
    assert set(found) == set(range(0, len(x), 20)) and all(len(v) == len(set(v)) == 20 for v in found.values())
    hit = 0
    for q, ids in found.items():
        score = ann_partitions.exact_scores(x[q], x)
        score[q] = -np.inf
        hit += len(set(ids) & set(np.lexsort((np.arange(len(x)), -score))[:20].tolist()))
    return hit / (20 * len(found))


@pytest.mark.parametrize("sigma", [0.0, 1.0, 1.5])
def test_recall_by_length(spark, sigma):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(40, 24))
    x = centres[rng.integers(0, 40, 4000)] + 0.5 * rng.normal(size=(4000, 24))
    x = x / np.linalg.norm(x, axis=1, keepdims=True) * np.exp(sigma * rng.normal(size=(4000, 1)))
    assert recall(spark, x) >= 0.9


def test_odd_first_rows_take_no_part(spark):
    """The length of most vectors counts, not that of any one row."""
    x = np.random.default_rng(9).normal(size=(2000, 8))
    odd = [(10_000 + i, [1.0] * (3 + i % 2)) for i in range(300)]  # one of them has the smallest hash
    assert recall(spark, x, odd) >= 0.9


def test_parts_with_few_rows_are_widened(spark):
    """Each query gets its 20 rows, although most parts hold fewer."""
    x = np.random.default_rng(10).normal(size=(700, 4))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], VECTORS)
    got = ann_partitions.nearest_neighbours(rows, F.col("vec_id") % 20 == 0, parts=50, recall=0.01, sample_rows=10_000).groupBy("query_id").count().collect()
    assert len(got) == 35 and all(r["count"] == 20 for r in got)


def test_hot_vector_is_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann_partitions, "LEAST_BLOCK", 256)
    rng = np.random.default_rng(11)
    x = ann_partitions.unit(rng.normal(size=(2400, 8)))
    x[800:1600] = x[0]
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], VECTORS)
    got = {}
    for r in ann_partitions.nearest_neighbours(rows, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got[0] == list(range(800, 820)) and got[800] == [0, *range(801, 820)]  # ties go to the smaller id


def test_large_numbers(spark):
    rows = [(i, [1e200 * (i + 1), -1e200, 1.0]) for i in range(70)]
    got = ann_partitions.nearest_neighbours(spark.createDataFrame(rows, VECTORS), F.col("vec_id") == 0).collect()
    assert len(got) == 20
