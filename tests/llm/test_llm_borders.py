"""Results must not depend on the sizes at which operators cut their work."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewire.llm import common, quality_nbsvm, textmodels, toxicity_ftrl


@pytest.mark.parametrize("make", [textmodels.QualityFeatures, textmodels.ToxicFeatures])
@pytest.mark.parametrize("chunk", [1, 2, 3, 5, 64])
def test_chunks_give_the_features_of_the_whole_text(monkeypatch, make, chunk):
    rng = random.Random(chunk)
    texts = ["Ab ab ab ab AB cd CD cd", "a", "", "one two", *(" ".join(rng.choice(["ab", "Ab", "cd", "12", "!?", "X", "zzz..."]) for _ in range(300)) for _ in range(5))]
    whole = [textmodels.indices(t, make()).tolist() for t in texts]
    monkeypatch.setattr(textmodels, "_CHUNK", chunk)
    assert [textmodels.indices(t, make()).tolist() for t in texts] == whole


def test_text_longer_than_a_chunk():
    text = "Word, word and word again! " * 20_000  # 140,000 tokens
    marked = set(textmodels.indices("Word, word and word again! " * 4, textmodels.QualityFeatures()).tolist())
    assert set(textmodels.indices(text, textmodels.QualityFeatures()).tolist()) == marked


def test_long_punctuation_is_read_whole():
    a, b = (textmodels.indices("x " + "!" * 8 + tail, textmodels.QualityFeatures()).tolist() for tail in ("!", "?"))
    assert a != b


def test_samples_are_bounded_in_bytes(spark, odd_docs, labels):
    learn = F.lit(True)
    y, x = textmodels.training_set(odd_docs, labels, "quality", learn, textmodels.QualityFeatures, 100)
    assert len(y) == len(x) > 10
    most = sum(v.nbytes for v in x) // 2
    few_y, few_x = textmodels.training_set(odd_docs, labels, "quality", learn, textmodels.QualityFeatures, 100, most)
    assert 0 < len(few_y) < len(y) and sum(v.nbytes for v in few_x) <= most
    assert all(any(np.array_equal(v, w) for w in x) for v in few_x)
    none, _ = textmodels.training_set(odd_docs, labels, "quality", learn, textmodels.QualityFeatures, 100, 0)
    assert len(none) == 0 or all(v.nbytes == 0 for v in textmodels.training_set(odd_docs, labels, "quality", learn, textmodels.QualityFeatures, 100, 0)[1])


def test_no_machine_local_folder_on_a_cluster():
    class Conf:
        get = staticmethod(lambda *_: None)

    class Session:
        class sparkContext:  # noqa: N801
            master = "spark://host:7077"
            getConf = staticmethod(Conf)  # noqa: N815

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.scratch_root(Session)
    Session.sparkContext.master = "local-cluster[2,1,1024]"
    with pytest.raises(ValueError):
        common.scratch_root(Session)


# ---- plain versions of the two fits

def plain_nbsvm(y, x, bits, c=1.0, rounds=20, seed=7):
    """Log-count ratios and dual coordinate descent over dictionaries, one number at a time."""
    count = [{}, {}]
    for label, row in zip(y, x):
        for f in row:
            count[label][f] = count[label].get(f, 0) + 1
    total = [2**bits + sum(d.values()) for d in count]
    ratio = {f: np.log((count[1].get(f, 0) + 1) / total[1]) - np.log((count[0].get(f, 0) + 1) / total[0]) for f in {f for row in x for f in row}}
    rest = np.log(1 / total[1]) - np.log(1 / total[0])
    rows = []
    for row in x:
        length = sum(ratio[f] ** 2 for f in row) ** 0.5 or 1.0
        rows.append({f: ratio[f] / length for f in row})
    cost = [c * len(y) / (2 * max(1, y.count(k))) for k in (0, 1)]
    w, b, alpha, rng = {}, 0.0, [0.0] * len(y), np.random.default_rng(seed)
    for _ in range(rounds):
        worst = 0.0
        for k in rng.permutation(len(y)):
            sign = 1 if y[k] else -1
            g = sign * (sum(w.get(f, 0) * v for f, v in rows[k].items()) + b) - 1
            projected = min(g, 0) if alpha[k] == 0 else max(g, 0) if alpha[k] == cost[y[k]] else g
            if abs(projected) < 1e-12:
                continue
            worst = max(worst, abs(projected))
            new = min(max(alpha[k] - g / (sum(v * v for v in rows[k].values()) + 1), 0.0), cost[y[k]])
            for f, v in rows[k].items():
                w[f] = w.get(f, 0) + (new - alpha[k]) * sign * v
            b += (new - alpha[k]) * sign
            alpha[k] = new
        if worst < 1e-3:
            break
    return ratio, rest, w, b


def test_nbsvm_against_plain_version():
    rng = np.random.default_rng(0)
    y = [int(k % 3 > 0) for k in range(40)]
    x = [np.unique(np.r_[rng.integers(0, 30, 6), 40 + label * 3 + rng.integers(0, 4, 2)]).astype(np.int32) for label in y]
    r = quality_nbsvm.log_count_ratios(np.array(y), x)
    w, b = quality_nbsvm.dual_coordinate_descent(np.array(y), x, r)
    ratio, rest, plain_w, plain_b = plain_nbsvm(y, [row.tolist() for row in x], textmodels.QualityFeatures.bits)
    assert all(abs(r[f] - v) < 1e-9 for f, v in ratio.items()) and abs(r[-1] - rest) < 1e-9
    assert abs(b - plain_b) < 1e-6 and all(abs(w[f] - v) < 1e-6 for f, v in plain_w.items())


def plain_ftrl(y, x, alpha=1.0, beta=1.0, l1=20.0, l2=1.0, rounds=6, seed=11):
    z, n, rng = {}, {}, np.random.default_rng(seed)
    heavy = min(10.0, max(1.0, y.count(0) / max(1, y.count(1))))

    def weight(f):
        penalty = 0.0 if f == "bias" else l1
        if abs(z.get(f, 0.0)) <= penalty:
            return 0.0
        return -(z[f] - np.sign(z[f]) * penalty) / ((beta + n.get(f, 0.0) ** 0.5) / alpha + l2)

    for _ in range(rounds):
        for k in rng.permutation(len(y)):
            row = [*x[k], "bias"]
            w = {f: weight(f) for f in row}
            g = (1 / (1 + np.exp(-sum(w.values()))) - y[k]) * (heavy if y[k] else 1.0)
            for f in row:
                sigma = ((n.get(f, 0.0) + g * g) ** 0.5 - n.get(f, 0.0) ** 0.5) / alpha
                z[f] = z.get(f, 0.0) + g - sigma * w[f]
                n[f] = n.get(f, 0.0) + g * g
    return {f: weight(f) for f in z}


def test_ftrl_against_plain_version():
    rng = np.random.default_rng(1)
    y = [int(k % 4 == 0) for k in range(200)]
    x = [np.unique(np.r_[rng.integers(0, 30, 6), 40 + label * 3 + rng.integers(0, 3, 2)]).astype(np.int32) for label in y]
    w, b = toxicity_ftrl.ftrl(np.array(y), x, l1=2.0)
    plain = plain_ftrl(y, [row.tolist() for row in x], l1=2.0)
    assert abs(b - plain.pop("bias")) < 1e-6 and all(abs(w[f] - v) < 1e-6 for f, v in plain.items())
    assert 0 < np.count_nonzero(w) < len(plain) and set(np.flatnonzero(w)) <= set(plain)  # L1 leaves some features out


def test_held_out_toxic_labels_change_nothing(spark, odd_docs, labels):
    flipped = labels.withColumn("toxic", F.when(textmodels.fold(5) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    key = lambda df: sorted((str(r["doc_id"]), r["score"]) for r in toxicity_ftrl.score_toxicity(odd_docs, df).collect())
    assert key(labels) == key(flipped)
