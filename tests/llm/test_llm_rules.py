"""Sequential covering against a plain version that tries every test on every row."""

import math
import zlib

import numpy as np
import pytest

from tidewire.llm import decision_list


def holds(row, test):
    f, below, t = test
    return row[f] <= t if below else row[f] > t


def plain_rules(x, good, keys, most_rules=16, most_tests=4, least_precision=0.95, cuts=64):
    names = list(x)
    rows = [{f: float(x[f][k]) for f in names} for k in range(len(good))]
    bad = [not g for g in good]
    grow_set = [zlib.crc32(str(k).encode()) % 3 != 0 for k in keys]
    at = {f: decision_list._thresholds(x[f], cuts).tolist() for f in names}
    left, out = set(range(len(rows))), []
    while len(out) < most_rules:
        grow, prune = [k for k in left if grow_set[k]], [k for k in left if not grow_set[k]]
        if not any(bad[k] for k in grow):
            break
        tests, inside = [], grow
        while len(tests) < most_tests:
            p, n = sum(bad[k] for k in inside), sum(not bad[k] for k in inside)
            if not p or not n:
                break
            best = (1e-9, None)
            for f in names:  # of equal gains the first feature, then the upper bound, then the lower threshold counts
                for below in (True, False):
                    for t in at[f]:
                        chosen = [k for k in inside if holds(rows[k], (f, below, t))]
                        pp = sum(bad[k] for k in chosen)
                        gain = pp * (math.log2(pp / len(chosen)) - math.log2(p / (p + n))) if pp else -1
                        if gain > best[0] + 1e-12:
                            best = (gain, (f, below, t))
            if best[1] is None:
                break
            tests.append(best[1])
            inside = [k for k in inside if holds(rows[k], best[1])]
        if not tests:
            break

        def worth(n_tests):
            covered = [k for k in prune if all(holds(rows[k], t) for t in tests[:n_tests])]
            p = sum(bad[k] for k in covered)
            return (2 * p - len(covered)) / len(covered) if covered else -1.0

        if prune:
            n_best, top = len(tests), worth(len(tests))
            for n_tests in range(len(tests) - 1, 0, -1):
                if worth(n_tests) >= top:
                    n_best, top = n_tests, worth(n_tests)
            tests = tests[:n_best]
        covered = {k for k in left if all(holds(rows[k], t) for t in tests)}
        hits = sum(bad[k] for k in covered)
        if hits < 2 or hits / len(covered) < least_precision:
            break
        out.append(tests)
        left -= covered
    return out


@pytest.mark.parametrize("seed", range(6))
def test_rules_against_plain_version(seed):
    rng = np.random.default_rng(seed)
    n = 240
    x = {"a": rng.random(n), "b": np.round(rng.random(n), 1), "c": rng.integers(0, 4, n).astype(float)}
    bad = (x["a"] > 0.7) & (x["b"] <= 0.5) | (x["c"] == 3) & (x["a"] < 0.3)
    bad ^= rng.random(n) < 0.004 * (seed % 3)
    got = decision_list.learn_decision_list(x, ~bad, np.arange(n), cuts=12)
    want = plain_rules(x, ~bad, np.arange(n), cuts=12)
    assert [[tuple(t) for t in r.tests] for r in got.rules] == want and (want or seed % 3 == 2)  # with noise there may be none


def test_rules_apply_in_order(spark):
    from pyspark.sql import functions as F

    rules = decision_list.DecisionList([decision_list.Rule([("n_words", True, 10.0)]), decision_list.Rule([("symbol_ratio", False, 0.5), ("n_words", False, 20.0)])])
    rows = [(float(n), float(s)) for n in (5, 10, 11, 20, 21, 50) for s in (0, 0.5, 0.6)]
    columns = {c: F.lit(1) for c in ("word_chars", "n_dup_lines", "n_repeat_words", "n_upper", "n_shouts", "n_distinct_words")}
    df = spark.createDataFrame(rows, "n_words double, n_symbols double").withColumns(columns)
    got = {(r.n_words, r.n_symbols): r.ok for r in df.select("n_words", "n_symbols", rules.expression().alias("ok")).collect()}
    assert got == {(n, s): not (n <= 10 or s > 0.5 and n > 20) for n, s in rows}
    x = {"n_words": np.array([n for n, _ in rows]), "symbol_ratio": np.array([s for _, s in rows])}
    assert rules.accepts(x).tolist() == [got[r] for r in rows]
