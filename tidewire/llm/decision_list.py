"""Quality rules: a decision list learned by sequential covering, applied as one Spark expression.

``text_statistics`` computes the statistics of every text with built-in functions only.
``learn_decision_list`` grows conjunctions of thresholds on two thirds of a bounded labelled
sample, prunes them on the rest, and ``DecisionList.expression`` turns the ordered rules into a
chain of ``CASE WHEN`` conditions.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import SPACES, label_sample, words

#: The symbols that the contract counts.
SYMBOLS = "[#*$%&|<>]"
#: Ratios that rules may test; each is derived from the counts of ``text_statistics``.
FEATURES = ("n_words", "mean_word_chars", "symbol_ratio", "dup_line_ratio", "repeat_ratio", "upper_ratio", "shout_ratio", "distinct_ratio")


def text_statistics(df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per input row: the columns of ``keep`` and the counts of its whole text.

    Null and empty texts give zeros. Repeated rows stay repeated; other columns are left out, so
    that columns with clashing names do no harm.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = df.select(F.struct(*[F.col(c) for c in keep]).alias("k"), text.alias("t"))
    split = base.select(
        "k",
        words(F.col("t")).alias("w"),
        F.filter(F.split("t", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "").alias("lines"),
        (F.length("t") - F.length(F.regexp_replace("t", f"{SYMBOLS}+", ""))).cast("long").alias("n_symbols"),
        (F.length("t") - F.length(F.regexp_replace("t", r"\p{Lu}+", ""))).cast("long").alias("n_upper"),
        (F.length("t") - F.length(F.regexp_replace("t", "!+", ""))).cast("long").alias("n_shouts"),
    )
    hashed = split.select(
        "k", "n_symbols", "n_upper", "n_shouts", "w",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(
            F.size("w") >= 3,
            F.transform(F.sequence(F.lit(0), F.size("w") - 3), lambda i: F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2))),
        ).otherwise(F.array().cast("array<bigint>")).alias("h"),
    )
    # Sorting pairs of hash and place brings equal windows together; texts without a repeat skip it.
    placed = hashed.select(
        "k", "n_symbols", "n_upper", "n_shouts", "n_dup_lines",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.size(F.array_distinct("w")).cast("long").alias("n_distinct_words"),
        F.when(F.size(F.array_distinct("h")) < F.size("h"), F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))).alias("s"),
    )
    repeated = placed.select(
        "k", "n_symbols", "n_upper", "n_shouts", "n_dup_lines", "n_words", "word_chars", "n_distinct_words",
        F.sort_array(
            F.transform(
                F.filter("s", lambda x, j: x["h"].eqNullSafe(F.get("s", j + 1)["h"]) | x["h"].eqNullSafe(F.when(j > 0, F.get("s", j - 1)["h"]))),
                lambda x: x["i"],
            )
        ).alias("p"),
    )
    covered = F.aggregate(
        "p",
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda a, p: F.struct((p + 3).alias("end"), (a["n"] + (p + 3 - F.greatest(p, a["end"])).cast("long")).alias("n")),
        lambda a: a["n"],
    )
    out = repeated.select(
        F.struct(
            *[F.col("k")[c].alias(c) for c in keep],
            "n_words", "word_chars", "n_symbols", "n_dup_lines",
            F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"),
            "n_upper", "n_shouts", "n_distinct_words",
        ).alias("row")
    )
    # Filters on the counts must stay above this: pushed below, they would evaluate the arrays anew for each element.
    return out.select(F.inline(F.array("row")))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def features() -> dict[str, Column]:
    n, c = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    return {
        "n_words": F.col("n_words").cast("double"),
        "mean_word_chars": F.col("word_chars") / n,
        "symbol_ratio": F.col("n_symbols") / c,
        "dup_line_ratio": F.col("n_dup_lines") / n,
        "repeat_ratio": F.col("n_repeat_words") / n,
        "upper_ratio": F.col("n_upper") / c,
        "shout_ratio": F.col("n_shouts") / c,
        "distinct_ratio": F.col("n_distinct_words") / n,
    }


@dataclass
class Rule:
    """A conjunction of (feature, is_upper_bound, threshold)."""

    tests: list[tuple[str, bool, float]]

    def covers(self, x: dict[str, np.ndarray]) -> np.ndarray:
        out = np.ones(len(next(iter(x.values()))), bool)
        for f, below, t in self.tests:
            out &= (x[f] <= t) if below else (x[f] > t)
        return out

    def condition(self, cols: dict[str, Column]) -> Column:
        out = F.lit(True)
        for f, below, t in self.tests:
            out = out & ((cols[f] <= F.lit(t)) if below else (cols[f] > F.lit(t)))
        return out

    def __str__(self) -> str:
        return " AND ".join(f"{f} {'<=' if below else '>'} {t:.6g}" for f, below, t in self.tests)


@dataclass
class DecisionList:
    """Ordered rules that reject; what none covers is kept."""

    rules: list[Rule] = field(default_factory=list)

    def expression(self) -> Column:
        cols = features()
        if not self.rules:
            return F.lit(True)
        chain = F.when(self.rules[0].condition(cols), F.lit(False))
        for rule in self.rules[1:]:
            chain = chain.when(rule.condition(cols), F.lit(False))
        return chain.otherwise(F.lit(True))

    def accepts(self, x: dict[str, np.ndarray]) -> np.ndarray:
        out = np.ones(len(next(iter(x.values()))), bool)
        for rule in self.rules:
            out &= ~rule.covers(x)
        return out


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, cuts: dict[str, np.ndarray], most_tests: int) -> Rule:
    """Add the test with the largest information gain until no good row is covered."""
    tests: list[tuple[str, bool, float]] = []
    inside = np.ones(len(bad), bool)
    while len(tests) < most_tests:
        p, n = int((inside & bad).sum()), int((inside & ~bad).sum())
        if not n or not p:
            break
        now, best = np.log2(p / (p + n)), (1e-9, None)
        for f, at in cuts.items():
            v = x[f][inside]
            b = bad[inside]
            order = np.argsort(v, kind="stable")
            upto = np.searchsorted(v[order], at, side="right")
            pos = np.concatenate(([0], np.cumsum(b[order])))[upto]
            neg = upto - pos
            for below, (pp, nn) in ((True, (pos, neg)), (False, (p - pos, n - neg))):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(pp > 0, pp * (np.log2(pp / (pp + nn)) - now), -1)
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (float(gain[k]), (f, below, float(at[k])))
        if best[1] is None:
            break
        tests.append(best[1])
        inside &= Rule([best[1]]).covers(x)
    return Rule(tests)


def _prune(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """Drop final tests while (p - n) / (p + n) on the held-back rows doesn't fall."""
    def worth(r: Rule) -> float:
        c = r.covers(x)
        p, n = int((c & bad).sum()), int((c & ~bad).sum())
        return (p - n) / (p + n) if p + n else -1.0

    best, at = rule, worth(rule)
    for k in range(len(rule.tests) - 1, 0, -1):
        shorter = Rule(rule.tests[:k])
        if (w := worth(shorter)) >= at:
            best, at = shorter, w
    return best


def _thresholds(v: np.ndarray, cuts: int) -> np.ndarray:
    """Midpoints between neighbouring quantiles, so that a rule leaves room on both sides."""
    q = np.unique(np.quantile(v, np.linspace(0, 1, cuts + 1), method="lower"))
    return (q[1:] + q[:-1]) / 2 if len(q) > 1 else q


def learn_decision_list(x: dict[str, np.ndarray], good: np.ndarray, keys: np.ndarray, most_rules: int = 16, most_tests: int = 4, least_precision: float = 0.95, cuts: int = 64) -> DecisionList:
    """Sequential covering of the rejected class; ``keys`` deals rows into growing and pruning sets."""
    bad, out = ~good, DecisionList()
    if not len(bad) or bad.all() or good.all():
        return out
    left = np.ones(len(bad), bool)
    grow_set = np.array([zlib.crc32(str(k).encode()) % 3 != 0 for k in keys])
    at = {f: _thresholds(v, cuts) for f, v in x.items()}
    for _ in range(most_rules):
        g, p = left & grow_set, left & ~grow_set
        if not (g & bad).any():
            break
        rule = _grow({f: v[g] for f, v in x.items()}, bad[g], at, most_tests)
        if not rule.tests:
            break
        if p.any():
            rule = _prune(rule, {f: v[p] for f, v in x.items()}, bad[p])
        c = rule.covers(x) & left
        hits, misses = int((c & bad).sum()), int((c & good).sum())
        if hits < 2 or hits / (hits + misses) < least_precision:
            break
        out.rules.append(rule)
        left &= ~c
    return out


def fit_quality_rules(docs: DataFrame, labels: DataFrame, sample_rows: int = 12_000) -> DecisionList:
    """Learn from at most ``sample_rows`` labelled documents (smallest hashes of doc_id).

    The bound holds what the driver gathers: one short row of numbers per sampled document.
    An empty sample, or one of a single class, gives a list without rules, which keeps all.
    """
    chosen = label_sample(labels, "quality", sample_rows)
    rows = text_statistics(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), keep=("doc_id", "label"))
    cols = features()
    numbers = rows.where(~base_failed()).select("doc_id", "label", F.struct(*[cols[f].alias(f) for f in FEATURES]).alias("x"))
    got = numbers.groupBy("doc_id", "label").agg(F.min("x").alias("x")).select("doc_id", "label", "x.*").collect()  # a repeated doc_id counts once
    got.sort(key=lambda r: r["doc_id"])
    x = {f: np.array([r[f] for r in got], float) for f in FEATURES}
    return learn_decision_list(x, np.array([r["label"] == 1 for r in got], bool), np.array([r["doc_id"] for r in got]))


def apply_quality_rules(docs: DataFrame, rules: DecisionList, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per input row: the columns of ``keep``, statistics, ``base_failed`` and ``kept``.

    Null and empty texts have zeros and fail the base rule; texts of any length are read whole;
    repeated rows are judged each, and alike; columns whose names clash with those made here are left
    out unless ``keep`` asks for them; an empty table gives an empty result.
    """
    stats = text_statistics(docs, keep=keep)
    return stats.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & rules.expression())
