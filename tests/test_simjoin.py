"""The weighted ratio against values worked out by hand, and the similarity join against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from tidewire.functions import placecolumns, similarity
from tidewire.functions import placenames as P
from tidewire.functions.similarity import partial_ratio, partial_token_ratio, ratio, token_ratio, weighted
from tidewire.operators import simjoin

R = lambda common, total: 200 * common / total  # noqa: E731  of a common subsequence and both lengths
#: Common subsequences and lengths counted by hand; the scales are those of the definition.
BY_HAND = [
    # equal, empty, disjoint
    ("abc", "abc", 100), ("", "abc", 0), ("abc", "", 0), ("", "", 0), ("abc", "xyz", 0), ("a", "a", 100), ("a", "b", 0),
    # whole strings, one to three edits
    ("kyiv", "kyev", R(3, 8)), ("odesa", "odessa", R(5, 11)), ("lviv", "lvov", R(3, 8)), ("loja", "loga", R(3, 8)), ("nairobi", "nairoby", R(6, 14)), ("kampala", "kampalla", R(7, 15)),
    ("mombasa", "mombassa", R(7, 15)), ("peru", "per", R(3, 7)), ("ukraine", "ukrain", R(6, 13)), ("abcd", "badc", R(2, 8)), ("maynas", "mainas", R(5, 12)), ("kitten", "mitten", R(5, 12)), ("abcdefgh", "abcdefghij", R(8, 18)),
    # words in another order, or repeated
    ("city nairobi", "nairobi city", 95), ("new york", "york new", 95), ("rio de janeiro", "janeiro de rio", 95), ("la paz la paz", "paz la paz la", 95), ("san jose", "jose san", 95),
    # one is the other and more words, lengths less than one and a half times
    ("north kivu", "kivu north x", 95), ("santa cruz", "santa cruz del", 95), ("upper nile", "nile upper st", 95),
    # shared words, the rest differs: the best of the three comparisons of shared and other words
    ("port a", "port b", max(R(5, 12), 0.95 * R(5, 12), 0.95 * R(4, 10))), ("lake van", "lake tan", max(R(7, 16), 0.95 * R(7, 16))),
    # one and a half to eight times as long: the best window, or a shared word
    ("odesa", "odesa oblast", 90), ("loja", "provincia de loja", 90), ("kyiv", "kyivska", 90), ("abc", "xxabcxx", 90), ("abcd", "xxabxcdx", 0.9 * R(3, 8)),
    ("a", "bab", 90), ("ab", "zzabzz", 90), ("paris", "pari texas", 0.9 * R(4, 9)), ("cruz azul", "la cruz", max(R(5, 16), 0.95 * token_ratio("cruz azul", "la cruz"))),
    ("san luis", "luis b", max(R(5, 14), 0.95 * max(R(5, 14), R(4, 10), R(4, 12)))), ("abcdef gh", "gh", 90), ("juan", "san juan de la", 90), ("bc ab", "ab xxxxxxxxx", 0.855 * 100),
    # over eight times as long: parts count for six tenths
    ("a", "abcdefghi", 60), ("ab", "ab cdefghijklmnopq", 60), ("x", "abcdefghi", 0),
]


@pytest.mark.parametrize(("a", "b", "score"), BY_HAND)
def test_weighted_by_hand(a, b, score):
    assert weighted(a, b) == pytest.approx(score) == weighted(b, a)
    assert len(BY_HAND) > 40


def test_parts():
    assert ratio("", "") == 100 and partial_ratio("abcd", "bcde") == pytest.approx(R(3, 7)) and partial_ratio("", "a") == 0
    # Of equal lengths a window of either one: bcd and cut ends on both sides.
    assert partial_ratio("xabc", "abcy") == partial_ratio("abcy", "xabc") == pytest.approx(R(3, 7))
    assert partial_token_ratio("b a", "c b") == 100 and partial_token_ratio("aa aa", "xaax") == pytest.approx(max(partial_ratio("aa aa", "xaax"), partial_ratio("aa", "xaax")))


def names(seed, n):
    rng = random.Random(seed)
    syllables = ["ka", "ro", "san", "ta", "li", "ma", "o", "de", "sa", "kyi", "v", "lo", "ja", "an", "é"]
    out = {"a", "b", "aa aa", "x a", "ab", "axb", "la", "san", "san san", "a a a", "b b", "lolamoka"}
    while len(out) < n:
        name = " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(1, 3)))
        out.add(name)
        if rng.random() < 0.4:
            k = rng.randrange(len(name))
            out.add((name[:k] + rng.choice(["", "x", name[k] * 2]) + name[k + 1 :]).strip() or "z")
    return sorted(out)


@pytest.mark.parametrize("cutoff", [80.0, 85.0, 88.0, 93.0, 96.0])
def test_no_pair_is_lost(spark, cutoff):
    q, v = names(1, 150), names(2, 150)
    code = lambda i: ["KEN", "UGA", simjoin.ANY][i % 3]
    queries = spark.createDataFrame([(k, code(i)) for i, k in enumerate(q)] + [("", "KEN")], "key string, iso string")
    values = spark.createDataFrame([(k, code(i // 2)) for i, k in enumerate(v)], "key string, iso string")
    got = {(r.key, r.vkey): r.score for r in simjoin.similar_pairs(queries, simjoin.build_index(values), cutoff).collect()}
    want = {(a, b): s for i, a in enumerate(q) for j, b in enumerate(v) if code(i) == code(j // 2) and (s := weighted(a, b)) >= cutoff}
    assert got == pytest.approx(want) and len(want) > 2


def test_cutoffs_below_the_bounds_are_refused(spark):
    df = spark.createDataFrame([("a", "X")], "key string, iso string")
    with pytest.raises(ValueError):
        simjoin.build_index(df, 79.0)
    with pytest.raises(ValueError):
        simjoin.candidates(df, simjoin.build_index(df, 85.0), 80.0)


def test_few_pairs_are_scored(spark):
    """Of names without common words, at most one in a hundred pairs is scored."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("bcdfghklmnprstvz") + rng.choice("aeiou") for _ in range(rng.randint(3, 5)))
    v = sorted({word() for _ in range(600)})
    q = [x[:-1] for x in v[::3]]
    df = lambda names: spark.createDataFrame([(x, simjoin.ANY) for x in names], "key string, iso string")
    assert simjoin.candidates(df(q), simjoin.build_index(df(v)), 85.0).count() <= 0.01 * len(set(q)) * len(v)


def test_scores_from_a_cutoff_compare_few_windows(monkeypatch):
    """From the cutoff on the score is the whole one, by all windows; pairs below are told by their characters, mostly without comparing."""
    compared, plain_ratio = [0], similarity.ratio

    def counting(a, b):
        compared[0] += 1
        return plain_ratio(a, b)

    def windows(a, b):
        n = len(a)
        return max(plain_ratio(a, b[max(0, i) : i + n]) for i in range(1 - n, len(b)))

    monkeypatch.setattr(similarity, "ratio", counting)
    pairs = [(a, b) for a in names(1, 60) for b in names(2, 60)]
    for a, b in pairs:
        short, long_ = sorted((a, b), key=len)
        assert partial_ratio(a, b) == max(windows(short, long_), windows(long_, short) if len(a) == len(b) else 0)
    scores = [similarity.weighted_from(a, b, 0.0) for a, b in pairs]
    for cutoff in (80.0, 93.0):
        compared[0] = 0
        for (a, b), s in zip(pairs, scores):
            got = similarity.weighted_from(a, b, cutoff)
            assert got == s if s >= cutoff else got < cutoff
        assert compared[0] < sum(len(a) + len(b) - 1 for a, b in pairs) / 5  # of all windows


def test_marks_bound_the_shared_pairs(spark):
    """Postings hold numbers for the bound, not lists of pairs; the bound is never below the pairs that are shared."""
    for a in names(1, 60):
        for b in names(2, 60) + ["ab" * 150]:
            x, y = simjoin.pairs_of(a), simjoin.pairs_of(b)
            p, q = simjoin.marks_of(x), simjoin.marks_of(y)
            common = sum((p[f"m{i}"] & q[f"m{i}"] & (1 << 64) - 1).bit_count() for i in range(simjoin.MARKS))
            assert len(set(x) & set(y)) <= common + min(p["spare"], q["spare"]) and all(-(2**63) <= p[f"m{i}"] < 2**63 for i in range(simjoin.MARKS))
    index = simjoin.build_index(spark.createDataFrame([("santa rosa", "X"), ("a", "X")], "key string, iso string"))
    assert not [f.name for f in index.postings.schema if f.dataType.typeName() == "array"]


def test_each_pair_is_scored_once(spark):
    df = spark.createDataFrame([("santa rosa", "X")], "key string, iso string")
    plan = simjoin.similar_pairs(df, simjoin.build_index(df), 85.0)._jdf.queryExecution().executedPlan().toString()
    assert "weighted_column" not in plan and plan.count("MapInPandas") == 1


def test_marks_bound_the_shared_characters(spark):
    """The bound is never below the characters in common; pairs of names that have too few of them are not scored."""
    for a in names(1, 60) + ["Éa 1_é", "e" * 9]:
        for b in names(2, 60) + ["ab" * 150, "e" * 7]:
            p, q = simjoin.letter_marks(a), simjoin.letter_marks(b)
            common = sum((p[f"c{i}"] & q[f"c{i}"] & (1 << 64) - 1).bit_count() for i in range(simjoin.LETTERS))
            assert sum(min(a.count(c), b.count(c)) for c in set(a)) <= common + min(p["cspare"], q["cspare"])
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("bcdfghklmnprstvz") + rng.choice("aeiou") for _ in range(rng.randint(3, 6)))
    df = lambda names: spark.createDataFrame([(x, "X") for x in names], "key string, iso string")
    found = simjoin.candidates(df([word() for _ in range(1500)]), simjoin.build_index(df([word() for _ in range(1500)])), 80.0).collect()
    held = lambda a, b: sum(min(a.count(c), b.count(c)) for c in set(a))
    narrow = [(r.key, r.vkey) for r in found if 2 * max(len(r.key), len(r.vkey)) < 3 * min(len(r.key), len(r.vkey))]
    few = [(a, b) for a, b in narrow if 200 * held(a, b) < 80 * (len(a) + len(b))]
    assert len(narrow) > 20 and len(few) <= len(narrow) / 20  # a letter that stands five times and more may be taken for a shared one


def test_few_names_are_dealt_over_all_cores(spark):
    index = simjoin.build_index(spark.createDataFrame([(x, "X") for x in names(5, 200)], "key string, iso string"))
    assert len(index.postings.inputFiles()) >= 4


def test_many_postings_are_not_sent_to_the_driver(spark, monkeypatch):
    """Files of postings are small, their rows are not: only so many as were counted are broadcast; the pairs are the same."""
    df = lambda seed: spark.createDataFrame([(x, "X") for x in names(seed, 60)], "key string, iso string")
    index = simjoin.build_index(df(2))
    plan = lambda: simjoin.candidates(df(1), index, 85.0)._jdf.queryExecution().executedPlan().toString()
    few, sent = plan(), simjoin.similar_pairs(df(1), index, 85.0).collect()
    monkeypatch.setattr(simjoin, "SENT", index.rows - 1)
    assert index.rows == index.postings.count() and "BroadcastHashJoin" in few and "BroadcastHashJoin" not in plan() and "SortMergeJoin" in plan()
    assert sorted(simjoin.similar_pairs(df(1), index, 85.0).collect()) == sorted(sent)


def test_an_index_serves_all_higher_cutoffs(spark):
    """From one index no pair is lost at a higher cutoff; repeated words and characters, and very long names, are among them."""
    q, v = [*names(1, 120), "san san ta ta", "x" * 250, "é é"], [*names(2, 120), "san ta", "ta san san", "x" * 251, "x" * 249 + "y", "lé"]
    df = lambda keys: spark.createDataFrame([(k, "X") for k in keys], "key string, iso string")
    index = simjoin.build_index(df(v))
    for cutoff in (80.0, 88.0, 90.0, 94.0, 95.0, 96.0, 100.0):
        got = {(r.key, r.vkey): r.score for r in simjoin.similar_pairs(df(q), index, cutoff).collect()}
        assert got == pytest.approx({(a, b): s for a in q for b in v if (s := weighted(a, b)) >= cutoff})


def test_names_that_share_a_word_have_enough_characters_in_common(spark):
    """A shared first name alone is no reason to score two names of about the same length."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("bcdfghklmnprstvz") + rng.choice("aeiou") for _ in range(4))
    df = lambda keys: spark.createDataFrame([(k, "X") for k in keys], "key string, iso string")
    q, v = [f"yu {word()}" for _ in range(100)], [f"yu {word()}" for _ in range(100)]
    assert simjoin.candidates(df(q), simjoin.build_index(df(v)), 88.0).count() <= 0.05 * len(q) * len(v)


def test_word_lists_are_one_literal(spark):
    """Tests on names are copied into many expressions, so their trees are small."""
    df = spark.createDataFrame([("new york state", "york"), (None, "n/a"), ("", "")], "a string, b string")
    plan = df.select(placecolumns.clean_phrase(F.col("a")), placecolumns.is_admin_unit(F.col("a")))._jdf.queryExecution().analyzed().toString()
    assert plan.count(",") < 30
    assert [tuple(r) for r in df.select(placecolumns.is_admin_unit(F.col("a")), placecolumns.one_of(F.col("b"), P.UNKNOWN)).collect()] == [(True, False), (None, True), (False, True)]


def test_reaches_is_the_score_against_the_least(spark):
    rows = [(a, b) for a in names(1, 30) for b in names(2, 30)] + [(None, "a"), ("", "a")]
    df = spark.createDataFrame(rows, "a string, b string")
    for least in (92, 95.0):
        got = df.select("a", "b", similarity.reaches(F.col("a"), F.col("b"), least).alias("r")).collect()
        assert all(r.r is None if r.a is None else r.r == (weighted(r.a, r.b) >= least) for r in got)
