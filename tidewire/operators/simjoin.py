"""Similarity join: all pairs of names whose weighted score reaches a cutoff, without comparing all pairs.

A score that reaches the cutoff leaves traces that a join can find. With ``L`` the length of the longest
common subsequence of two strings of lengths n <= m, all but n + m - 2 L of its L + 1 neighbouring
places, both ends counted, are neighbours in both strings, so the strings share at least 3 L + 1 - n - m
pairs of neighbouring characters. The cutoff says how long L must be at least: for the whole strings, or for
the shorter one and a window of the longer one. Sorting a name's words, or dropping repeated ones, gives it
further forms to which the same holds; and names that share a word may reach the cutoff by that alone.

Of the shorter string's pairs, only as many of the rarest are looked up as are sure to include a shared
one. Candidates then must share as many pairs as the bound says, and as many characters, whatever their order,
as the common subsequence has; the ones that may are scored, each once. How many are shared at most is read off
marks, one bit a pair and one a character, so postings hold numbers and no lists.
The values' postings are made once, as an index, and serve all queries and all cutoffs from the least on.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, floor
from zlib import crc32

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions.similarity import weighted_from
from tidewire.plans.staging import staged

#: Fixed values of the score: what partial and token comparisons are scaled by, from and up to which ratio of lengths parts count.
PARTIAL, TOKENS, LEAST_RATIO, MOST_RATIO = 0.9, 0.95, 1.5, 8
#: The bounds hold from this cutoff on.
LEAST_CUTOFF = 80.0
#: The key under which names stand whose code doesn't matter.
ANY = "*"
#: So many of the most frequent pairs are told apart when a name's rarest are chosen; the choice changes no result.
FREQUENT = 5000
#: Up to this length it is looked up how many pairs of a value count at a higher cutoff than the index's.
LONG = 200
_EDGE = "\u0001"
#: 64-bit words of a form's marks of pairs, and of characters.
MARKS, LETTERS = 4, 2
_PAIRS, _CHARS = ["spare", *[f"m{i}" for i in range(MARKS)]], ["cspare", *[f"c{i}" for i in range(LETTERS)]]
_MARKS = [*_PAIRS, *_CHARS]
_EPSILON = 1e-9
#: Postings up to so many are sent to every task; more are met sorted, as the size of their files says little about the memory that they take.
SENT = 50_000
#: What a posting says: the query is the shorter one, or the value; a word; the query is a single character, or the value.
_QUERY_SHORT, _VALUE_SHORT, _WORD, _QUERY_LONE, _VALUE_LONE = range(5)


def pairs_of(s: str) -> list[str]:
    """The pairs of neighbouring characters, both ends counted, with how often each came before."""
    padded, seen, out = f"{_EDGE}{s}{_EDGE}", Counter(), []
    for i in range(len(s) + 1):
        pair = padded[i : i + 2]
        seen[pair] += 1
        out.append(f"{pair}{seen[pair]}")
    return out


def marks_of(pairs: list[str]) -> dict[str, int]:
    """Words of marks, one bit for each pair by its hash, and ``spare``: how many pairs found their bit taken.

    Two forms share at most as many pairs as they have marks in common and the lesser has spare ones: of
    any of its pairs, no more than ``spare`` can lack a bit of their own.
    """
    bits = 0
    for p in pairs:
        bits |= 1 << crc32(p.encode()) % (64 * MARKS)
    return _words(_PAIRS, len(pairs), bits)


def letter_marks(s: str) -> dict[str, int]:
    """Likewise of characters: the first four of each of a to z have bits of their own, others share the rest."""
    bits, seen = 0, Counter()
    for c in s:
        seen[c] += 1
        k = ord(c) - ord("a")
        bits |= 1 << (4 * k + min(seen[c], 4) - 1 if 0 <= k < 26 else 104 + (3 * ord(c) + seen[c]) % 24)
    return _words(_CHARS, len(s), bits)


def _words(names: list[str], n: int, bits: int) -> dict[str, int]:
    """The 64-bit words of the marks of ``n`` things, and how many of these have no bit of their own."""
    words = [bits >> 64 * i & (1 << 64) - 1 for i in range(len(names) - 1)]
    return {names[0]: n - bits.bit_count()} | {c: w - (w >> 63 << 64) for c, w in zip(names[1:], words)}


def shared_at_most(names: list[str]) -> Column:
    """How many things a query's form and a value's (``v``) share at most, by their marks ``names``."""
    out = F.least(names[0], f"v{names[0]}")
    for c in names[1:]:
        out = out + F.bit_count(F.col(c).bitwiseAND(F.col(f"v{c}")))
    return out


def forms_of(key: str) -> list[str]:
    """The name, its words sorted, and its distinct words sorted."""
    words = key.split()
    return list(dict.fromkeys([key, " ".join(sorted(words)), " ".join(sorted(set(words)))]))


def least_common(n: Column, m: Column, cutoff: float) -> Column:
    """The least length of a common subsequence with which strings of lengths n and m reach the cutoff as wholes."""
    return F.ceil(F.lit(cutoff / 200) * (n + m) - _EPSILON)


def least_shared(n: Column, m: Column, cutoff: float, parts: Column | None = None) -> Column:
    """How many pairs forms of lengths n <= m share at least if their score reaches the cutoff; null if it can't.

    Whether ``parts`` count depends on the lengths of the names, not of their forms; if that isn't said, they may.
    """
    common = least_common(n, m, cutoff)
    whole = F.when(common <= n, common * 3 + 1 - n - m)
    r = cutoff / 100 / PARTIAL
    if r > 1:
        return whole
    # The window is at least r n / (2 - r) long, or its common subsequence would be longer than itself; the ends needn't be shared.
    inside = F.greatest(F.ceil((1.5 * r - 1) * 2 * n / (2 - r) - 1 - _EPSILON), F.lit(1))
    return F.least(whole, inside if parts is None else F.when(parts, inside))  # skips nulls


def least_letters(n: Column, m: Column, cutoff: float, parts: Column) -> Column:
    """How long the common subsequence of the forms is at least, of the longer one or of its window; null if they can't reach the cutoff."""
    common = least_common(n, m, cutoff)
    whole = F.when(common <= n, common)
    r = cutoff / 100 / PARTIAL
    return whole if r > 1 else F.least(whole, F.when(parts, F.ceil(r * n / (2 - r) - _EPSILON)))


def least_of_short(n: int, cutoff: float) -> int:
    """The least of ``least_shared`` over all longer strings."""
    r, best = cutoff / 100, None
    for m in range(n, floor(n * (2 - r) / r) + 2):
        common = ceil(r / 2 * (n + m) - _EPSILON)
        if common <= n:
            best = min(best or n + 1, 3 * common + 1 - n - m)
    r /= PARTIAL
    if r <= 1:
        best = min(best or n + 1, max(1, ceil((1.5 * r - 1) * 2 * n / (2 - r) - 1 - _EPSILON)))
    return max(1, best or 1)


def _sure(n: int, cutoff: float) -> int:
    """Of a form's pairs so many can't all be unshared."""
    return max(1, n + 2 - least_of_short(n, cutoff))


def _is_sure(cutoff: float) -> Column:
    """Whether the shorter form is looked up by its ``at``-th rarest pair at this cutoff; of very long forms, by each that the index has."""
    return F.coalesce(F.col("at") < F.get(F.array(*[F.lit(_sure(n, cutoff)) for n in range(LONG)]), F.col("n")), F.lit(True))


def _kind(mark: str) -> str:
    return "int" if mark.endswith("spare") else "bigint"


def _grouped(names: DataFrame) -> DataFrame:
    """Names with their codes, dealt over all cores: few bytes, of which one task would be made, are much work here."""
    return names.where("key <> ''").groupBy("key").agg(F.collect_set("iso").alias("codes")).repartition(_tasks(names), F.xxhash64("key"))


def _tasks(df: DataFrame) -> int:
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def _postings(names: DataFrame, query: bool, frequent: dict[str, int], cutoff: float) -> DataFrame:
    """(iso, role, gram, key, own, at, n, and marks): under each code, what names are looked up by (``query``) or found under.

    ``own`` says whether the form is the name itself, ``at`` which of its rarest pairs it is. Word postings of names with repeated words have ``n`` 0.
    """

    @F.pandas_udf(f"array<struct<own:boolean,apart:boolean,n:int,{','.join(f'{c}:{_kind(c)}' for c in _MARKS)},pairs:array<string>,rare:array<string>>>")
    def forms(key: pd.Series) -> pd.Series:
        def one(key: str, s: str) -> dict:
            pairs, words = pairs_of(s), s.split()
            rare = sorted(pairs, key=lambda p: (frequent.get(p, 0), p))[: _sure(len(s), cutoff)]
            return {"own": s == key, "apart": s == " ".join(dict.fromkeys(words)), "n": len(s), **marks_of(pairs), **letter_marks(s), "pairs": pairs, "rare": rare}

        return key.map(lambda k: [one(k, s) for s in (forms_of(k) if cutoff <= 100 * TOKENS else [k])])

    own, other = (_QUERY_SHORT, _VALUE_SHORT) if query else (_VALUE_SHORT, _QUERY_SHORT)
    lone, letters = (_QUERY_LONE, _VALUE_LONE) if query else (_VALUE_LONE, _QUERY_LONE)
    no_gram = F.array().cast("array<struct<role:int,gram:string,at:int>>")
    gram = lambda role, p, at=None: F.struct(F.lit(role).alias("role"), p.alias("gram"), (F.lit(0) if at is None else at).alias("at"))
    rows = names.select("key", "codes", F.explode(forms("key")).alias("f"))
    words = F.transform(F.filter(F.array_distinct(F.split("key", " ")), lambda w: w != ""), lambda w: gram(_WORD, w))
    by_pair = F.concat(F.transform("f.rare", lambda p, i: gram(own, p, i)), F.transform("f.pairs", lambda p: gram(other, p)), F.when(F.col("f.own"), words).otherwise(no_gram))
    n = F.when((F.col("g.role") == _WORD) & ~F.col("f.apart"), 0).otherwise(F.col("f.n"))
    out = rows.withColumn("g", F.explode(by_pair)).select("codes", "key", "f.own", n.alias("n"), *[f"f.{c}" for c in _MARKS], "g")
    # A single character, maybe a repeated one, stands in a longer name without sharing a pair.
    single = F.array_distinct(F.split(F.replace("key", F.lit(" "), F.lit("")), ""))
    chars = F.concat(F.transform(single, lambda c: gram(letters, c)), F.when(F.size(single) == 1, F.array(gram(lone, F.get(single, F.lit(0))))).otherwise(no_gram))
    rest = names.select("codes", "key", F.lit(True).alias("own"), F.length("key").alias("n"), *[F.lit(0).cast(_kind(c)).alias(c) for c in _MARKS], F.explode(chars).alias("g"))
    if cutoff <= 100 * PARTIAL:  # only as parts of others
        out = out.unionByName(rest)
    return out.select(F.explode("codes").alias("iso"), "g.role", "g.gram", "key", "own", "g.at", "n", *_MARKS)


@dataclass(frozen=True)
class Index:
    """The postings of values, good for all cutoffs from ``cutoff`` on, how many they are, and how frequent their most frequent pairs are."""

    postings: DataFrame
    frequent: dict[str, int]
    cutoff: float
    rows: int


def build_index(values: DataFrame, cutoff: float = LEAST_CUTOFF) -> Index:
    """The index of ``values`` (key, iso), as a table in the shared folder."""
    if cutoff < LEAST_CUTOFF:
        raise ValueError(f"cutoff below {LEAST_CUTOFF}")

    @F.pandas_udf("array<string>")
    def pairs(key: pd.Series) -> pd.Series:
        return key.map(pairs_of)

    names = _grouped(values)
    counted = names.select(F.explode(pairs("key")).alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    frequent = {r["pair"]: r["n"] for r in counted.orderBy(F.desc("n"), "pair").limit(FREQUENT).collect()}
    postings = staged(_postings(names, False, frequent, cutoff), "postings", packed=True)
    return Index(postings, frequent, cutoff, postings.count())


def candidates(queries: DataFrame, index: Index, cutoff: float) -> DataFrame:
    """Distinct (key, vkey) that may reach the cutoff, among names that share a code."""
    if cutoff < index.cutoff:
        raise ValueError(f"cutoff below that of the index, {index.cutoff}")
    asked = _postings(_grouped(queries), True, index.frequent, cutoff).drop("own", "at")
    values = index.postings.where((F.col("role") != _VALUE_SHORT) | _is_sure(cutoff))
    whole, parts_count = cutoff > 100 * TOKENS, cutoff <= 100 * PARTIAL
    if whole:  # the names as they are
        asked, values = asked.where(F.col("role") < _WORD), values.where("own").where(F.col("role") < _WORD)
    elif not parts_count:
        values = values.where(F.col("role") <= _WORD)
    values = values.select("iso", "role", "gram", F.col("key").alias("vkey"), F.col("n").alias("vn"), *[F.col(c).alias(f"v{c}") for c in _MARKS])
    asked, values = (asked, F.broadcast(values)) if index.rows <= SENT else (asked.hint("merge"), values.hint("merge"))
    met = asked.join(values, ["iso", "role", "gram"])
    short, long_ = F.when(F.col("role") == _QUERY_SHORT, F.col("n")).otherwise(F.col("vn")), F.when(F.col("role") == _QUERY_SHORT, F.col("vn")).otherwise(F.col("n"))
    lengths = F.greatest(F.length("key"), F.length("vkey")) / F.least(F.length("key"), F.length("vkey"))
    parts = lengths >= LEAST_RATIO
    letters = shared_at_most(_CHARS)
    by_pairs = (short <= long_) & (shared_at_most(_PAIRS) >= least_shared(short, long_, cutoff, parts)) & (letters >= least_letters(short, long_, cutoff, parts))
    # Names that share a word: by that alone if one is much longer; else by the words that are shared or by those that differ as well,
    # and of the characters of either name so many are in common as the shared words would have alone.
    r = cutoff / 100 / TOKENS
    by_word = (lengths < LEAST_RATIO) & (letters >= F.ceil(r / (2 - r) * F.least("n", "vn") - _EPSILON)) if not whole else F.lit(False)
    if cutoff <= 100 * PARTIAL * TOKENS:
        by_word = by_word | ((lengths >= LEAST_RATIO) & (lengths <= MOST_RATIO))
    alone = lengths <= MOST_RATIO  # parts of names that are yet longer count too little
    may = F.when(F.col("role").isin(_QUERY_SHORT, _VALUE_SHORT), by_pairs).when(F.col("role") == _WORD, by_word).otherwise(alone)
    return met.where(may).select("key", "vkey").repartition(_tasks(queries), "key", "vkey").distinct()


def similar_pairs(queries: DataFrame, index: Index, cutoff: float) -> DataFrame:
    """(key, vkey, score) of all pairs under a common code whose score is at least ``cutoff``; each pair is scored once."""

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            score = pd.Series([weighted_from(a, b, cutoff) for a, b in zip(rows["key"], rows["vkey"])], index=rows.index, dtype=float)
            yield rows.assign(score=score)[score >= cutoff]

    return candidates(queries, index, cutoff).mapInPandas(scored, "key string, vkey string, score double")
