"""The tests on place names as column expressions; ``key`` is a normalized name (see ``text.normalize_for_match``)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewire.functions import placenames as P
from tidewire.functions.similarity import reaches


def one_of(c: Column, values) -> Column:
    """Whether a text is one of ``values``. They travel as one literal: a tree with a node a word, copied into every test, takes longer to plan than to run."""
    return F.array_contains(F.split(F.lit("\n".join(sorted(values))), "\n"), c)


def _tokens(key: Column) -> Column:
    return F.filter(F.split(key, " "), lambda t: t != "")


def is_generic(key: Column) -> Column:
    return one_of(key, P.GENERIC)


def is_directional(key: Column) -> Column:
    return (key != "") & F.forall(_tokens(key), lambda t: one_of(t, P.DIRECTIONS))


def holds_any(key: Column, words) -> Column:
    """Whether a word occurs anywhere in the name, also within another word."""
    return key.rlike("|".join(re.escape(w) for w in sorted(words)))


def is_poi(key: Column) -> Column:
    return holds_any(key, P.POI)


def is_admin_unit(key: Column) -> Column:
    return holds_any(key, P.ADMIN_WORDS)


def is_feature(key: Column) -> Column:
    plain = F.filter(_tokens(key), lambda t: ~one_of(t, P.FEATURES | P.DIRECTIONS | {"of", "the"}))
    return ~is_admin_unit(key) & F.exists(_tokens(key), lambda t: one_of(t, P.FEATURES)) & (F.size(plain) <= 1)


def clean_phrase(key: Column) -> Column:
    return F.array_join(F.filter(_tokens(key), lambda t: ~one_of(t, P.STOPWORDS | {"of", "the"})), " ")


def content_overlap(a: Column, b: Column) -> Column:
    words = lambda k: F.filter(_tokens(k), lambda t: (F.length(t) >= 4) & ~one_of(t, P.STOPWORDS))
    return F.arrays_overlap(words(a), words(b))


def poor_target(value: Column, key: Column) -> Column:
    """Blank, very short and stopword values, unless the key is the value."""
    telling = (F.length(value) > 3) & ~one_of(value, P.STOPWORDS)
    return ~(telling | (value != "") & (value == key))


def words_may_match(key: Column, value: Column) -> Column:
    """Whether a key of one word may stand for a longer value: that holds it, and beside it only minor words."""
    minor = lambda t: one_of(t, P.QUALIFIERS) | t.rlike(r"^\p{L}{1,3}$") & ~one_of(t, P.STOPWORDS)
    whole = F.array_distinct(_tokens(value))
    added = F.array_except(whole, _tokens(key))
    lone = (F.size(_tokens(key)) == 1) & (F.size(_tokens(value)) > 1)
    return ~lone | (F.size(added) < F.size(whole)) & F.forall(added, minor)


def alias(a: Column, b: Column) -> Column:
    """Plausibly one place: without qualifiers the names are equal, one holds the other, or they are very similar."""
    return one_place(clean_phrase(a), clean_phrase(b))


def one_place(x: Column, y: Column) -> Column:
    """``alias`` of names that are without qualifiers already; each occurs many times here, so give columns where it can be."""
    shorter = F.least(F.length(x), F.length(y))
    holds = (F.contains(x, y) | F.contains(y, x)) & (shorter >= P.LEAST_HELD) & (F.greatest(F.length(x), F.length(y)) - shorter <= P.MOST_GAP)
    return (x != "") & (y != "") & ((x == y) | holds | reaches(x, y, P.ALIAS))


def exonym(key: Column) -> Column:
    table = F.create_map(*[F.lit(x) for kv in P.EXONYMS.items() for x in kv])
    return F.coalesce(F.try_element_at(table, key), key)


def level(raw: Column, key: Column) -> Column:
    """The administrative level of a raw level text; UNKNOWN for others."""
    table = F.create_map(*[F.lit(x) for kv in P.LEVELS.items() for x in kv])
    found = F.coalesce(F.try_element_at(table, key), F.upper(F.trim(raw)))
    return F.when(found.isin("ADMIN0", "ADMIN1", "ADMIN2"), found).otherwise("UNKNOWN")


def known(value: Column, key: Column) -> Column:
    trimmed = F.trim(F.coalesce(value, F.lit("")))
    return F.when((trimmed == "") | one_of(key, P.UNKNOWN), "Unknown").otherwise(trimmed)


def iso_key(code: Column) -> Column:
    """An upper-case three-letter code, or null."""
    c = F.upper(F.trim(code))
    return F.when(c.rlike("^[A-Z]{3}$") & ~one_of(c, P.NO_ISO), c)
