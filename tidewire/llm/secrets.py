"""Secret scans: spans by pattern, then corpus-wide ownership frequency of every candidate.

Every candidate value is counted over the whole corpus by distinct repositories and owners.
Values held by many owners are examples; values of few owners look live, unless these hold them in
very many repositories: then they are copies of an owner's own boilerplate. Pattern spans are always
reported; opaque tokens without a telling key name are added as ``owned`` spans only when few owners
hold them. Built-in functions only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import scratch


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_KEYS = "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
#: Patterns of the contract. Runs of a class are maximal, so for access and hex the least length may
#: stand in the pattern; for assign it may not, as a short match still uses up its characters.
ASSIGN = rf"""({_KEYS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
#: Opaque tokens: long runs that mix letters and digits.
OPAQUE = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9+/_-]*[A-Za-z])[A-Za-z0-9_-]{20,}(?![A-Za-z0-9+/_-])"
KINDS = ("assign", "access", "hex", "owned")
ASSIGN_CHARS, FEW_OWNERS, MANY_REPOS = 8, 2, 50
#: Matches that one fold walks; longer lists are walked in pieces, so that the work grows with their number.
PIECE = 512


def _spans(text: Column, kind: str, pattern: str, value_group: int = 0) -> Column:
    """Matches of a pattern, left to right: kind, code point offsets and the secret value.

    Splitting by the pattern gives the pieces between the matches; their lengths give the places.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group))
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    matches = F.filter(F.arrays_zip(gaps.alias("gap"), whole.alias("whole"), value.alias("value")), lambda x: x["whole"].isNotNull())
    empty = F.array().cast("array<struct<start:int,kind:string,end:int,value:string>>")

    def walk(piece: Column) -> Column:
        """Places within a piece of the list, and its length in the text."""
        return F.aggregate(
            piece,
            F.struct(F.lit(0).alias("at"), empty.alias("out")),
            lambda a, x: F.struct(
                (a["at"] + x["gap"] + F.length(x["whole"])).alias("at"),
                F.array_append(a["out"], F.struct((a["at"] + x["gap"]).alias("start"), F.lit(kind).alias("kind"), (a["at"] + x["gap"] + F.length(x["whole"])).alias("end"), x["value"].alias("value"))).alias("out"),
            ),
        )

    def place(pieces: Column) -> Column:
        ends = F.aggregate(pieces, F.array(F.lit(0)), lambda a, p: F.array_append(a, F.element_at(a, -1) + p["at"]))
        moved = lambda p, at: F.transform(p["out"], lambda x: F.struct((x["start"] + at).alias("start"), x["kind"].alias("kind"), (x["end"] + at).alias("end"), x["value"].alias("value")))
        return _let(ends, lambda e: F.flatten(F.transform(pieces, lambda p, i: moved(p, F.get(e, i)))))

    return _let(F.transform(_pieces(matches), walk), place)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _pieces(items: Column) -> Column:
    """A list cut into lists of PIECE items."""
    cut = lambda x: F.transform(F.sequence(F.lit(0), F.floor((F.size(x) - 1) / PIECE).cast("int")), lambda k: F.slice(x, k * PIECE + 1, PIECE))
    return _let(items, lambda x: F.when(F.size(x) > 0, cut(x)).otherwise(F.slice(F.array(x), 1, 0)))


def _found(text: Column, probe: str, kind: str, pattern: str, group: int = 0) -> Column:
    """Most texts hold no match; a plain search spares them the rest."""
    none = F.array().cast("array<struct<start:int,kind:string,end:int,value:string>>")
    return F.when(text.rlike(probe), _spans(text, kind, pattern, group)).otherwise(none)


def _outside(tokens: Column, spans: Column) -> Column:
    """The tokens, which are sorted and apart, that no span touches; a piece of them is compared with the spans of its own part of the text only."""
    meets = lambda y, a, b: (y["start"] < b) & (y["end"] > a)
    near = lambda piece: F.filter(spans, lambda y: meets(y, F.get(piece, F.lit(0))["start"], F.element_at(piece, -1)["end"]))
    apart = lambda piece, some: F.filter(piece, lambda x: ~F.exists(some, lambda y: meets(y, x["start"], x["end"])))
    return F.flatten(F.transform(_pieces(tokens), lambda piece: _let(near(piece), lambda some: apart(piece, some))))


def candidates(df: DataFrame, text_col: str = "text", repo_col: str = "doc_id", owner_col: str = "source", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Pattern spans (``base``) and opaque tokens outside them (``more``) of every text; null counts as empty."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = df.select(F.struct(*[F.col(c) for c in keep]).alias("k"), F.col(repo_col).cast("string").alias("repo"), F.col(owner_col).cast("string").alias("owner"), text.alias("t"))
    found = rows.select(
        "k", "repo", "owner",
        F.filter(_found(F.col("t"), f"{_KEYS}", "assign", ASSIGN, 2), lambda x: F.length(x["value"]) >= ASSIGN_CHARS).alias("a"),
        _found(F.col("t"), ACCESS, "access", ACCESS).alias("b"),
        _found(F.col("t"), HEX, "hex", HEX).alias("c"),
        _found(F.col("t"), r"[A-Za-z0-9_-]{20}", "owned", OPAQUE).alias("d"),
    )
    base = found.select("k", "repo", "owner", F.concat("a", "b", "c").alias("base"), "d")
    outside = base.select(
        "k", "repo", "owner", "base",
        F.when((F.size("d") == 0) | (F.size("base") == 0), F.col("d")).otherwise(_outside(F.col("d"), F.col("base"))).alias("more"),
    )
    # As in text_statistics: later filters must not be pushed into the arrays.
    return outside.select(F.inline(F.array(F.struct("k", "repo", "owner", "base", "more"))))


def ownership(cands: DataFrame) -> DataFrame:
    """Distinct repositories and owners of every candidate value, counted over the whole corpus.

    Partial aggregation makes one row a task and value of a hot value before the shuffle.
    """
    values = cands.select("repo", "owner", F.explode(F.array_distinct(F.transform(F.concat("base", "more"), lambda x: F.sha2(x["value"], 256)))).alias("hash"))
    held = scratch(values.distinct(), "held")
    owners = held.groupBy("hash", "owner").agg(F.count("*").alias("n")).groupBy("hash").agg(F.count("*").alias("n_owners"))
    repos = held.groupBy("hash", "repo").agg(F.count("*").alias("n")).groupBy("hash").agg(F.count("*").alias("n_repos"))
    return owners.join(repos, "hash")


def secret_values(df: DataFrame, text_col: str = "text", repo_col: str = "doc_id", owner_col: str = "source", few_owners: int = FEW_OWNERS, many_repos: int = MANY_REPOS) -> DataFrame:
    """One row per distinct candidate value: its SHA-256 ``hash``, ``n_owners``, ``n_repos`` and ``verdict``.

    ``example``: more than ``few_owners`` owners hold it; ``copied``: few owners do, in more than
    ``many_repos`` repositories; ``live``: few owners do, in few repositories. A null repository or
    owner is one of its own; null and empty texts hold nothing; an empty table gives an empty result.
    """
    counts = ownership(candidates(df, text_col, repo_col, owner_col, keep=()))
    return counts.withColumn("verdict", F.when(F.col("n_owners") > few_owners, "example").when(F.col("n_repos") > many_repos, "copied").otherwise("live"))


def scan_secrets(df: DataFrame, text_col: str = "text", repo_col: str = "doc_id", owner_col: str = "source", keep: tuple[str, ...] = ("doc_id",), few_owners: int = FEW_OWNERS, many_repos: int = MANY_REPOS) -> DataFrame:
    """One row per input row: ``base`` and ``spans`` as arrays of (start, kind, end), and counts.

    ``n_live`` counts spans whose value at most ``few_owners`` owners hold, ``n_example`` the rest.
    Each of ``spans`` says by ``copied`` whether more than ``many_repos`` repositories hold its value.
    Null texts are empty and texts of any length are read whole; a null repository or owner is one of
    its own; repeated rows are reported each; other columns are left out unless ``keep`` asks for them;
    an empty table gives an empty result.
    """
    found = scratch(candidates(df, text_col, repo_col, owner_col, keep).select("k", "repo", "owner", "base", "more", F.monotonically_increasing_id().alias("rid")), "secrets")
    some = found.where((F.size("base") > 0) | (F.size("more") > 0))
    counts = scratch(ownership(some), "owners")
    spans = some.select("rid", F.explode(F.concat("base", "more")).alias("s")).select("rid", "s", F.sha2("s.value", 256).alias("hash"))
    # Both sides are plain scans: adaptive execution splits a value that fills many rows.
    judged = spans.join(counts, "hash").groupBy("rid").agg(
        F.collect_list(F.when((F.col("n_owners") <= few_owners) | (F.col("s.kind") != "owned"), F.struct("s.start", F.array_position(F.array(*map(F.lit, KINDS)), F.col("s.kind")).alias("ord"), "s.kind", "s.end", (F.col("n_repos") > many_repos).alias("copied")))).alias("spans"),
        F.count_if(F.col("n_owners") <= few_owners).alias("n_live"),
        F.count_if(F.col("n_owners") > few_owners).alias("n_example"),
    )
    plain = "array<struct<start:int,kind:string,end:int,copied:boolean>>"
    tidy = lambda c, *more: F.transform(c, lambda x: F.struct(*[x[f].alias(f) for f in ("start", "kind", "end", *more)]))
    out = found.select("rid", "k", F.transform("base", lambda x: F.struct(x["start"].alias("start"), F.array_position(F.array(*map(F.lit, KINDS)), x["kind"]).alias("ord"), x["kind"].alias("kind"), x["end"].alias("end"))).alias("base")).join(judged, "rid", "left")
    return out.select(
        *[F.col("k")[c].alias(c) for c in keep],
        tidy(F.array_sort("base")).alias("base"),
        F.coalesce(tidy(F.array_sort("spans"), "copied"), F.array().cast(plain)).alias("spans"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"),
        F.coalesce("n_example", F.lit(0)).alias("n_example"),
    )


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span, and every union of overlapping spans, replaced by ``mark``.

    ``spans`` must be sorted by start.
    """
    def masked(pieces: Column, ends: Column) -> Column:
        """The text up to the last end, piece by piece of the spans: each cuts its own part of the text."""

        def part(piece: Column, at: Column, to: Column) -> Column:
            own = lambda own_ends: _let(F.substr(text, at + 1, to - at), lambda t: F.array_join(F.transform(piece, lambda x, i: one(x, F.greatest(at, F.coalesce(F.array_max(F.slice(own_ends, 1, i)), F.lit(0))), t)), ""))
            one = lambda x, upto, t: F.when(x["start"] >= upto, F.concat(F.substr(t, upto - at + 1, x["start"] - upto), F.lit(mark))).otherwise("")
            return _let(F.transform(piece, lambda x: x["end"]), own)

        done = F.array_join(F.transform(pieces, lambda p, i: part(p, F.get(ends, i), F.get(ends, i + 1))), "")
        return F.concat(done, F.substr(text, F.element_at(ends, -1) + 1, F.length(text)))

    last = lambda pieces: F.aggregate(pieces, F.array(F.lit(0)), lambda a, p: F.array_append(a, F.greatest(F.element_at(a, -1), F.array_max(F.transform(p, lambda x: x["end"])))))
    body = _let(_pieces(spans), lambda pieces: _let(last(pieces), lambda ends: masked(pieces, ends)))
    return F.when(F.size(spans) > 0, body).otherwise(text)
