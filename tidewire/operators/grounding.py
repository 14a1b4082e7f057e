"""Reconciliation as joins: mentions, countries, codes, candidates, similar units, review and additions.

Every step takes and gives tables with one row a mention, keyed by article and position. Texts are
resolved and scored once for each distinct (text, codes) pair and joined back. The knowledge base
stays a table: it is joined by key or by code, and Spark broadcasts what its measured size allows.
``prepare`` computes what all later steps read, each once, as tables in the shared folder.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.functions import nested, placecolumns
from tidewire.functions import placenames as P
from tidewire.functions.text import normalize_for_match
from tidewire.operators import kb as units
from tidewire.operators import simjoin
from tidewire.plans.staging import staged

#: Least scores of a match, of one without codes or country, of a country and of an added country,
#: and of one common token by how many units hold it; most places added to an article.
MATCH, LOOSE, COUNTRY, ADDED_COUNTRY = 85.0, 88.0, 88.0, 90.0
COMMON_TOKENS = ((25, 95.0), (12, 92.0))
MOST_ADDED = 25
LEVELS = ("Admin0", "Admin1", "Admin2")
#: Where texts times postings are more, pairs of these scores are looked for first; neither changes a result.
MANY, SETTLING = 10_000_000_000, (96.0, 90.0)

_CODES = "array<string>"


def _none(kind: str = _CODES) -> Column:
    return F.array().cast(kind)


def mentions_of(articles: DataFrame, keyed: DataFrame, id_col: str = "_id") -> DataFrame:
    """One row a place: ``doc``, ``position``, ``name`` and its ``key``, the sanitized level and units with their keys (null where unknown),
    ``country_like``, whether its level or its name is a country's, and ``other``, whether the level says so. Blank and unknown names are left out."""
    places = nested.first_filled(F.col("gemini_locations_normalized"), F.col("gemini_locations"))
    rows = articles.select(F.col(id_col).alias("doc"), F.posexplode(places).alias("position", "name", "info"))
    key = lambda c: normalize_for_match(F.col(c))
    out = rows.select("doc", "position", "name", F.coalesce("info.location_level", F.lit("Unknown")).alias("raw"), *[F.col(f"info.admin{i}").alias(f"raw{i}") for i in range(3)])
    out = out.withColumns({"key": key("name"), "raw_key": key("raw"), **{f"k{i}": key(f"raw{i}") for i in range(3)}})
    units_ = [placecolumns.known(F.col(f"raw{i}"), F.col(f"k{i}")).alias(f"admin{i}") for i in range(3)]
    out = out.select("doc", "position", "name", "key", "raw_key", placecolumns.level(F.col("raw"), F.col("raw_key")).alias("level"), *units_, "k0", "k1", "k2")
    out = out.withColumns({f"key{i}": F.when(F.col(f"admin{i}") != "Unknown", F.col(f"k{i}")) for i in range(3)}).drop("k0", "k1", "k2")
    countries = keyed.where(F.col("Admin0_norm") != "").select(F.col("Admin0_norm").alias("ckey")).distinct()
    marked = out.where((F.col("key") != "") & (F.col("key") != "unknown")).join(countries, F.col("key") == F.col("ckey"), "left")
    return marked.withColumns({"country_like": F.col("raw_key").isin(sorted(P.COUNTRY_LEVELS)) | F.col("ckey").isNotNull(), "other": F.col("raw_key") == "other"}).drop("ckey", "raw_key")


def geoparsed(articles: DataFrame, id_col: str = "_id", column: str = "cliff_locations") -> DataFrame:
    """One row a code and place of the geoparser's map, with its ``key``, in its order; codes without places have one row."""
    entries = articles.select(F.col(id_col).alias("doc"), F.posexplode(F.map_entries(column)).alias("code_at", "e"))
    out = entries.select("doc", "code_at", F.upper(F.trim("e.key")).alias("iso"), placecolumns.iso_key(F.col("e.key")).alias("valid_iso"), F.posexplode_outer("e.value").alias("place_at", "place"))
    return out.withColumn("key", normalize_for_match(F.col("place")))


def values_by_code(keyed: DataFrame, level: int) -> DataFrame:
    """Distinct values of a level and their keys, by code."""
    name = LEVELS[level]
    return keyed.where(F.col(name) != "").select(F.col("Admin0_ISO3").alias("iso"), F.col(name).alias("value"), F.col(f"{name}_norm").alias("vkey")).distinct()


@dataclass(frozen=True)
class Units:
    """A knowledge base with keys, its values, and their index, made once for all lookups of the same levels."""

    keyed: DataFrame
    values: DataFrame
    made: dict[tuple[int, ...], simjoin.Index] = field(default_factory=dict)

    def index(self, levels: tuple[int, ...]) -> simjoin.Index:
        if levels not in self.made:
            held = self.values.where(F.col("level").isin(*levels))
            self.made[levels] = simjoin.build_index(held.select(F.col("vkey").alias("key"), _place(F.col("level"), F.col("iso")).alias("iso")))
        return self.made[levels]


def index_units(keyed: DataFrame) -> Units:
    """The values of all levels under their codes and under ``simjoin.ANY``; the similarity index of a level is made when it is first needed."""
    values = None
    for level in range(3):
        choices = values_by_code(keyed, level)
        # Of values with one key the first one counts.
        part = choices.groupBy("iso", "vkey").agg(F.min("value").alias("value")).unionByName(choices.groupBy("vkey").agg(F.min("value").alias("value")).withColumn("iso", F.lit(simjoin.ANY)))
        part = part.select(F.lit(level).alias("level"), "iso", "vkey", "value")
        values = part if values is None else values.unionByName(part)
    values = staged(values, "values")
    return Units(keyed, values)


def _place(level: Column, iso: Column) -> Column:
    """Level and code as one code of the index."""
    return F.concat(level.cast("string"), F.lit(":"), iso)


def most_similar(queries: DataFrame, units_: Units, levels: tuple[int, ...], strict: Column | bool = False, least: float = MATCH) -> DataFrame:
    """(level, key, isos, strict, value, vkey, score): for each distinct query the most similar value of each level, if its score is at least ``least``.

    ``queries`` has ``key``, a normalized text, and ``isos``, the codes to look under. Without codes
    all values count; so they do where the codes have none, unless ``strict``. A column ``level`` says which of
    the levels a query is for. Ties go to the value that sorts first. Pairs come from the similarity join, and are scored once whatever levels and codes. Of many
    texts and values the join finds first the pairs of high scores; texts that have one are settled, since no other pair is better.
    """
    given = "level" in queries.columns
    asked = queries.select("key", F.array_sort(F.coalesce("isos", _none())).alias("isos"), (F.lit(strict) if isinstance(strict, bool) else strict).alias("strict"), *["level"] * given).where(F.col("key") != "").distinct()
    asked = asked if given else asked.withColumn("level", F.explode(F.array(*map(F.lit, levels))))
    codes = units_.values.select("level", "iso").distinct().withColumn("held", F.lit(True))
    opened = asked.withColumn("iso", F.explode_outer("isos")).join(codes, ["level", "iso"], "left")
    under = opened.groupBy("level", "key", "isos", "strict").agg(F.collect_set(F.when(F.col("held"), F.col("iso"))).alias("known"))
    anywhere = F.array(F.lit(simjoin.ANY))
    under = under.withColumn("under", F.when(F.size("isos") == 0, anywhere).when((F.size("known") > 0) | F.col("strict"), F.col("known")).otherwise(anywhere))
    # Written, as both are read several times and a plan that holds them takes longer to make than to run.
    spread = staged(under.select("level", "key", "isos", "strict", F.explode("under").alias("iso")), "spread")
    index, query, found = units_.index(levels), ["level", "key", "isos", "strict"], None
    many = spread.count() * index.rows > MANY
    for cutoff in [*(c for c in SETTLING if many and c > least), least]:
        pairs = staged(simjoin.similar_pairs(spread.select("key", _place(F.col("level"), F.col("iso")).alias("iso")), index, cutoff), "pairs")
        hits = spread.join(pairs, "key").join(units_.values, ["level", "iso", "vkey"])
        best = hits.groupBy(*query).agg(F.min(F.struct((-F.col("score")).alias("s"), "value", "vkey")).alias("b"))
        if cutoff > least:
            best = staged(best, "best")
            spread = staged(spread.join(best.select(*query), query, "left_anti"), "spread")
        found = best if found is None else found.unionByName(best)
    return found.select(*query, F.col("b.value").alias("value"), F.col("b.vkey").alias("vkey"), (-F.col("b.s")).alias("score"))


def resolve_countries(texts: DataFrame, units_: Units, least: float = COUNTRY, isos: Column | None = None) -> DataFrame:
    """Distinct ``text`` (and ``isos``) with ``country``, its key ``ckey``, ``score`` and ``how``: by code, by equal key, or by similarity.

    Codes and equal keys count under any code; similar names only under those of ``isos`` where given.
    A column ``key`` of normalized texts saves normalizing them.
    """
    key = F.col("key") if "key" in texts.columns else normalize_for_match(F.col("text"))
    raw = texts.select("text", key.alias("key"), F.array_sort(F.coalesce(_none() if isos is None else isos, _none())).alias("isos")).distinct().withColumn("code", F.upper(F.trim("text")))
    keyed = units_.keyed
    names = units.country_names(keyed).select(F.col("Admin0_ISO3").alias("code"), F.col("Admin0").alias("by_code"))
    exact = keyed.where(F.col("Admin0") != "").groupBy(F.col("Admin0_norm").alias("key")).agg(F.min("Admin0").alias("by_key"))
    out = staged(raw.join(names, "code", "left").join(exact, "key", "left"), "texts")
    by_code = F.col("by_code").isNotNull() & F.col("code").rlike("^[A-Z]{3}$")
    left = out.where(~by_code & F.col("by_key").isNull() & (F.col("key") != ""))
    if left.isEmpty():
        out = out.withColumns({"by_score": F.lit(None).cast("string"), "score": F.lit(None).cast("double")})
    else:
        near = most_similar(left, units_, (0,), False, least).select("key", "isos", F.col("value").alias("by_score"), "score")
        out = out.join(near, ["key", "isos"], "left")
    how = F.when(F.trim("text") == "", "empty").when(by_code, "iso3").when(F.col("by_key").isNotNull(), "exact").when(F.col("by_score").isNotNull(), "fuzzy").otherwise("no_match")
    country = F.when(how == "iso3", F.col("by_code")).when(how == "exact", F.col("by_key")).when(how == "fuzzy", F.col("by_score"))
    out = out.select("text", "isos", country.alias("country"), F.when(how.isin("iso3", "exact"), 100.0).when(how == "fuzzy", F.col("score")).otherwise(0.0).alias("score"), how.alias("how"))
    keys = keyed.select(F.col("Admin0").alias("country"), F.col("Admin0_norm").alias("ckey")).distinct()
    return out.join(keys, "country", "left").select("text", "isos", "country", "ckey", "score", "how")


def country_codes(keyed: DataFrame) -> DataFrame:
    """The codes of every country's key."""
    return units.membership(keyed, 0).select(F.col("Admin0_norm").alias("ckey"), F.col("isos").alias("country_isos"))


def context_codes(mentions: DataFrame, places: DataFrame, units_: Units) -> DataFrame:
    """(doc, context): the valid codes of the geoparser and the codes of the countries that mentions resolve to, sorted."""
    stated = F.col("admin0") != "Unknown"
    named = mentions.where(stated | F.col("country_like")).select("doc", F.when(stated, F.col("admin0")).otherwise(F.col("name")).alias("text"), F.when(stated, F.col("key0")).otherwise(F.col("key")).alias("key"))
    found = resolve_countries(named, units_).where("country IS NOT NULL").join(country_codes(units_.keyed), "ckey").select("text", F.explode("country_isos").alias("iso"))
    codes = named.join(found, "text").select("doc", "iso").unionByName(places.where("valid_iso IS NOT NULL").select("doc", F.col("valid_iso").alias("iso")))
    return codes.groupBy("doc").agg(F.array_sort(F.collect_set("iso")).alias("context"))


def named_codes(mentions: DataFrame, places: DataFrame, keyed: DataFrame) -> DataFrame:
    """(doc, position, named): the codes under which the geoparser lists just this name, of those the knowledge base has."""
    codes = units.country_names(keyed).select(F.col("Admin0_ISO3").alias("iso"))
    listed = places.where("place IS NOT NULL").join(codes, "iso", "left_semi").select("doc", "iso", "key")
    hits = mentions.select("doc", "position", "key").join(listed, ["doc", "key"])
    return hits.groupBy("doc", "position").agg(F.array_sort(F.collect_set("iso")).alias("named"))


def candidates(mentions: DataFrame, contexts: DataFrame, units_: Units) -> DataFrame:
    """Mentions with their country resolved, or taken from the only code of the article.

    Similar names count only under the article's codes where these are at most four. Mentions like a
    country are of level ADMIN0, without units, if that country is known, and else of none.
    """
    by_name = (F.col("admin0") == "Unknown") & F.col("country_like")
    rows = mentions.join(contexts, "doc", "left").withColumn("context", F.coalesce("context", _none()))
    rows = rows.withColumns({"text": F.when(by_name, F.col("name")).otherwise(F.col("admin0")), "tkey": F.when(by_name, F.col("key")).otherwise(F.col("key0")), "under": F.when(F.size("context") <= 4, F.col("context")).otherwise(_none())})
    due = rows.where("text <> 'Unknown'").select("text", F.col("tkey").alias("key"), "under")
    keyed = units_.keyed
    found = resolve_countries(due, units_, isos=F.col("under")).select("text", F.col("isos").alias("under"), "country", F.col("ckey").alias("found_key"))
    names = units.country_names(keyed).select(F.col("Admin0_ISO3").alias("only"), F.col("Admin0").alias("only_country"))
    names = names.join(keyed.select(F.col("Admin0").alias("only_country"), F.col("Admin0_norm").alias("only_key")).distinct(), "only_country")
    rows = rows.withColumn("only", F.when(F.size("context") == 1, F.get("context", F.lit(0)))).join(found, ["text", "under"], "left").join(names, "only", "left")
    stated = F.col("admin0") != "Unknown"
    rows = rows.withColumns({
        "a0": F.coalesce("country", F.when(stated, F.col("admin0")), "only_country", F.lit("Unknown")),
        "ckey": F.when(F.col("country").isNotNull(), F.col("found_key")).when(stated, F.col("key0")).otherwise(F.col("only_key")),
    }).join(country_codes(keyed), "ckey", "left")
    grounded = F.col("country_isos").isNotNull()
    level = F.when(~F.col("country_like"), F.col("level")).when(grounded, "ADMIN0").otherwise("UNKNOWN")
    blank = F.col("country_like") & grounded
    unit = [x for i in (1, 2) for x in (F.when(blank, "Unknown").otherwise(F.col(f"admin{i}")).alias(f"admin{i}"), F.when(~blank, F.col(f"key{i}")).alias(f"key{i}"))]
    return rows.select("doc", "position", "name", "key", "country_like", "other", "context", level.alias("level"), F.col("a0").alias("admin0"), "ckey", *unit, F.coalesce("country_isos", _none()).alias("country_isos"))


def constraints(cands: DataFrame, named: DataFrame) -> DataFrame:
    """Candidates with ``isos``, the codes that a match must have, ``iso_source`` and whether they are ``strict``.

    The country's codes come first, then those under which the geoparser lists the name, unless that
    is generic or not trusted, then the article's.
    """
    rows = cands.join(named, ["doc", "position"], "left")
    trusted = F.coalesce(F.size("named") > 0, F.lit(False)) & ~F.col("key").isin(sorted(P.UNTRUSTED)) & ~placecolumns.is_generic(F.col("key"))
    source = F.when(F.size("country_isos") > 0, "gemini_admin0").when(trusted, "cliff_name").when(F.size("context") > 0, "doc_context").otherwise("none")
    isos = F.when(source == "gemini_admin0", F.col("country_isos")).when(source == "cliff_name", F.col("named")).when(source == "doc_context", F.col("context")).otherwise(_none())
    rows = rows.withColumns({"isos": isos, "iso_source": source})
    wrong = (F.col("key") == "crimea") & (F.col("isos") == F.array(F.lit("AUS"))) & (F.col("iso_source") != "gemini_admin0")
    rows = rows.withColumns({"iso_source": F.when(wrong, "cliff_name_dropped_for_crimea").otherwise(F.col("iso_source")), "isos": F.when(wrong, _none()).otherwise(F.col("isos"))})
    strict = F.when(F.col("iso_source") == "gemini_admin0", True).when(F.col("iso_source").isin("cliff_name", "doc_context"), F.size("isos") <= 2).otherwise(False)
    return rows.withColumn("strict", strict)


def anchored(constrained: DataFrame, keyed: DataFrame) -> DataFrame:
    """Candidates without a country take that of their only code; ``strong`` says whether the country is known, ``ckey`` is its key."""
    names = units.country_names(keyed).select(F.col("Admin0_ISO3").alias("only"), F.col("Admin0").alias("only_country"))
    names = names.join(keyed.select(F.col("Admin0").alias("only_country"), F.col("Admin0_norm").alias("only_key")).distinct(), "only_country")
    only = F.when((F.col("admin0") == "Unknown") & F.col("iso_source").isin("cliff_name", "doc_context") & (F.size("isos") == 1), F.get("isos", F.lit(0)))
    out = constrained.withColumn("only", only).join(names, "only", "left")
    return out.withColumns({"admin0": F.coalesce("only_country", "admin0"), "ckey": F.coalesce("only_key", "ckey"), "strong": F.col("only_country").isNotNull() | (F.size("country_isos") > 0)}).drop("only", "only_country", "only_key")


@dataclass(frozen=True)
class Prepared:
    """The knowledge base with keys, mentions, the geoparser's places, the codes of articles, and mentions with country and codes."""

    units: Units
    mentions: DataFrame
    places: DataFrame
    contexts: DataFrame
    named: DataFrame
    asked: DataFrame


def prepare(articles: DataFrame, kb: DataFrame, id_col: str = "_id") -> Prepared:
    """The tables that the search, the review and the additions start from."""
    known = index_units(staged(units.with_keys(kb), "kb"))
    keyed = known.keyed
    mentions = staged(mentions_of(articles, keyed, id_col), "mentions")
    places = staged(geoparsed(articles, id_col), "places")
    contexts = staged(context_codes(mentions, places, known), "contexts")
    named = staged(named_codes(mentions, places, keyed), "named")
    return Prepared(known, mentions, places, contexts, named, staged(anchored(constraints(candidates(mentions, contexts, known), named), keyed), "asked"))


def skipped(key: Column) -> Column:
    """Why a name is never matched with a unit: generic, direction or feature; null if it may be."""
    return F.when(placecolumns.is_generic(key), "generic").when(placecolumns.is_directional(key), "direction").when(placecolumns.is_feature(key), "feature")


def least_score(has_codes: Column, has_country: Column, single: Column, frequency: Column, threshold: float = MATCH) -> Column:
    """The score that a match needs: more without codes and country, and yet more for one token that many units hold."""
    loose = [F.lit(LOOSE)] + [F.when(single & (frequency > n), s).otherwise(0.0) for n, s in COMMON_TOKENS]
    return F.when(has_codes | has_country, threshold).otherwise(F.greatest(F.lit(threshold), *loose))


def unit_rows(keyed: DataFrame, levels: tuple[int, ...] = (0, 1, 2)) -> DataFrame:
    """The first row of the knowledge base for each level, value, code, country and unit: what a request can tell apart."""
    out = None
    for level in levels:
        name = LEVELS[level]
        rows = keyed.where(F.col(name) != "").select(F.lit(level).alias("level"), F.col(f"{name}_norm").alias("vkey"), F.col(name).alias("held"), *LEVELS, "Admin0_ISO3", "Admin0_norm", "Admin1_norm")
        out = rows if out is None else out.unionByName(rows)
    return out.groupBy("level", "vkey", "held", "Admin0_ISO3", "Admin0_norm", "Admin1_norm").agg(F.min(F.struct(*LEVELS)).alias("row"))


def rows_for(requests: DataFrame, rows: DataFrame) -> DataFrame:
    """``requests`` that have a row, with ``row``, ``row_iso`` and ``row_key``, the key of its country.

    A request has ``level``, ``value``, its ``vkey``, ``isos``, ``strict``, and the keys ``ckey`` and ``ukey`` of the wished country
    and unit (null for none). Rows with the very value count before those with its key. Codes narrow the rows, entirely if
    strict; the wished country and unit narrow them where any row fits. Distinct requests are answered by one
    aggregation that combines before its shuffle.
    """
    names = ["level", "value", "vkey", "isos", "strict", "ckey", "ukey"]
    asked = requests.select(*names).distinct()
    misses = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    outside = (F.size("isos") > 0) & ~F.array_contains("isos", F.col("Admin0_ISO3"))
    order = F.struct(misses(F.col("held") != F.col("value")).alias("other"), misses(outside).alias("outside"), misses(F.col("Admin0_norm") != F.col("ckey")).alias("c"), misses(F.col("Admin1_norm") != F.col("ukey")).alias("u"), "row", F.col("Admin0_ISO3").alias("iso"), F.col("Admin0_norm").alias("key"))
    best = asked.join(rows, ["level", "vkey"]).groupBy(*names).agg(F.min(order).alias("b")).where(~(F.col("strict") & (F.col("b.outside") == 1)))
    found = best.select(*names[:5], F.coalesce("ckey", F.lit("")).alias("c_"), F.coalesce("ukey", F.lit("")).alias("u_"), F.col("b.row").alias("row"), F.col("b.iso").alias("row_iso"), F.col("b.key").alias("row_key"))
    wished = requests.withColumns({"c_": F.coalesce("ckey", F.lit("")), "u_": F.coalesce("ukey", F.lit(""))})
    return wished.join(found, [*names[:5], "c_", "u_"]).drop("c_", "u_")


def first_rows(wanted: DataFrame, keyed: DataFrame, level: int) -> DataFrame:
    """The first row of the knowledge base for each request: ``value``, ``isos``, ``strict``, wished ``country`` and ``unit``; see ``rows_for``. Adds the row's columns."""
    wish = lambda c: F.when(F.col(c).isNotNull() & ~F.col(c).isin("", "Unknown"), normalize_for_match(F.col(c)))
    asked = wanted.withColumns({"level": F.lit(level), "vkey": normalize_for_match(F.col("value")), "ckey": wish("country"), "ukey": wish("unit")})
    return rows_for(asked, unit_rows(keyed, (level,))).select(*wanted.columns, *[F.col(f"row.{c}").alias(c) for c in LEVELS], F.col("row_iso").alias("Admin0_ISO3"))


def ladders(keyed: DataFrame) -> DataFrame:
    """All known ladders of countries, units and subunits as one column of key arrays."""
    keys = [F.col(f"{c}_norm") for c in LEVELS]
    of = lambda n: keyed.where(F.forall(F.array(*keys[:n]), lambda k: k != "")).select(F.array(*keys[:n]).alias("ladder"))
    return of(1).unionByName(of(2)).unionByName(of(3)).distinct()


def review(results: DataFrame, keyed: DataFrame) -> DataFrame:
    """Results with ``reason``, why a place needs a second look, or null.

    ``results`` has the mention's ``key``, ``country_like``, the original ``hint`` level and units
    (``was1``, ``was2``), the reconciled ``level`` and units, ``named`` codes and ``context``.
    """
    known = lambda c: ~F.col(c).isin("", "Unknown")
    key = lambda c: normalize_for_match(F.when(known(c), F.col(c)))
    rows = results.withColumns({"x0": key("admin0"), "x1": key("admin1"), "x2": key("admin2"), "w1": key("was1"), "w2": key("was2")})
    table = ladders(keyed)
    for n in (1, 2, 3):
        depth = table.where(F.size("ladder") == n).select(F.col("ladder").alias(f"ladder{n}"), F.lit(True).alias(f"has{n}"))
        rows = rows.withColumn(f"l{n}", F.array(*[F.col(f"x{i}") for i in range(n)])).join(depth, F.col(f"l{n}") == F.col(f"ladder{n}"), "left").drop(f"ladder{n}", f"l{n}")
    has = lambda n: F.coalesce(F.col(f"has{n}"), F.lit(False))
    hinted, listed = F.col("hint").isin("ADMIN1", "ADMIN2"), F.size("named") > 0
    unit_like = placecolumns.is_admin_unit(F.col("key")) | placecolumns.is_admin_unit(F.col("w1")) | placecolumns.is_admin_unit(F.col("w2"))
    exempt = placecolumns.is_generic(F.col("key")) | placecolumns.is_directional(F.col("key")) | ~known("admin0")
    settled = F.col("country_like") | placecolumns.is_feature(F.col("key")) | placecolumns.is_poi(F.col("key"))
    unlikely = ~(unit_like | hinted | listed) | (F.size("context") > 8) & ~listed & ~hinted
    reason = (
        F.when(exempt, None).when(~has(1), "admin0 unknown").when(settled | unlikely, None)
        .when(F.col("level") == "ADMIN2", F.when(~has(3), "admin2 ungrounded"))
        .when(F.col("level") == "ADMIN1", F.when(~has(2), "admin1 ungrounded"))
        .otherwise("unit missing")
    )
    return rows.withColumn("reason", reason).select(*results.columns, "reason")


def additions(places: DataFrame, mentions: DataFrame, units_: Units) -> DataFrame:
    """Places that only the geoparser found: countries, and units that are known under their code by exactly one row.

    The first find of a name counts, and of an article the first MOST_ADDED.
    """
    keyed = units_.keyed
    codes = units.country_names(keyed).select(F.col("Admin0_ISO3").alias("iso"))
    rows = places.where("place IS NOT NULL").withColumn("name", F.trim("place")).join(codes, "iso", "left_semi")
    key = F.col("key")
    fit = (key != "") & (key != "unknown") & ~key.isin(sorted(P.UNTRUSTED | P.STOPWORDS)) & skipped(key).isNull()
    rows = staged(rows.where(fit).join(mentions.select("doc", "key").distinct(), ["doc", "key"], "left_anti").withColumn("isos", F.array("iso")), "found")
    country = resolve_countries(rows.withColumnRenamed("name", "text"), units_, ADDED_COUNTRY, F.col("isos")).select(F.col("text").alias("name"), "isos", "country", F.col("how"))
    rows = rows.join(country, ["name", "isos"], "left")
    for level in (1, 2):
        name = LEVELS[level]
        table = keyed.where(F.col(name) != "").select(*LEVELS, F.col("Admin0_ISO3").alias("iso"), F.col(f"{name}_norm").alias("key")).distinct()
        asked = rows.select("name", "key", "iso").distinct().join(table, ["key", "iso"])
        # Rows with the very name count before those with its key; under any code, as for a match.
        very = keyed.where(F.col(name) != "").select(F.col(name).alias("name"), F.lit(True).alias("very")).distinct()
        asked = asked.join(very, "name", "left").where(F.col("very").isNull() | (F.col(name) == F.col("name")))
        one = asked.groupBy("name", "key", "iso").agg(F.count("*").alias("n"), F.first(F.struct(*LEVELS)).alias(f"u{level}")).where("n = 1").drop("n")
        rows = rows.join(one, ["name", "key", "iso"], "left")
    method = F.when(F.col("country").isNotNull(), "cliff_only_country").when(F.col("u1").isNotNull(), "cliff_only_admin1_exact").when(F.col("u2").isNotNull(), "cliff_only_admin2_exact")
    found = rows.withColumn("method", method).where("method IS NOT NULL")
    first = found.withColumn("k", F.row_number().over(Window.partitionBy("doc", "key").orderBy("code_at", "place_at"))).where("k = 1")
    kept = first.withColumn("added_at", F.row_number().over(Window.partitionBy("doc").orderBy("code_at", "place_at"))).where(F.col("added_at") <= MOST_ADDED)
    unit = lambda i, alone: F.when(F.col("country").isNotNull(), alone).when(F.col("u1").isNotNull(), F.col(f"u1.Admin{i}") if i < 2 else F.lit("Unknown")).otherwise(F.col(f"u2.Admin{i}"))
    level = F.when(F.col("country").isNotNull(), "ADMIN0").when(F.col("u1").isNotNull(), "ADMIN1").otherwise("ADMIN2")
    return kept.select("doc", "added_at", "name", level.alias("level"), unit(0, F.col("country")).alias("admin0"), unit(1, F.lit("Unknown")).alias("admin1"), unit(2, F.lit("Unknown")).alias("admin2"), "method", "iso")


def article_status(articles: DataFrame, results: DataFrame, added: DataFrame, id_col: str = "_id") -> DataFrame:
    """Counters and status of every article: NO_LOCATIONS without any places, REVISIT if a result has a reason, else OK."""
    n_map = lambda c: F.coalesce(F.size(F.col(c)), F.lit(0))
    base = articles.select(F.col(id_col).alias("doc"), F.size(nested.first_filled(F.col("gemini_locations_normalized"), F.col("gemini_locations"))).alias("n_gemini"), F.greatest(n_map("cliff_locations"), F.lit(0)).alias("n_cliff"))
    seen = results.groupBy("doc").agg(F.count("*").alias("n_results"), F.count("reason").alias("n_revisit"))
    more = added.groupBy("doc").agg(F.count("*").alias("n_added"))
    out = base.join(seen, "doc", "left").join(more, "doc", "left").na.fill(0, ["n_results", "n_revisit", "n_added", "n_gemini"])
    status = F.when((F.col("n_gemini") <= 0) & (F.col("n_cliff") <= 0), "NO_LOCATIONS").when(F.col("n_revisit") > 0, "REVISIT").otherwise("OK")
    return out.select("doc", F.greatest("n_gemini", F.lit(0)).alias("n_gemini"), "n_results", "n_revisit", "n_added", status.alias("status"))
