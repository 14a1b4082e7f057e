"""The search for a mention's administrative unit as joins, and reconciliation as one chain of tables.

A mention is looked up under several texts, each a row. Rare words meet the knowledge base by an equi-join
of word postings, all texts by the similarity join; the tests that a unit must pass are columns; and one
aggregation over the few texts of a mention decides. Nothing is gathered by article before the last step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions import placecolumns as C
from tidewire.functions import placenames as P
from tidewire.functions.similarity import ratio_column, reaches, weighted_column
from tidewire.operators import grounding, kb
from tidewire.operators.grounding import LEVELS, MATCH
from tidewire.plans.staging import staged
from tidewire.schemas import EVIDENCE, LOCATION, REVISIT

#: Fixed values. Least scores of canonical units; words held by at most RARE units are looked up without codes, by more than MOST_HELD
#: never; SAME scores stand for a shared word; HINT_POINTS favour the hinted level; a long text matches one of its words above
#: CUT_RATIO or CUT_SCORE only; of texts with scores within NEAR of each other the hinted subunit counts; words looked up of each text.
CANONICAL = {1: 93.0, 2: 95.0}
RARE, MOST_HELD, SAME, HINT_POINTS, CUT_RATIO, CUT_SCORE, NEAR, WORDS = 3, 18, 95.0, 5.0, 85.0, 97.0, 0.1, 3
CANONICAL_RATIO = 80.0
#: Names of the ways to a result, as stored: fixed values.
TOKEN, FUZZY, KEPT, FEATURE, COUNTRY, NO_COUNTRY = "token", "fuzzy", "no_match_keep_gemini", "feature_skip", "country_resolve", "country_unresolved"

_ID = ["doc", "position"]


def _words(key: Column) -> Column:
    return F.filter(F.split(key, " "), lambda t: t != "")


def canonical_units(asked: DataFrame, units: grounding.Units) -> DataFrame:
    """Mentions whose units have the knowledge base's spelling where that is very similar, and textually compatible.

    ``canonical1`` and ``canonical2`` say whether a unit was respelled.
    """
    out = asked.withColumn("isos", F.array_sort("isos"))
    due = asked.where(F.size("isos") > 0).select(F.explode(F.array("key1", "key2")).alias("key"), "isos", "strict").where("key IS NOT NULL")
    best = grounding.most_similar(due, units, tuple(CANONICAL), F.col("strict"), min(CANONICAL.values()))
    held = F.contains("vkey", "key") | F.contains("key", "vkey")
    best = best.where(~C.poor_target(F.col("vkey"), F.col("key"))).where(held | (ratio_column("key", "vkey") >= CANONICAL_RATIO))
    by_level = [F.max(F.when((F.col("level") == level) & (F.col("score") >= least), F.struct("value", "vkey"))).alias(f"best{level}") for level, least in CANONICAL.items()]
    table = staged(best.groupBy("key", "isos", "strict").agg(*by_level), "canonical")
    for level in CANONICAL:
        name, key = f"admin{level}", f"key{level}"
        out = out.join(table.select(F.col("key").alias(key), "isos", "strict", F.col(f"best{level}").alias("best")), [key, "isos", "strict"], "left")
        respelled = F.col("best").isNotNull() & (F.col("best.value") != F.col(name))
        out = out.withColumns({f"canonical{level}": respelled, name: F.coalesce("best.value", name), key: F.coalesce("best.vkey", key)}).drop("best")
    return out


def query_variants(asked: DataFrame, keyed: DataFrame) -> DataFrame:
    """(doc, position, at, text, key, kind, held): the texts under which a mention is looked up, in their order.

    First the name, then units that may be other names of it, each as it is (``surface``, ``alias_admin2``,
    ``alias_admin1``) and without qualifiers (``cleaned``); then their rarest words, three of each text
    (``token``), of which ``held`` units of the knowledge base have one. Texts with the same key are one.
    """
    unit = lambda k: F.col(f"key{k}").isNotNull() & (F.col(f"key{k}") != "unknown") & (F.col(f"key{k}") != F.col("key")) & C.one_place(F.col("clean"), F.col(f"clean{k}"))
    rows = asked.select(*_ID, "name", "key", "admin1", "key1", "admin2", "key2", C.clean_phrase(F.col("key")).alias("clean"), *[C.clean_phrase(F.coalesce(F.col(f"key{k}"), F.lit(""))).alias(f"clean{k}") for k in (1, 2)])
    rows = rows.withColumns({"a2": unit(2), "a1": unit(1)})
    rows = rows.withColumn("a1", F.col("a1") & ~(F.col("a2") & (F.col("key1") == F.col("key2"))))

    def forms(at: int, text: str, key: str, kind: str, use: Column) -> list[Column]:
        k = F.col(key)
        own, cleaned = C.exonym(k), C.clean_phrase(k)
        entry = lambda i, t, x, name, when: F.when(when, F.struct(F.lit(i).alias("at"), t.alias("text"), x.alias("key"), F.lit(name).alias("kind")))
        return [entry(at, F.when(own == k, F.trim(text)).otherwise(own), own, kind, use), entry(at + 1, cleaned, cleaned, "cleaned", use & (cleaned != "") & (cleaned != k))]

    all_forms = forms(0, "name", "key", "surface", F.lit(True)) + forms(2, "admin2", "key2", "alias_admin2", F.col("a2")) + forms(4, "admin1", "key1", "alias_admin1", F.col("a1"))
    known = F.filter(F.array(*all_forms), lambda x: x.isNotNull() & ~x["key"].isin("", "unknown"))
    once = lambda x, i: ~F.exists(F.slice("forms", F.lit(1), i), lambda y: y["key"] == x["key"])
    texts = rows.withColumn("forms", known).select(*_ID, F.explode(F.filter("forms", once)).alias("v")).select(*_ID, "v.*")
    long_words = F.filter(F.array_distinct(_words(F.col("key"))), lambda t: (F.length(t) >= 4) & ~C.one_of(t, P.STOPWORDS))
    held = kb.token_frequency(keyed).select(F.col("token").alias("word"), F.col("n").alias("held"))
    words = texts.select(*_ID, "at", F.explode(long_words).alias("word")).join(held, "word", "left")
    rarity = F.struct(F.coalesce("held", F.lit(0)).alias("held"), (-F.length("word")).alias("shortness"), "word")
    rarest = words.groupBy(*_ID, "at").agg(F.slice(F.array_sort(F.collect_set(rarity)), 1, WORDS).alias("r"))
    ranked = rarest.groupBy(*_ID).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("r")))).alias("r"))
    tokens = ranked.select(*_ID, F.posexplode("r").alias("i", "w")).select(*_ID, (F.col("i") + 6).alias("at"), F.col("w.word").alias("text"), F.col("w.word").alias("key"), F.lit("token").alias("kind"), F.col("w.held").alias("held"))
    tokens = tokens.join(texts.select(*_ID, "key"), [*_ID, "key"], "left_anti")
    return texts.withColumn("held", F.lit(None).cast("long")).unionByName(tokens)


def token_units(texts: DataFrame, keyed: DataFrame, rows: DataFrame) -> DataFrame:
    """The best unit by a rare word of each mention's first such text that has one: doc, position, and ``hit``."""
    held = None
    for level in (1, 2):
        values = kb.token_values(keyed, LEVELS[level]).select(F.col("token").alias("key"), "value")
        keys = keyed.select(F.col(LEVELS[level]).alias("value"), F.col(f"{LEVELS[level]}_norm").alias("vkey")).distinct()
        part = values.join(keys, "value").withColumn("level", F.lit(level))
        held = part if held is None else held.unionByName(part)
    allowed = (F.col("kind") == "token") & (F.col("tight") | (F.col("held") <= RARE)) & F.col("held").between(1, MOST_HELD)
    found = texts.where(allowed).join(held, "key")
    shares = C.content_overlap(F.col("name_key"), F.col("vkey")) | reaches(F.col("key"), F.col("vkey"), SAME)
    found = found.withColumns({"clean": C.clean_phrase(F.col("name_key")), "vclean": C.clean_phrase(F.col("vkey"))}).where(C.one_place(F.col("clean"), F.col("vclean")) & shares)
    alike = weighted_column("clean", "vclean")
    found = grounding.rows_for(found, rows).withColumn("alike", alike)
    order = F.struct(((F.col("level") == 2) & F.coalesce(F.col("likely") == 2, F.lit(False))).alias("hinted"), "alike", "level", "value", "row", "row_iso")
    best = found.groupBy(*_ID, "at").agg(F.max(order).alias("b"), F.first("text").alias("text"), F.first("kind").alias("kind"))
    hit = F.struct(F.lit(100.0).alias("score"), F.col("b.level").alias("level"), F.col("b.value").alias("value"), F.col("b.row").alias("row"), "text", "kind", F.lit(TOKEN).alias("by"))
    return best.groupBy(*_ID).agg(F.min(F.struct("at", hit.alias("hit"))).alias("h")).select(*_ID, F.col("h.hit").alias("hit"))


def similar_hits(texts: DataFrame, units: grounding.Units, rows: DataFrame, threshold: float) -> DataFrame:
    """doc, position, at, and ``hit``: the more similar unit of both levels for each text, where it passes all tests."""
    query = ["key", "isos", "strict"]
    texts = texts.withColumn("isos", F.array_sort("isos"))
    best = grounding.most_similar(texts.select(*query).distinct(), units, (1, 2), F.col("strict"), threshold)
    unit = F.struct("level", "value", "vkey", "score")
    best = staged(best.groupBy(*query).agg(*[F.max(F.when(F.col("level") == level, unit)).alias(f"best{level}") for level in (1, 2)]), "best")
    # The hinted level may be some points behind and yet be chosen, to fail then; so it is looked for below the threshold, where the other one has so few above it.
    near = F.coalesce("best1.score", "best2.score") < threshold + HINT_POINTS
    missing = F.when(F.col("best1").isNull(), 1).when(F.col("best2").isNull(), 2)
    behind = staged(texts.join(best.where(near).select(*query, missing.alias("level")), query).where("level = likely").select(*query, "level").distinct(), "behind")
    if not behind.isEmpty():
        more = grounding.most_similar(behind, units, (1, 2), F.col("strict"), threshold - HINT_POINTS).select(*query, unit.alias("more"))
        best = best.join(more, query, "left").withColumns({f"best{level}": F.coalesce(f"best{level}", F.when(F.col("more.level") == level, F.col("more"))) for level in (1, 2)}).drop("more")
    out = texts.join(best, query)
    score = lambda k: F.coalesce(F.col(f"best{k}.score"), F.lit(0.0))
    lower = F.when(F.col("likely") == 2, F.col("best2").isNotNull() & (score(2) >= score(1) - HINT_POINTS)).when(F.col("likely") == 1, ~(F.col("best1").isNotNull() & (score(1) >= score(2) - HINT_POINTS))).otherwise(score(2) > score(1))
    out = out.withColumn("best", F.when(lower, F.col("best2")).otherwise(F.col("best1"))).where("best IS NOT NULL")
    out = out.select(*[c for c in out.columns if c not in ("level", "best", "best1", "best2")], "best.*")
    key, value = F.col("key"), F.col("vkey")
    enough = F.col("score") >= grounding.least_score(F.size("isos") > 0, F.col("strong"), F.col("kind") == "token", F.coalesce("held", F.lit(0)), threshold)
    one_of_many = (F.size(_words(key)) > 1) & F.array_contains(_words(key), value)
    plain = out.where(enough & ~C.poor_target(value, key) & C.words_may_match(key, value)).withColumns({"clean": C.clean_phrase(F.col("name_key")), "vclean": C.clean_phrase(value)})
    tested = plain.where(C.content_overlap(key, value) | reaches(key, value, SAME)).where(C.one_place(F.col("clean"), F.col("vclean"))).where(~(one_of_many & (F.col("score") < CUT_SCORE) & (ratio_column("key", "vkey") < CUT_RATIO)))
    found = grounding.rows_for(tested, rows).where(~F.col("strong") | (F.col("row_key") == F.col("ckey")))
    hit = F.struct("score", "level", "value", "row", "text", "kind", F.lit(FUZZY).alias("by"))
    return found.select(*_ID, "at", "likely", hit.alias("hit"))


def best_hits(hits: DataFrame) -> DataFrame:
    """One hit a mention: texts in their order, the clearly higher score counts; of about equal ones a subunit where that is hinted at."""
    listed = hits.groupBy(*_ID).agg(F.array_sort(F.collect_list(F.struct("at", "likely", "hit"))).alias("h"))

    def better(a: Column, b: Column) -> Column:
        lead = b["hit"]["score"] - a["hit"]["score"]
        hinted = F.coalesce(b["likely"] == 2, F.lit(False)) & (b["hit"]["level"] == 2) & (a["hit"]["level"] != 2)
        return F.when((lead > NEAR) | ((F.abs(lead) <= NEAR) & hinted), b).otherwise(a)

    return listed.select(*_ID, F.aggregate(F.slice("h", F.lit(2), F.size("h")), F.get("h", F.lit(0)), better)["hit"].alias("hit"))


def search_units(asked: DataFrame, units: grounding.Units, threshold: float = MATCH) -> DataFrame:
    """doc, position, ``hit`` (score, level, value, row, text, kind, by) of the mentions that have a unit.

    ``asked`` has mentions with canonical units, see ``canonical_units``. A unit by a word decides, whatever others score.
    """
    keyed = units.keyed
    variants = query_variants(asked, keyed)
    tight = (F.size("isos") > 0) & (F.col("iso_source").isin("gemini_admin0", "cliff_name") | (F.size("isos") <= 2))
    likely = F.when(~F.col("other"), F.when(F.col("level") == "ADMIN1", 1).when(F.col("level") == "ADMIN2", 2))
    facts = asked.select(*_ID, F.col("key").alias("name_key"), "isos", "strict", "strong", F.when(F.col("strong"), F.col("ckey")).alias("ckey"), F.col("key1").alias("ukey"), tight.alias("tight"), likely.alias("likely"))
    texts = staged(variants.join(facts, _ID).where(~C.is_directional(F.col("key"))), "texts")
    rows = staged(grounding.unit_rows(keyed, (1, 2)), "rows")
    by_word = staged(token_units(texts, keyed, rows), "by_word")
    by_score = staged(best_hits(similar_hits(texts, units, rows, threshold)), "by_score")
    return by_score.withColumnRenamed("hit", "s").join(by_word, _ID, "full").select(*_ID, F.coalesce("hit", "s").alias("hit"))


def place_results(tables: grounding.Prepared, threshold: float = MATCH) -> DataFrame:
    """One row a mention with its result: ``level``, units, ``method``, the evidence, and why it needs a second look, if so.

    Names that are generic or directions have no row. ``ready`` mentions are matched with units; those like a
    country have that country: by the only code that names them, else by their text.
    """
    units, keyed = tables.units, tables.units.keyed
    reason = grounding.skipped(F.col("key"))
    rows = tables.asked.withColumn("skip", reason).where("skip IS NULL OR skip = 'feature'")
    countries = rows.where("country_like")
    by_text = F.col("admin0") == "Unknown"
    countries = countries.withColumns({"text": F.when(by_text, F.col("name")).otherwise(F.col("admin0")), "tkey": F.when(by_text, F.col("key")).otherwise(F.col("ckey"))})
    resolved = grounding.resolve_countries(countries.select("text", F.col("tkey").alias("key")), units).select("text", "country")
    names = kb.country_names(keyed).select(F.col("Admin0_ISO3").alias("only"), F.col("Admin0").alias("only_country"))
    only = F.when((F.size("named") == 1) & ~F.col("key").isin(sorted(P.UNTRUSTED)), F.get("named", F.lit(0)))
    countries = countries.withColumn("only", only).join(names, "only", "left").join(resolved, "text", "left").withColumn("found", F.coalesce("only_country", "country"))
    unknown, nothing = F.lit("Unknown"), F.lit(None)
    columns = [*_ID, "name", "key", "country_like", "context", "named"]
    countries = countries.select(
        *columns, F.lit("ADMIN0").alias("level"), F.coalesce("found", "text").alias("admin0"), unknown.alias("admin1"), unknown.alias("admin2"),
        F.when(F.col("found").isNotNull(), COUNTRY).otherwise(NO_COUNTRY).alias("method"), F.col("name").alias("term"), F.lit("surface").alias("kind"), F.coalesce("found", "text").alias("value"), nothing.cast("double").alias("score"), nothing.cast("string").alias("iso_source"), nothing.cast("array<string>").alias("isos"),
    )
    features = rows.where("NOT country_like AND skip = 'feature'").select(
        *columns, F.lit("UNKNOWN").alias("level"), "admin0", unknown.alias("admin1"), unknown.alias("admin2"), F.lit(FEATURE).alias("method"),
        *[nothing.cast("string").alias(c) for c in ("term", "kind", "value")], nothing.cast("double").alias("score"), nothing.cast("string").alias("iso_source"), nothing.cast("array<string>").alias("isos"),
    )
    ready = staged(canonical_units(rows.where("NOT country_like AND skip IS NULL"), units), "ready")
    out = ready.join(search_units(ready, units, threshold), _ID, "left")
    hit, level = F.col("hit").isNotNull(), F.col("hit.level")
    named = lambda c: F.when(F.col(c) != "", F.col(c))
    out = out.select(
        *columns, F.when(hit, F.concat(F.lit("ADMIN"), level)).otherwise(F.col("level")).alias("level"), F.coalesce(named("hit.row.Admin0"), "admin0").alias("admin0"),
        F.when(level == 1, F.col("hit.value")).otherwise(F.coalesce(named("hit.row.Admin1"), "admin1")).alias("admin1"), F.when(level == 1, "Unknown").when(level == 2, F.col("hit.value")).otherwise(F.col("admin2")).alias("admin2"),
        F.when(~hit, KEPT).when(F.col("hit.by") == TOKEN, TOKEN).otherwise(F.concat(F.lit(FUZZY + "_admin"), level)).alias("method"),
        F.col("hit.text").alias("term"), F.col("hit.kind").alias("kind"), F.col("hit.value").alias("value"), F.col("hit.score").alias("score"), F.when(hit, F.col("iso_source")).alias("iso_source"), F.when(hit, F.col("isos")).alias("isos"),
    )
    results = countries.unionByName(features).unionByName(out).withColumn("named", F.coalesce("named", F.array().cast("array<string>")))
    was = tables.mentions.select(*_ID, F.col("level").alias("hint"), F.col("admin0").alias("was0"), F.col("admin1").alias("was1"), F.col("admin2").alias("was2"))
    return grounding.review(results.join(was, _ID), keyed)


def reconcile_articles(articles: DataFrame, kb_rows: DataFrame, threshold: float = MATCH, id_col: str = "_id", add_cliff_only: bool = True) -> DataFrame:
    """``id_col`` and the reconciled fields of every article; filter with ``for_reconciling`` first."""
    tables = grounding.prepare(articles.select(id_col, "gemini_locations", "gemini_locations_normalized", "cliff_locations"), kb_rows, id_col)
    results = staged(place_results(tables, threshold), "results")
    added = staged(grounding.additions(tables.places, tables.mentions.where(~F.coalesce(grounding.skipped(F.col("key")).isin("generic", "direction"), F.lit(False))), tables.units), "added")
    if not add_cliff_only:
        added = added.limit(0)
    ladder = lambda *names: F.struct(*[F.col(c).alias(f"admin{i}" if i >= 0 else "location_level") for i, c in enumerate(names, -1)])
    every = results.select("doc", F.col("position").cast("long").alias("position"), "name", F.col("level").alias("location_level"), "admin0", "admin1", "admin2", "method")
    every = every.unionByName(added.select("doc", (F.col("added_at") + 2**31).cast("long").alias("position"), "name", F.col("level").alias("location_level"), "admin0", "admin1", "admin2", "method"))
    kept = kb.deduplicate_ladders(every, "doc")
    entries = lambda c: F.map_from_entries(F.transform(F.array_sort(F.collect_list(F.struct("position", "name", c))), lambda x: F.struct(x["name"], x[c.split(".")[-1]])))
    place = ladder("location_level", "admin0", "admin1", "admin2")
    places = kept.withColumn("place", place).groupBy("doc").agg(entries("place").alias("reconciled_locations"), entries("method").alias("reconciled_locations_debug"), F.count("*").alias("n_kept"))
    isos = F.coalesce("isos", F.array().cast("array<string>"))
    evidence = F.struct(F.col("term").alias("evidence_term"), "kind", F.when(F.col("term").isNotNull(), F.col("level")).alias("matched_level"), F.col("value").alias("matched_value"), "score", "iso_source", F.when(F.col("term").isNotNull(), isos).alias("iso_set"))
    second = F.struct(F.col("name").alias("location"), "reason", F.col("method").alias("note"), ladder("hint", "was0", "was1", "was2").alias("original"), ladder("level", "admin0", "admin1", "admin2").alias("reconciled"))
    looked = results.withColumns({"evidence": evidence, "second": F.when(F.col("reason").isNotNull(), F.struct("position", second.alias("s")))}).groupBy("doc").agg(
        entries("evidence").alias("reconciled_locations_evidence"), F.array_sort(F.collect_set("term")).alias("reconciled_locations_match_terms"),
        F.transform(F.array_sort(F.collect_list("second")), lambda x: x["s"]).alias("reconciled_locations_revisit"),
    )
    codes = tables.places.groupBy("doc").agg(F.array_sort(F.collect_set("valid_iso")).alias("cliff_isos"))
    status = grounding.article_status(articles, results, added, id_col)
    out = status.join(places, "doc", "left").join(looked, "doc", "left").join(codes, "doc", "left").join(tables.contexts, "doc", "left")
    none, zero = F.array().cast("array<string>"), F.lit(0)
    total = (F.col("n_results") + F.col("n_added")).cast("int")
    meta = F.struct(
        "status", F.col("n_gemini").cast("int").alias("n_gemini"), total.alias("n_reconciled_before_dedup"), F.coalesce("n_kept", zero).cast("int").alias("n_reconciled"), (total - F.coalesce("n_kept", zero)).cast("int").alias("n_dedup_dropped"),
        F.col("n_revisit").cast("int").alias("n_revisit"), F.col("n_added").cast("int").alias("n_added_cliff_only"), F.coalesce("cliff_isos", none).alias("cliff_isos"), F.coalesce("context", none).alias("doc_context_isos"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp_utc"),
    )
    blank = lambda c, kind: F.coalesce(c, F.from_json(F.lit("{}"), f"map<string,{kind}>")).alias(c)
    return out.select(
        F.col("doc").alias(id_col), blank("reconciled_locations", LOCATION), meta.alias("reconciled_locations_meta"), blank("reconciled_locations_debug", "string"), F.coalesce("reconciled_locations_revisit", F.array().cast(REVISIT)).alias("reconciled_locations_revisit"),
        blank("reconciled_locations_evidence", EVIDENCE), F.coalesce("reconciled_locations_match_terms", none).alias("reconciled_locations_match_terms"),
    )


def summary(reconciled: DataFrame, months: DataFrame, id_col: str = "_id") -> DataFrame:
    """Processed documents and documents to revisit, by month."""
    return reconciled.join(months, id_col).groupBy("year", "month").agg(F.count("*").alias("processed"), F.count_if(F.col("reconciled_locations_meta.status") == "REVISIT").alias("revisit_docs"))
