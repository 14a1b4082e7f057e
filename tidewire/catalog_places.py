"""Queries of reconciliation as joins, with their SQL: regions, nations and suppliers are the ladder of units."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewire.catalog import _ladder_kb, _query, _t
from tidewire.functions import placecolumns, text
from tidewire.operators import geo, grounding, kb, unit_search
from tidewire.plans.staging import staged
from tidewire.sources import tables

_LOCATION = "struct<location_level:string,admin0:string,admin1:string,admin2:string>"


def _keyed(spark, d):
    return staged(kb.with_keys(_ladder_kb(spark, d)), "kb")


def _units(spark, d):
    return grounding.index_units(_keyed(spark, d))


def _people(spark, d):
    return _t(spark, d, "customer").join(_t(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(_t(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))


def _articles(spark, d):
    """An article a customer: a state, with its country or not, or a hill, and Europe for two of three; codes by the geoparser."""
    k, iso = F.col("c_custkey"), F.substring("r_name", 1, 3)
    place = lambda level, a0: F.struct(F.lit(level).alias("location_level"), a0.alias("admin0"), F.lit(" Not sure").alias("admin1"), F.lit(None).cast("string").alias("admin2"))
    unknown = F.lit("Unknown")
    one = F.when(k % 4 == 0, F.create_map(F.initcap("n_name"), place("State", F.initcap("r_name")))).when(k % 4 == 1, F.create_map(F.initcap("n_name"), place("province", unknown))).otherwise(F.create_map(F.lit("Hill"), place("Other", unknown)))
    europe = F.when(k % 3 != 0, F.create_map(F.lit("Europe"), place("Country", unknown))).otherwise(F.create_map().cast(f"map<string,{_LOCATION}>"))
    codes = F.create_map(F.lit("unk"), F.array(F.lit("Nowhere")), F.lit("X1"), F.array(F.lit("Nowhere")))
    own = F.create_map(F.lower(iso), F.when(k % 4 == 1, F.array("n_name", F.lit("Town"))).otherwise(F.array(F.lit("Town"))))
    # Asia and Africa are the codes that aren't the article's own in every fifth article of the third kind.
    more = F.create_map(F.lit("asi "), F.array(F.lit("Town")), F.lit("Afr "), F.array(F.lit("Town")))
    cliff = F.when(k % 4 == 3, codes).when((k % 4 == 2) & (k % 5 == 0), F.map_concat(codes, own, more)).otherwise(F.map_concat(codes, own))
    none = F.map_filter(F.map_concat(one, europe), lambda a, b: F.lit(False))
    return _people(spark, d).select(F.col("c_custkey").alias("_id"), F.map_concat(one, europe).alias("gemini_locations"), none.alias("gemini_locations_normalized"), cliff.alias("cliff_locations"))


_CASES = """a AS (SELECT c_custkey AS k, n_name AS n, r_name AS r, substr(r_name, 1, 3) AS iso FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
x AS (SELECT *, list_sort(list_distinct(list_filter([CASE WHEN k % 4 <> 3 THEN iso END, CASE WHEN k % 3 <> 0 THEN 'EUR' END, CASE WHEN k % 4 = 2 AND k % 5 = 0 THEN 'ASI' END, CASE WHEN k % 4 = 2 AND k % 5 = 0 THEN 'AFR' END], lambda v: v IS NOT NULL))) AS ctx FROM a),
m AS (SELECT k, n, r, iso, ctx, CASE WHEN k % 4 < 2 THEN upper(n[1]) || lower(n[2:]) ELSE 'Hill' END AS name, false AS listed FROM x UNION ALL SELECT k, n, r, iso, ctx, 'Europe', true FROM x WHERE k % 3 <> 0)"""


@_query("SELECT substr(r_name, 1, 3) AS iso, count(DISTINCT n_name) AS n_units, count(DISTINCT s_name) AS n_subunits FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def unit_choices(spark, d):
    keyed = _keyed(spark, d)
    count = lambda level, name: grounding.values_by_code(keyed, level).groupBy("iso").agg(F.count("*").alias(name))
    return count(1, "n_units").join(count(2, "n_subunits"), "iso")


@_query(f"WITH {_CASES} SELECT k AS doc, array_to_string(ctx, ',') AS context FROM x WHERE len(ctx) > 0")
def context_codes(spark, d):
    articles, units = _articles(spark, d), _units(spark, d)
    out = grounding.context_codes(grounding.mentions_of(articles, units.keyed), grounding.geoparsed(articles), units)
    return out.select("doc", F.array_join("context", ",").alias("context"))


@_query(f"WITH {_CASES} SELECT k AS doc, name, iso AS named FROM m WHERE k % 4 = 1 AND NOT listed")
def named_codes(spark, d):
    articles, keyed = _articles(spark, d), _keyed(spark, d)
    out = grounding.named_codes(grounding.mentions_of(articles, keyed), grounding.geoparsed(articles), keyed)
    return out.join(grounding.mentions_of(articles, keyed).select("doc", "position", "name"), ["doc", "position"]).select("doc", "name", F.array_join("named", ",").alias("named"))


_TABLE = "known AS (SELECT DISTINCT r_name AS r FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"


@_query(f"""WITH {_CASES}, {_TABLE}, c AS (SELECT m.*, CASE WHEN listed THEN 'EUROPE' WHEN k % 4 = 0 THEN r WHEN len(ctx) = 1 THEN (SELECT q.r FROM known q WHERE substr(q.r, 1, 3) = m.ctx[1]) ELSE 'Unknown' END AS a0 FROM m)
SELECT k AS doc, name, CASE WHEN listed THEN 'ADMIN0' WHEN k % 4 < 2 THEN 'ADMIN1' ELSE 'UNKNOWN' END AS level, a0 AS admin0, 'Unknown' AS admin1 FROM c""")
def place_candidates(spark, d):
    articles, units = _articles(spark, d), _units(spark, d)
    mentions = staged(grounding.mentions_of(articles, units.keyed), "mentions")
    out = grounding.candidates(mentions, staged(grounding.context_codes(mentions, grounding.geoparsed(articles), units), "contexts"), units)
    return out.select("doc", "name", "level", "admin0", "admin1")


@_query(f"""WITH {_CASES}, s AS (SELECT *, CASE WHEN listed OR k % 4 = 0 OR len(ctx) = 1 THEN 'gemini_admin0' WHEN k % 4 = 1 THEN 'cliff_name' WHEN len(ctx) > 0 THEN 'doc_context' ELSE 'none' END AS src FROM m),
t AS (SELECT *, CASE WHEN listed THEN ['EUR'] WHEN k % 4 = 0 OR src = 'cliff_name' THEN [iso] ELSE ctx END AS isos FROM s)
SELECT k AS doc, name, array_to_string(isos, ',') AS isos, src AS iso_source, src = 'gemini_admin0' OR src <> 'none' AND len(isos) <= 2 AS strict FROM t""")
def iso_constraints(spark, d):
    return grounding.prepare(_articles(spark, d), _ladder_kb(spark, d)).asked.select("doc", "name", F.array_join("isos", ",").alias("isos"), "iso_source", "strict")


@_query("""SELECT c_custkey, CASE WHEN c_custkey % 6 IN (2, 4) THEN NULL ELSE r_name END AS country, CASE c_custkey % 6 WHEN 1 THEN 'iso3' WHEN 2 THEN 'no_match' WHEN 4 THEN 'empty' WHEN 5 THEN 'fuzzy' ELSE 'exact' END AS how FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def resolved_countries(spark, d):
    k, r = F.col("c_custkey") % 6, F.col("r_name")
    rows = _people(spark, d).select("c_custkey", F.when(k == 0, F.lower(r)).when(k == 1, F.lower(F.substring(r, 1, 3))).when(k == 2, "Nowhere").when(k == 3, F.concat(F.initcap(r), F.lit("!"))).when(k == 4, " ").otherwise(F.concat(r, F.lit("s"))).alias("text"))
    return rows.join(grounding.resolve_countries(rows, _units(spark, d)).drop("isos", "ckey"), "text").select("c_custkey", "country", "how")


@_query("""SELECT c_custkey, CASE WHEN (c_custkey % 2 = 0 OR c_custkey % 3 <> 2) AND n_nationkey IN (SELECT s_nationkey FROM supplier) THEN n_name END AS value FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def similar_units(spark, d):
    """Under its own code, without codes and under an unknown one; the last finds nothing if strict."""
    k, iso = F.col("c_custkey"), F.substring("r_name", 1, 3)
    isos = F.when(k % 3 == 0, F.array(iso)).when(k % 3 == 1, F.array(iso, F.lit("ZZZ"))).otherwise(F.array(F.lit("ZZZ")))
    rows = _people(spark, d).select("c_custkey", text.normalize_for_match(F.concat("n_name", F.lit("!"))).alias("key"), isos.alias("isos"), (k % 2 == 1).alias("strict"))
    best = grounding.most_similar(rows, _units(spark, d), (1,), F.col("strict")).where("score = 100")
    return rows.withColumn("isos", F.array_sort("isos")).join(best, ["key", "isos", "strict"], "left").select("c_custkey", "value")


@_query("""WITH u AS (SELECT n_name, min(s_name) AS s FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1) SELECT c_custkey, r_name AS country, s AS subunit FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey JOIN u USING (n_name) WHERE c_custkey % 4 <> 3""")
def first_rows(spark, d):
    """The first row of a unit, with codes that fit, that don't, and that don't but needn't."""
    k, iso = F.col("c_custkey"), F.substring("r_name", 1, 3)
    isos = F.when(k % 4 == 0, F.array(iso)).when(k % 4 == 1, F.array().cast("array<string>")).otherwise(F.array(F.lit("ZZZ")))
    wanted = _people(spark, d).select("c_custkey", F.initcap("n_name").alias("value"), isos.alias("isos"), (k % 4 == 3).alias("strict"), F.when(k % 2 == 0, F.lower("r_name")).otherwise("Elsewhere").alias("country"), F.lit("Unknown").alias("unit"))
    return grounding.first_rows(wanted, _keyed(spark, d), 1).select("c_custkey", F.col("Admin0").alias("country"), F.col("Admin2").alias("subunit"))


_RESULTS = """r AS (SELECT s_suppkey AS k, s_name AS s, n_name AS n, r_name AS r FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
v AS (SELECT *, CASE WHEN k % 11 = 0 THEN 'generic' WHEN k % 7 = 0 THEN 'admin0 unknown' WHEN k % 5 = 0 THEN NULL WHEN k % 3 = 0 THEN 'admin1 ungrounded' WHEN k % 3 = 1 THEN CASE WHEN k % 2 = 0 THEN 'admin2 ungrounded' END ELSE 'unit missing' END AS reason FROM r)"""


def _results(spark, d):
    """A result a supplier: generic names, unknown countries, points of interest, units on the ladder and off it."""
    k = F.col("s_suppkey")
    rows = _t(spark, d, "supplier").join(_t(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(_t(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    name = F.when(k % 11 == 0, "The World").when(k % 5 == 0, "Main School").otherwise(F.concat(F.lit("Region "), "s_name"))
    unknown, none = F.lit("Unknown"), F.array().cast("array<string>")
    return rows.select(
        k.alias("doc"), F.lit(0).alias("position"), name.alias("name"), text.normalize_for_match(name).alias("key"), F.lit(False).alias("country_like"), unknown.alias("hint"), unknown.alias("was1"), unknown.alias("was2"),
        F.when(k % 3 == 0, "ADMIN1").when(k % 3 == 1, "ADMIN2").otherwise("UNKNOWN").alias("level"), F.when(k % 7 == 0, "Atlantis").otherwise(F.initcap("r_name")).alias("admin0"),
        F.when(k % 3 == 0, "Nowhere").otherwise(F.lower("n_name")).alias("admin1"), F.when(k % 2 == 0, "Nowhere").otherwise(F.col("s_name")).alias("admin2"), none.alias("named"), none.alias("context"),
    )


@_query(f"WITH {_RESULTS} SELECT k AS doc, CASE WHEN reason <> 'generic' THEN reason END AS reason FROM v")
def review_reasons(spark, d):
    return grounding.review(_results(spark, d), _keyed(spark, d)).select("doc", "reason")


def _found(spark, d):
    """An article a supplier, in which the geoparser lists the supplier, its nation, its region and a name of no unit."""
    rows = _t(spark, d, "supplier").join(_t(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(_t(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    k, empty = F.col("s_suppkey"), F.create_map().cast(f"map<string,{_LOCATION}>")
    have = F.struct(F.lit("city").alias("location_level"), *[F.lit("Unknown").alias(f"admin{i}") for i in range(3)])
    gemini = F.when(k % 4 == 0, F.create_map(F.lower("s_name"), have)).otherwise(empty)
    cliff = F.when(k % 10 != 9, F.create_map(F.substring("r_name", 1, 3), F.array("s_name", "n_name", F.initcap("s_name"), "r_name", F.lit("Qqqq")))).otherwise(F.create_map().cast("map<string,array<string>>"))
    return rows.select(k.alias("_id"), gemini.alias("gemini_locations"), empty.alias("gemini_locations_normalized"), cliff.alias("cliff_locations"))


_FOUND = """f AS (SELECT s_suppkey AS k, s_name AS s, n_name AS n, r_name AS r, count(*) OVER (PARTITION BY n_name) AS units FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
g AS (SELECT k, s AS name, 'ADMIN2' AS level, r AS admin0, n AS admin1, s AS admin2 FROM f WHERE k % 4 <> 0 AND k % 10 <> 9
UNION ALL SELECT k, n, 'ADMIN1', r, n, 'Unknown' FROM f WHERE units = 1 AND k % 10 <> 9
UNION ALL SELECT k, r, 'ADMIN0', r, 'Unknown', 'Unknown' FROM f WHERE r = 'AMERICA' AND k % 10 <> 9)"""


@_query(f"WITH {_FOUND} SELECT k AS doc, name, level, admin0, admin1, admin2 FROM g")
def added_places(spark, d):
    articles, units = _found(spark, d), _units(spark, d)
    return grounding.additions(grounding.geoparsed(articles), grounding.mentions_of(articles, units.keyed), units).select("doc", "name", "level", "admin0", "admin1", "admin2")


@_query(f"""WITH {_FOUND}, {_RESULTS}, c AS (SELECT k, count(*) AS n FROM g GROUP BY 1)
SELECT v.k AS doc, CASE WHEN v.k % 4 = 0 THEN 1 ELSE 0 END AS n_gemini, coalesce(c.n, 0) AS n_added, CASE WHEN v.k % 4 <> 0 AND v.k % 10 = 9 THEN 'NO_LOCATIONS' WHEN reason <> 'generic' THEN 'REVISIT' ELSE 'OK' END AS status FROM v LEFT JOIN c ON c.k = v.k""")
def article_status(spark, d):
    articles, units = _found(spark, d), _units(spark, d)
    added = grounding.additions(grounding.geoparsed(articles), grounding.mentions_of(articles, units.keyed), units)
    return grounding.article_status(articles, grounding.review(_results(spark, d), units.keyed), added).select("doc", "n_gemini", "n_added", "status")


@_query("""SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS processed, count(*) FILTER (o_orderkey % 3 = 0) AS revisit_docs FROM orders GROUP BY ALL""")
def reconciled_by_month(spark, d):
    orders = _t(spark, d, "orders")
    done = orders.select(F.col("o_orderkey").alias("_id"), F.struct(F.when(F.col("o_orderkey") % 3 == 0, "REVISIT").otherwise("OK").alias("status")).alias("reconciled_locations_meta"))
    return unit_search.summary(done, orders.select(F.col("o_orderkey").alias("_id"), F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")))


@_query("""SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'feature' WHEN 1 THEN 'direction' WHEN 2 THEN 'generic' END AS skipped FROM part""")
def skipped_names(spark, d):
    k = F.col("p_partkey") % 5
    name = F.when(k == 0, "Bay of X").when(k == 1, "SOUTH-WEST").when(k == 2, "the Earth ").when(k == 3, "Gulf Province").otherwise(F.concat(F.lit("Zed "), "p_partkey", F.lit(" Ville Est")))
    return _t(spark, d, "part").select("p_partkey", grounding.skipped(text.normalize_for_match(name)).alias("skipped"))


@_query("""SELECT event_id, CASE WHEN event_id % 2 = 0 OR event_id % 3 = 0 THEN 85.0 WHEN event_id % 5 = 0 AND user_id % 40 > 25 THEN 95.0 WHEN event_id % 5 = 0 AND user_id % 40 > 12 THEN 92.0 ELSE 88.0 END::DOUBLE AS least FROM events""")
def score_thresholds(spark, d):
    i = F.col("event_id")
    return _t(spark, d, "events").select("event_id", grounding.least_score(i % 2 == 0, i % 3 == 0, i % 5 == 0, F.col("user_id") % 40).alias("least"))


@_query("""SELECT n_nationkey, CASE WHEN n_nationkey % 4 = 0 THEN false WHEN n_nationkey % 4 = 1 THEN true WHEN n_nationkey % 4 = 2 THEN false ELSE true END AS alike FROM nation""")
def name_pairs(spark, d):
    """The four tests of a similar unit as columns: one word, short and common targets."""
    k = F.col("n_nationkey") % 4
    key = text.normalize_for_match(F.col("n_name"))
    value = F.when(k == 0, F.concat(F.lit("nova "), key)).when(k == 1, F.concat(key, F.lit(" of the st"))).when(k == 2, "new").otherwise(key)
    return _t(spark, d, "nation").select("n_nationkey", (placecolumns.words_may_match(key, value) & ~placecolumns.poor_target(value, key)).alias("alike"))


@_query(r"""WITH v AS (SELECT DISTINCT 1 AS level, n_name AS value FROM supplier JOIN nation ON s_nationkey = n_nationkey UNION ALL SELECT DISTINCT 2, s_name FROM supplier JOIN nation ON s_nationkey = n_nationkey),
t AS (SELECT DISTINCT level, value, unnest(string_split(trim(regexp_replace(regexp_replace(lower(value), '[^a-z0-9_\s]', ' ', 'g'), '\s+', ' ', 'g')), ' ')) AS token FROM v)
SELECT token, CAST(count(*) AS BIGINT) AS n FROM t GROUP BY token""")
def kb_token_levels(spark, d):
    """Units and subunits that hold a token, added up."""
    return kb.token_frequency(_keyed(spark, d)).select("token", "n")


@_query("""SELECT n_nationkey, r_name || '=' || n_name || ';Elsewhere=' AS places FROM nation JOIN region ON n_regionkey = r_regionkey""")
def countries_left_empty(spark, d):
    """A name counts for the country it is first seen with; the other country stays, without names."""
    rows = _t(spark, d, "nation").join(_t(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    entity = lambda c: F.struct(F.col("n_name").alias("name"), c.alias("country_code3"))
    found = geo.places_deduplicated_overall(F.array(entity(F.col("r_name")), entity(F.lit("Elsewhere")), entity(F.col("r_name"))))
    return rows.select("n_nationkey", F.array_join(F.transform(F.map_entries(found), lambda e: F.concat(e["key"], F.lit("="), F.array_join(e["value"], ","))), ";").alias("places"))


@_query("""SELECT s_suppkey, r_name AS admin1_name, CASE WHEN n_nationkey % 3 = 0 THEN '' ELSE n_name END AS admin2_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def gazetteer_units(spark, d):
    """Names of units and subunits by their codes; codes without a name give a blank."""
    rows = _t(spark, d, "supplier").join(_t(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    blank = {c: F.lit("") for c in ("name", "asciiname", "alternatenames", "latitude", "longitude", "feature_class", "feature_code", "admin3_code", "admin4_code", "population")}
    raw = rows.select(F.col("s_suppkey").cast("string").alias("geonameid"), F.lit("KE").alias("country_code"), F.col("n_regionkey").cast("string").alias("admin1_code"), F.col("n_nationkey").cast("string").alias("admin2_code")).withColumns(blank)
    admin1 = _t(spark, d, "region").select(F.concat(F.lit("KE."), F.col("r_regionkey").cast("string")).alias("code"), F.col("r_name").alias("name"))
    admin2 = _t(spark, d, "nation").where("n_nationkey % 3 <> 0").select(F.concat_ws(".", F.lit("KE"), F.col("n_regionkey").cast("string"), F.col("n_nationkey").cast("string")).alias("code"), F.col("n_name").alias("name"))
    out = tables.enrich_geonames(raw, admin1, admin2, {"KE": "KEN"}, expand_ascii=False)
    return out.select(F.col("geonameid").cast("bigint").alias("s_suppkey"), "admin1_name", "admin2_name")
