"""Queries of the unit search over the shop's clients, with their SQL: names of clients are subunits, cities units, nations countries.

The SQL compares all pairs and scores them by its own statement of the weighted ratio.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewire.catalog import _query, _t
from tidewire.functions import placecolumns as C
from tidewire.functions import placenames as P
from tidewire.functions import text
from tidewire.functions.similarity import ratio_column, weighted_column
from tidewire.operators import grounding, kb, unit_search
from tidewire.plans.staging import staged
from tidewire.schemas import GEONAMES, LOCATION
from tidewire.sources import tables

_quoted = lambda words: ", ".join(f"'{w}'" for w in sorted(words))
_key = lambda c: rf"trim(regexp_replace(regexp_replace(lower(strip_accents({c})), '[^a-z0-9_\s]', ' ', 'g'), '\s+', ' ', 'g'))"
_clean = lambda c: f"array_to_string(list_filter(string_split({c}, ' '), lambda t: t NOT IN ({_quoted(P.STOPWORDS | {'of', 'the', ''})})), ' ')"
_content = lambda c: f"list_filter(string_split({c}, ' '), lambda t: length(t) >= 4 AND t NOT IN ({_quoted(P.STOPWORDS)}))"


def _scores(name: str, pairs: str) -> str:
    """CTEs that end in ``name`` (a, b, score): the weighted ratio of the distinct, non-empty pairs of the CTE ``pairs``.

    Every comparison that counts is a row of two strings and a weight; the score is the best weighted
    ratio. Common subsequences are counted with one bit a character, so strings have at most 60.
    """
    windows = lambda x, y: f"unnest(list_distinct(list_transform(range(1 - length({x}), length({y})), lambda i: substr({y}, greatest(i, 0) + 1, least(i + length({x}), length({y})) - greatest(i, 0)))))"
    parts = lambda a, b, w: f"""SELECT p, {a}, {windows(a, b)}, {w} FROM {name}_f WHERE wide AND length({a}) <= length({b})
  UNION ALL SELECT p, {b}, {windows(b, a)}, {w} FROM {name}_f WHERE wide AND length({b}) <= length({a})"""  # noqa: E731
    return f"""{name}_p AS (SELECT row_number() OVER () AS p, a, b FROM (SELECT DISTINCT a, b FROM {pairs} WHERE a <> '' AND b <> '')),
{name}_w AS (SELECT *, list_sort(string_split(a, ' ')) AS wa, list_sort(string_split(b, ' ')) AS wb, greatest(length(a), length(b)) / least(length(a), length(b)) AS r FROM {name}_p),
{name}_s AS (SELECT *, list_sort(list_distinct(list_filter(wa, lambda t: list_contains(wb, t)))) AS both_, list_sort(list_distinct(list_filter(wa, lambda t: NOT list_contains(wb, t)))) AS oa, list_sort(list_distinct(list_filter(wb, lambda t: NOT list_contains(wa, t)))) AS ob FROM {name}_w),
{name}_f AS (SELECT *, r >= 1.5 AS wide, CASE WHEN r <= 8 THEN 0.9 ELSE 0.6 END::DOUBLE AS scale, array_to_string(wa, ' ') AS sa, array_to_string(wb, ' ') AS sb, array_to_string(list_sort(list_distinct(wa)), ' ') AS ua, array_to_string(list_sort(list_distinct(wb)), ' ') AS ub,
  array_to_string(both_, ' ') AS base, array_to_string(list_concat(both_, oa), ' ') AS la, array_to_string(list_concat(both_, ob), ' ') AS lb FROM {name}_s),
{name}_c(p, x, y, w) AS (
  SELECT p, a, b, 1::DOUBLE FROM {name}_f
  UNION ALL SELECT p, sa, sb, 0.95 FROM {name}_f WHERE NOT wide
  UNION ALL SELECT p, la, lb, 0.95 FROM {name}_f WHERE NOT wide
  UNION ALL SELECT p, base, unnest([la, lb]), 0.95 FROM {name}_f WHERE NOT wide AND base <> ''
  UNION ALL SELECT p, 'same', 'same', 0.95 FROM {name}_f WHERE NOT wide AND base <> '' AND (len(oa) = 0 OR len(ob) = 0)
  UNION ALL SELECT p, 'same', 'same', 0.95 * scale FROM {name}_f WHERE wide AND base <> ''
  UNION ALL {parts('a', 'b', 'scale')}
  UNION ALL SELECT * FROM ({parts('sa', 'sb', '0.95 * scale')}) WHERE p IN (SELECT p FROM {name}_f WHERE base = '')
  UNION ALL SELECT * FROM ({parts('ua', 'ub', '0.95 * scale')}) WHERE p IN (SELECT p FROM {name}_f WHERE base = '')),
{name}_l AS (SELECT x, y, length(x) - bit_count(list_reduce(list_prepend((1::BIGINT << length(x)) - 1, list_transform(string_split(y, ''), lambda c: CAST(list_sum(list_transform(range(0, length(x)), lambda i: CASE WHEN x[CAST(i AS INTEGER) + 1] = c THEN 1::BIGINT << i ELSE 0 END)) AS BIGINT))), lambda s, m: ((s + (s & m)) | (s & ~m)) & ((1::BIGINT << length(x)) - 1))) AS common FROM (SELECT DISTINCT x, y FROM {name}_c WHERE x <> '' AND y <> '')),
{name}_r AS (SELECT x, y, 200.0::DOUBLE * common / (length(x) + length(y)) AS ratio FROM {name}_l),
{name} AS (SELECT a, b, max(w * ratio) AS score FROM {name}_p JOIN {name}_c USING (p) JOIN {name}_r USING (x, y) GROUP BY a, b)"""


#: Whether two keys may be names of one place; ``score`` is that of the cleaned keys.
_alias = lambda x, y, score: f"({x} <> '' AND {y} <> '' AND ({x} = {y} OR ((contains({x}, {y}) OR contains({y}, {x})) AND least(length({x}), length({y})) >= {P.LEAST_HELD} AND abs(length({x}) - length({y})) <= {P.MOST_GAP}) OR coalesce({score}, 0) >= {P.ALIAS}))"


@_query(f"""WITH n AS (SELECT c.client_id, {_key('c.name')} AS a, {_key("m.name || ' ' || coalesce(m.city, '')")} AS b, {_key('m.name')} AS m FROM clients c JOIN clients m ON c.master_id = m.client_id WHERE c.client_id <> c.master_id AND c.name IS NOT NULL AND m.name IS NOT NULL),
u AS (SELECT a, b FROM n UNION ALL SELECT a, m FROM n), {_scores('s', 'u')}
SELECT client_id, round(x.score, 6) AS with_city, round(y.score, 6) AS name_only, round(200.0::DOUBLE * z.common / (length(n.a) + length(n.m)), 6) AS plain FROM n JOIN s x ON x.a = n.a AND x.b = n.b JOIN s y ON y.a = n.a AND y.b = n.m JOIN s_l z ON z.x = n.a AND z.y = n.m""")
def name_similarity(spark, d):
    """The weighted and the plain ratio of clients' names with those of the clients that they are copies of."""
    clients = _t(spark, d, "clients").select("client_id", "master_id", "name", "city")
    masters = clients.select(F.col("client_id").alias("master_id"), F.col("name").alias("other"), F.coalesce("city", F.lit("")).alias("city"))
    rows = clients.drop("city").where("client_id <> master_id").join(masters, "master_id").where("name IS NOT NULL AND other IS NOT NULL")
    rows = rows.select("client_id", text.normalize_for_match(F.col("name")).alias("a"), text.normalize_for_match(F.concat("other", F.lit(" "), "city")).alias("b"), text.normalize_for_match(F.col("other")).alias("m"))
    score = lambda f, x, y: F.round(f(x, y), 6)
    return rows.select("client_id", score(weighted_column, "a", "b").alias("with_city"), score(weighted_column, "a", "m").alias("name_only"), score(ratio_column, "a", "m").alias("plain"))


#: Words of all lists, and none, in a fixed order: names put together from them meet every rule, alone and together.
_WORDS = ["", *sorted(P.DIRECTIONS), *sorted(P.STOPWORDS - P.DIRECTIONS), *sorted(P.QUALIFIERS - P.STOPWORDS), *P.POI, *sorted(P.GENERIC), *sorted(P.EXONYMS), *sorted(P.UNTRUSTED), "dki", "n/a"]
_any_of = lambda c, words: "(" + " OR ".join(f"contains({c}, '{w}')" for w in sorted(words)) + ")"
_minor = f"lambda t: t = '' OR t = own OR t IN ({_quoted(P.QUALIFIERS)}) OR (regexp_full_match(t, '[a-z]{{1,3}}') AND t NOT IN ({_quoted(P.STOPWORDS)}))"


@_query(f"""WITH l AS (SELECT [{", ".join(f"'{w}'" for w in _WORDS)}] AS w),
n0 AS (SELECT client_id, updated_at, w[1 + (client_id * 7) % {len(_WORDS)}] AS a, w[1 + (client_id * 13 + 3) % {len(_WORDS)}] AS b, CASE WHEN client_id % 3 = 0 THEN '' ELSE coalesce(city, '') END AS city, coalesce(name, '') AS name FROM clients, l),
n AS (SELECT client_id, {_key("a || ' ' || city || ' ' || b")} AS key, {_key('b')} AS value, {_key('city')} AS own, {_key("city || ' ' || b")} AS longer, {_key("name || ' ' || b")} AS other FROM n0)
SELECT client_id, key IN ({_quoted(P.GENERIC)}) AS generic, key <> '' AND len(list_filter(string_split(key, ' '), lambda t: t NOT IN ({_quoted(P.DIRECTIONS)}))) = 0 AS direction,
  NOT {_any_of('key', P.ADMIN_WORDS)} AND len(list_filter(string_split(key, ' '), lambda t: t IN ({_quoted(P.FEATURES)}))) > 0 AND len(list_filter(string_split(key, ' '), lambda t: t NOT IN ({_quoted(P.FEATURES | P.DIRECTIONS | {'of', 'the'})}))) <= 1 AS feature,
  {_any_of('key', P.POI)} AS poi, {_any_of('key', P.ADMIN_WORDS)} AS admin_unit, {_clean('key')} AS phrase, len(list_intersect({_content('key')}, {_content('other')})) > 0 AS overlap,
  NOT ((length(value) > 3 AND value NOT IN ({_quoted(P.STOPWORDS)})) OR (value <> '' AND value = key)) AS poor_target,
  contains(own, ' ') OR own = '' OR NOT contains(longer, ' ') OR (list_contains(string_split(longer, ' '), own) AND len(list_filter(string_split(longer, ' '), {_minor})) = len(string_split(longer, ' '))) AS may_match,
  CASE value {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in P.EXONYMS.items())} ELSE value END AS exonym FROM n""")
def name_tests(spark, d):
    """Every test on names, on names put together from the words of all lists and the clients' cities."""
    words = F.array(*map(F.lit, _WORDS))
    pick = lambda by, add: F.get(words, ((F.col("client_id") * by + add) % len(_WORDS)).cast("int"))
    rows = _t(spark, d, "clients").select("client_id", pick(7, 0).alias("a"), pick(13, 3).alias("b"), F.when(F.col("client_id") % 3 == 0, "").otherwise(F.coalesce("city", F.lit(""))).alias("city"), F.coalesce("name", F.lit("")).alias("name"))
    key = lambda *parts: text.normalize_for_match(F.concat_ws(" ", *parts))
    rows = rows.select("client_id", key("a", "city", "b").alias("key"), key("b").alias("value"), key("city").alias("own"), key("city", "b").alias("longer"), key("name", "b").alias("other"))
    k, value = F.col("key"), F.col("value")
    return rows.select(
        "client_id", C.is_generic(k).alias("generic"), C.is_directional(k).alias("direction"), C.is_feature(k).alias("feature"), C.is_poi(k).alias("poi"), C.is_admin_unit(k).alias("admin_unit"), C.clean_phrase(k).alias("phrase"),
        C.content_overlap(k, F.col("other")).alias("overlap"), C.poor_target(value, k).alias("poor_target"), C.words_may_match(F.col("own"), F.col("longer")).alias("may_match"), C.exonym(value).alias("exonym"),
    )


_RAW = [*sorted(P.UNKNOWN), *sorted(P.LEVELS), "Admin1", " admin 2 ", "ADMIN2", "Oblast ", "N/A ", "not  sure", "?"]
_CODES = ["ken", " KEN ", "unk", "NULL", "N/A", "KE", "KENY", "k3n", "none", "", "uga", "Éta"]


@_query(f"""WITH l AS (SELECT [{", ".join(f"'{w}'" for w in _RAW)}] AS w, [{", ".join(f"'{w}'" for w in _CODES)}] AS c),
r AS (SELECT client_id, CASE WHEN client_id % 4 = 3 THEN coalesce(city, name) ELSE w[1 + (client_id * 5) % {len(_RAW)}] END AS raw, c[1 + client_id % {len(_CODES)}] AS code FROM clients, l), k AS (SELECT *, {_key("coalesce(raw, '')")} AS key FROM r)
SELECT client_id, CASE WHEN CASE key {' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in P.LEVELS.items())} ELSE upper(trim(raw)) END IN ('ADMIN0', 'ADMIN1', 'ADMIN2') THEN CASE key {' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in P.LEVELS.items())} ELSE upper(trim(raw)) END ELSE 'UNKNOWN' END AS level,
  CASE WHEN trim(coalesce(raw, '')) = '' OR key IN ({_quoted(P.UNKNOWN)}) THEN 'Unknown' ELSE trim(raw) END AS value, CASE WHEN regexp_full_match(upper(trim(code)), '[A-Z]{{3}}') AND upper(trim(code)) NOT IN ({_quoted(P.NO_ISO)}) THEN upper(trim(code)) END AS iso FROM k""")
def sanitized_values(spark, d):
    """Levels, stand-ins for unknown values and codes as they may come, and cities, each by its rule."""
    pick = lambda words, by: F.get(F.array(*map(F.lit, words)), ((F.col("client_id") * by) % len(words)).cast("int"))
    rows = _t(spark, d, "clients").select("client_id", F.when(F.col("client_id") % 4 == 3, F.coalesce("city", "name")).otherwise(pick(_RAW, 5)).alias("raw"), pick(_CODES, 1).alias("code"))
    rows = rows.withColumn("key", text.normalize_for_match(F.col("raw")))
    return rows.select("client_id", C.level(F.col("raw"), F.col("key")).alias("level"), C.known(F.col("raw"), F.col("key")).alias("value"), C.iso_key(F.col("code")).alias("iso"))


@_query("""WITH r AS (SELECT vendor_id, string_split(coalesce(name, '') || ',' || upper(coalesce(name, '')) || ',' || coalesce(name, ''), ',') AS names FROM vendors WHERE vendor_id IS NOT NULL)
SELECT vendor_id, array_to_string(list_sort(list_distinct(list_concat(names, list_transform(names, lambda x: strip_accents(x))))), '|') AS names FROM r""")
def accented_names(spark, d):
    """Vendors' names in two spellings, with and without accents, each once."""
    vendors = _t(spark, d, "vendors").where("vendor_id IS NOT NULL")
    name = F.coalesce("name", F.lit(""))
    blank = {c.split()[0]: F.lit("") for c in GEONAMES.split(", ")}
    raw = vendors.select(F.col("vendor_id"), *[v.alias(c) for c, v in (blank | {"geonameid": F.col("vendor_id").cast("string"), "alternatenames": F.concat_ws(",", name, F.upper(name), name)}).items()])
    codes = spark.createDataFrame([], "code string, name string")
    out = tables.enrich_geonames(raw, codes, codes, {})
    return out.select(F.col("geonameid").cast("bigint").alias("vendor_id"), F.array_join(F.array_sort("alternativenames"), "|").alias("names"))


_code = lambda c: f"'N' || chr(65 + {c} // 5) || chr(65 + {c} % 5)"


def _iso(c):
    return F.concat(F.lit("N"), F.chr(65 + F.floor(c / 5)), F.chr(65 + c % 5))


def _client_kb(spark, d):
    """Clients that are no copies, by nation and city."""
    clients = _t(spark, d, "clients").where("client_id = master_id AND nation_id IS NOT NULL AND name IS NOT NULL")
    nation = _t(spark, d, "nation").select(F.col("n_nationkey").alias("nation_id"), F.col("n_name").alias("Admin0"))
    return clients.join(nation, "nation_id").select("Admin0", F.coalesce("city", F.lit("")).alias("Admin1"), F.col("name").alias("Admin2"), _iso(F.col("nation_id")).alias("Admin0_ISO3"))


_KB = f"k AS (SELECT n_name AS a0, coalesce(city, '') AS a1, name AS a2, {_code('nation_id')} AS iso, {_key('n_name')} AS k0, {_key("coalesce(city, '')")} AS k1, {_key('name')} AS k2 FROM clients JOIN nation ON nation_id = n_nationkey WHERE client_id = master_id AND name IS NOT NULL)"

_ASKED = f"""a AS (SELECT DISTINCT {_key("left(c.city, length(c.city) - CAST(c.change_id % 3 AS INTEGER)) || CASE WHEN c.change_id % 5 = 0 THEN ' oblast' ELSE '' END")} AS key, {_code('nation_id')} AS iso FROM client_changes c JOIN clients USING (client_id) WHERE c.city IS NOT NULL AND nation_id IS NOT NULL)"""


@_query(f"""WITH {_KB}, {_ASKED}, v AS (SELECT DISTINCT iso, a1 AS value, k1 AS vkey FROM k WHERE a1 <> ''),
u AS (SELECT key AS a, vkey AS b FROM a JOIN v USING (iso)), {_scores('s', 'u')},
r AS (SELECT key, iso, value, score, row_number() OVER (PARTITION BY key, iso ORDER BY score DESC, value) AS n FROM a JOIN v USING (iso) JOIN s ON s.a = key AND s.b = vkey WHERE score >= 80)
SELECT key, iso, value, round(score, 6) AS score FROM r WHERE n = 1""")
def similar_cities(spark, d):
    """For each city of a change, cut short or with a qualifier, the most similar city of its nation from a score of 80 on."""
    change = _t(spark, d, "client_changes").where("city IS NOT NULL").select("change_id", "client_id", "city")
    rows = change.join(_t(spark, d, "clients").where("nation_id IS NOT NULL").select("client_id", "nation_id"), "client_id")
    cut = F.concat(F.left("city", F.length("city") - (F.col("change_id") % 3).cast("int")), F.when(F.col("change_id") % 5 == 0, " oblast").otherwise(""))
    asked = staged(rows.select(text.normalize_for_match(cut).alias("key"), F.array(_iso(F.col("nation_id"))).alias("isos")).distinct(), "asked")
    known = grounding.index_units(staged(kb.with_keys(_client_kb(spark, d)), "kb"))
    best = grounding.most_similar(asked, known, (1,), True, 80.0)
    return best.select("key", F.get("isos", F.lit(0)).alias("iso"), "value", F.round("score", 6).alias("score"))


def _linked(spark, d):
    """An article a copied client: its name as a place, with a level by its segment, its nation for four of five, its city cut short for a third."""
    clients = _t(spark, d, "clients").where("client_id <> master_id AND name IS NOT NULL AND nation_id IS NOT NULL")
    nation = _t(spark, d, "nation").select(F.col("n_nationkey").alias("nation_id"), "n_name")
    rows, i = clients.join(nation, "nation_id"), F.col("client_id")
    level = F.when(F.col("segment") == "retail", "city").when(F.col("segment") == "online", "province").when(F.col("segment") == "public", "Other").otherwise("site")
    city = F.when(i % 3 == 0, F.left("city", F.length("city") - 1)).otherwise(F.col("city"))
    place = F.struct(level.alias("location_level"), F.when(i % 5 != 4, F.col("n_name")).otherwise("Unknown").alias("admin0"), city.alias("admin1"), F.lit("Unknown").alias("admin2"))
    none = F.from_json(F.lit("{}"), f"map<string,{LOCATION}>")
    return rows.select(i.alias("_id"), F.create_map("name", place).alias("gemini_locations"), none.alias("gemini_locations_normalized"), F.from_json(F.lit("{}"), "map<string,array<string>>").alias("cliff_locations"))


#: m: mentions; r: canonical cities; x: texts to look up with their order; all pairs of a level, under the nation where it is known.
_SEARCH = f"""{_KB},
m0 AS (SELECT client_id AS id, name, {_key('name')} AS key, CASE segment WHEN 'retail' THEN 2 WHEN 'online' THEN 1 END AS likely, CASE WHEN client_id % 5 <> 4 THEN {_code('nation_id')} END AS iso, CASE WHEN client_id % 5 <> 4 THEN n_name ELSE 'Unknown' END AS a0, CASE WHEN client_id % 3 = 0 THEN left(city, length(city) - 1) ELSE city END AS city FROM clients JOIN nation ON nation_id = n_nationkey WHERE client_id <> master_id AND name IS NOT NULL),
m1 AS (SELECT *, coalesce(nullif(trim(city), ''), 'Unknown') AS city1, {_key("coalesce(city, '')")} AS ckey0 FROM m0 WHERE key <> ''),
m2 AS (SELECT *, CASE WHEN city1 <> 'Unknown' THEN ckey0 END AS ckey, iso IN (SELECT iso FROM k) AS known FROM m1),
v AS (SELECT DISTINCT 1 AS level, iso, a1 AS value, k1 AS vkey FROM k WHERE a1 <> '' UNION ALL SELECT DISTINCT 2, iso, a2, k2 FROM k),
f AS (SELECT token, count(*) AS held FROM (SELECT DISTINCT level, value, unnest(string_split(vkey, ' ')) AS token FROM v) WHERE token <> '' AND token NOT IN ({_quoted(P.STOPWORDS)}) GROUP BY token),
cp AS (SELECT DISTINCT ckey AS a, vkey AS b FROM m2 JOIN v ON v.iso = m2.iso AND level = 1 WHERE ckey IS NOT NULL AND known),
{_scores('cs', 'cp')},
c AS (SELECT id, value, vkey FROM (SELECT m2.id, value, vkey, score, row_number() OVER (PARTITION BY m2.id ORDER BY score DESC, value) AS n FROM m2 JOIN v ON v.iso = m2.iso AND level = 1 JOIN cs ON a = ckey AND b = vkey WHERE known) JOIN m2 USING (id) JOIN cs_l ON x = ckey AND y = vkey
  WHERE n = 1 AND score >= 93 AND length(vkey) > 3 AND vkey NOT IN ({_quoted(P.STOPWORDS)}) AND (contains(vkey, ckey) OR contains(ckey, vkey) OR 200.0 * common / (length(ckey) + length(vkey)) >= 80)),
m AS (SELECT m2.id, m2.name, key, likely, CASE WHEN known THEN iso END AS iso, known AS strong, a0, coalesce(c.value, city1) AS a1, coalesce(c.vkey, ckey) AS ukey, {_clean('key')} AS cleaned FROM m2 LEFT JOIN c ON c.id = m2.id),
al AS (SELECT cleaned AS a, {_clean('ukey')} AS b FROM m WHERE ukey IS NOT NULL), {_scores('als', 'al')},
b0 AS (SELECT id, 0 AS pos, key, trim(name) AS text, 'surface' AS kind FROM m UNION ALL SELECT id, 1, cleaned, cleaned, 'cleaned' FROM m WHERE cleaned <> '' AND cleaned <> key
  UNION ALL SELECT id, 4, ukey, trim(a1), 'alias_admin1' FROM m LEFT JOIN als ON a = cleaned AND b = {_clean('ukey')} WHERE ukey IS NOT NULL AND ukey <> key AND ukey NOT IN ('', 'unknown') AND {_alias('cleaned', _clean('ukey'), 'als.score')}
  UNION ALL SELECT id, 5, {_clean('ukey')}, {_clean('ukey')}, 'cleaned' FROM m LEFT JOIN als ON a = cleaned AND b = {_clean('ukey')} WHERE ukey IS NOT NULL AND ukey <> key AND {_clean('ukey')} NOT IN ('', ukey) AND {_alias('cleaned', _clean('ukey'), 'als.score')}),
b1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id, key ORDER BY pos) AS n FROM b0) WHERE n = 1),
t0 AS (SELECT id, pos, token, coalesce(held, 0) AS held FROM (SELECT DISTINCT id, pos, unnest({_content('key')}) AS token FROM b1) LEFT JOIN f USING (token)),
t1 AS (SELECT DISTINCT id, token, held FROM (SELECT *, row_number() OVER (PARTITION BY id, pos ORDER BY held, length(token) DESC, token) AS n FROM t0) WHERE n <= 3),
t2 AS (SELECT *, 5 + row_number() OVER (PARTITION BY id ORDER BY held, length(token) DESC, token) AS pos FROM t1),
x AS (SELECT id, pos, key, text, kind, CAST(NULL AS BIGINT) AS held FROM b1 UNION ALL SELECT id, pos, token, token, 'token', held FROM t2 WHERE (id, token) NOT IN (SELECT id, key FROM b1))"""


@_query(f"WITH {_SEARCH} SELECT id AS doc, CAST(row_number() OVER (PARTITION BY id ORDER BY pos) AS INTEGER) AS place, text, kind, held FROM x")
def query_variants(spark, d):
    """The texts under which each name is looked up, in their order, with the units that hold a rare word."""
    tables = grounding.prepare(_linked(spark, d), _client_kb(spark, d))
    ready = staged(unit_search.canonical_units(tables.asked.where(~F.col("country_like") & grounding.skipped(F.col("key")).isNull()), tables.units), "ready")
    out = unit_search.query_variants(ready, tables.units.keyed).select("doc", "at", "text", "kind", "held")
    places = out.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("at", "text", "kind", "held"))).alias("v"))
    return places.select("doc", F.posexplode("v").alias("i", "v")).select("doc", (F.col("i") + 1).alias("place"), "v.text", "v.kind", "v.held")


_HITS = f"""{_SEARCH},
e AS (SELECT x.*, m.key AS name_key, cleaned, likely, m.iso, strong, ukey, a0, a1 FROM x JOIN m ON m.id = x.id),
q AS (SELECT DISTINCT e.key, e.iso, v.level, v.value, v.vkey FROM e JOIN v ON e.iso IS NULL OR v.iso = e.iso),
qp AS (SELECT key AS a, vkey AS b FROM q), {_scores('qs', 'qp')},
best AS (SELECT key, iso, level, value, vkey, score FROM (SELECT q.*, score, row_number() OVER (PARTITION BY key, q.iso, level ORDER BY score DESC, value) AS n FROM q JOIN qs ON a = key AND b = vkey WHERE score >= 80) WHERE n = 1),
w AS (SELECT e.*, p.value AS v1, p.vkey AS x1, coalesce(p.score, 0) AS s1, r.value AS v2, r.vkey AS x2, coalesce(r.score, 0) AS s2 FROM e LEFT JOIN best p ON p.key = e.key AND p.iso IS NOT DISTINCT FROM e.iso AND p.level = 1 LEFT JOIN best r ON r.key = e.key AND r.iso IS NOT DISTINCT FROM e.iso AND r.level = 2),
g0 AS (SELECT *, CASE WHEN likely = 2 THEN v2 IS NOT NULL AND s2 >= s1 - 5 WHEN likely = 1 THEN NOT (v1 IS NOT NULL AND s1 >= s2 - 5) ELSE s2 > s1 END AS low FROM w),
g1 AS (SELECT id, pos, key, text, kind, held, name_key, cleaned, likely, iso, strong, ukey, CASE WHEN low THEN 2 ELSE 1 END AS level, CASE WHEN low THEN v2 ELSE v1 END AS value, CASE WHEN low THEN x2 ELSE x1 END AS vkey, CASE WHEN low THEN s2 ELSE s1 END AS score FROM g0),
h0 AS (SELECT e.id, e.pos, e.key, e.text, e.kind, name_key, cleaned, likely, e.iso, strong, ukey, level, value, vkey FROM e JOIN (SELECT DISTINCT level, value, vkey, unnest(string_split(vkey, ' ')) AS token FROM v) t ON t.token = e.key WHERE kind = 'token' AND held BETWEEN 1 AND 18 AND (e.iso IS NOT NULL OR held <= 3)),
np AS (SELECT cleaned AS a, {_clean('vkey')} AS b FROM g1 WHERE value IS NOT NULL UNION ALL SELECT cleaned, {_clean('vkey')} FROM h0), {_scores('ns', 'np')},
tp AS (SELECT key AS a, vkey AS b FROM h0), {_scores('ts', 'tp')},
g2 AS (SELECT g1.*, qs.score AS again, ql.common FROM g1 JOIN qs ON qs.a = key AND qs.b = vkey JOIN qs_l ql ON ql.x = key AND ql.y = vkey LEFT JOIN ns ON ns.a = cleaned AND ns.b = {_clean('vkey')}
  WHERE g1.score >= CASE WHEN iso IS NOT NULL OR strong THEN 85 WHEN kind = 'token' AND held > 25 THEN 95 WHEN kind = 'token' AND held > 12 THEN 92 ELSE 88 END
  AND ((length(vkey) > 3 AND vkey NOT IN ({_quoted(P.STOPWORDS)})) OR vkey = key) AND (len(list_intersect({_content('key')}, {_content('vkey')})) > 0 OR qs.score >= 95) AND {_alias('cleaned', _clean('vkey'), 'ns.score')}
  AND (contains(key, ' ') OR NOT contains(vkey, ' ') OR (list_contains(string_split(vkey, ' '), key) AND len(list_filter(string_split(vkey, ' '), lambda t: t <> key AND t NOT IN ({_quoted(P.QUALIFIERS)}) AND NOT (regexp_full_match(t, '[a-z]{{1,3}}') AND t NOT IN ({_quoted(P.STOPWORDS)})))) = 0))
  AND NOT (contains(key, ' ') AND list_contains(string_split(key, ' '), vkey) AND g1.score < 97 AND 200.0 * ql.common / (length(key) + length(vkey)) < 85)),
h1 AS (SELECT h0.*, ns.score AS alike FROM h0 LEFT JOIN ns ON ns.a = cleaned AND ns.b = {_clean('vkey')} LEFT JOIN ts ON ts.a = key AND ts.b = vkey WHERE {_alias('cleaned', _clean('vkey'), 'ns.score')} AND (len(list_intersect({_content('name_key')}, {_content('vkey')})) > 0 OR ts.score >= 95)),
rq AS (SELECT id, pos, level, value, vkey, iso, ukey FROM g2 UNION SELECT id, pos, level, value, vkey, iso, ukey FROM h1),
rr AS (SELECT * FROM (SELECT rq.id, rq.pos, rq.level, rq.value, k.a0, k.a1, k.a2, row_number() OVER (PARTITION BY rq.id, rq.pos, rq.level, rq.value ORDER BY CASE rq.level WHEN 1 THEN k.a1 ELSE k.a2 END <> rq.value, coalesce(k1 <> ukey, false), k.a0, k.a1, k.a2, k.iso) AS n
  FROM rq JOIN k ON CASE rq.level WHEN 1 THEN k1 ELSE k2 END = vkey AND CASE rq.level WHEN 1 THEN k.a1 ELSE k.a2 END <> '' AND (rq.iso IS NULL OR k.iso = rq.iso)) WHERE n = 1),
tok AS (SELECT id, pos, text, kind, level, value, r0, r1, 100.0::DOUBLE AS score, 'token' AS method FROM (SELECT h1.*, rr.a0 AS r0, rr.a1 AS r1, row_number() OVER (PARTITION BY h1.id ORDER BY h1.pos, (h1.level = 2 AND coalesce(likely = 2, false)) DESC, alike DESC, h1.level DESC, h1.value DESC, rr.a0 DESC, rr.a1 DESC, rr.a2 DESC) AS n FROM h1 JOIN rr ON rr.id = h1.id AND rr.pos = h1.pos AND rr.level = h1.level AND rr.value = h1.value) WHERE n = 1),
sim AS (SELECT g2.id, g2.pos, text, kind, g2.level, g2.value, rr.a0 AS r0, rr.a1 AS r1, score, likely, row_number() OVER (PARTITION BY g2.id ORDER BY g2.pos) AS n FROM g2 JOIN rr ON rr.id = g2.id AND rr.pos = g2.pos AND rr.level = g2.level AND rr.value = g2.value),
fold AS (SELECT * FROM sim WHERE n = 1 UNION ALL
  SELECT s.id, CASE WHEN up THEN s.pos ELSE fold.pos END, CASE WHEN up THEN s.text ELSE fold.text END, CASE WHEN up THEN s.kind ELSE fold.kind END, CASE WHEN up THEN s.level ELSE fold.level END, CASE WHEN up THEN s.value ELSE fold.value END, CASE WHEN up THEN s.r0 ELSE fold.r0 END, CASE WHEN up THEN s.r1 ELSE fold.r1 END, CASE WHEN up THEN s.score ELSE fold.score END, s.likely, s.n
  FROM fold JOIN sim s ON s.id = fold.id AND s.n = fold.n + 1 CROSS JOIN LATERAL (SELECT s.score - fold.score > 0.1 OR (abs(s.score - fold.score) <= 0.1 AND coalesce(s.likely = 2, false) AND s.level = 2 AND fold.level <> 2) AS up)),
fuz AS (SELECT id, pos, text, kind, level, value, r0, r1, score, 'fuzzy_admin' || level AS method FROM (SELECT *, max(n) OVER (PARTITION BY id) AS last FROM fold) WHERE n = last),
hit AS (SELECT * FROM tok UNION ALL SELECT * FROM fuz WHERE id NOT IN (SELECT id FROM tok))"""

#: res: the result of each mention.
_RECONCILED = f"""WITH RECURSIVE {_HITS},
res AS (SELECT m.id, m.name, m.key, m.likely, m1.ckey0, coalesce('ADMIN' || level, CASE m.likely WHEN 1 THEN 'ADMIN1' WHEN 2 THEN 'ADMIN2' ELSE 'UNKNOWN' END) AS level, coalesce(nullif(r0, ''), m.a0) AS admin0, CASE WHEN level = 1 THEN value ELSE coalesce(nullif(r1, ''), m.a1) END AS admin1, CASE WHEN level = 2 THEN value ELSE 'Unknown' END AS admin2,
  coalesce(method, 'no_match_keep_gemini') AS method, text AS term, kind, round(score, 6) AS score FROM m JOIN m1 ON m1.id = m.id LEFT JOIN hit ON hit.id = m.id)"""


@_query(f"{_RECONCILED} SELECT id AS doc, name, level, admin0, admin1, admin2, method, term, kind, score FROM res")
def linked_units(spark, d):
    """Copied clients' names reconciled with clients: the unit found for each, how, and by which text."""
    tables = grounding.prepare(_linked(spark, d), _client_kb(spark, d))
    return unit_search.place_results(tables).select("doc", "name", "level", "admin0", "admin1", "admin2", "method", "term", "kind", F.round("score", 6).alias("score"))


_holds_any = lambda c, words: "(" + " OR ".join(f"contains(coalesce({c}, ''), '{w}')" for w in sorted(words)) + ")"


@_query(f"""{_RECONCILED}
SELECT id AS _id, name, level AS location_level, admin0, admin1, admin2,
  CASE WHEN admin0 = 'Unknown' THEN 'OK' WHEN NOT EXISTS (SELECT 1 FROM k WHERE k0 = {_key('admin0')}) THEN 'REVISIT' WHEN {_holds_any('key', P.POI)} OR NOT (likely IS NOT NULL OR {_holds_any('key', P.ADMIN_WORDS)} OR {_holds_any('ckey0', P.ADMIN_WORDS)}) THEN 'OK'
    WHEN level = 'ADMIN1' THEN CASE WHEN EXISTS (SELECT 1 FROM k WHERE k0 = {_key('admin0')} AND k1 <> '' AND k1 = {_key('admin1')}) THEN 'OK' ELSE 'REVISIT' END
    WHEN level = 'ADMIN2' THEN CASE WHEN EXISTS (SELECT 1 FROM k WHERE k0 = {_key('admin0')} AND k1 <> '' AND k1 = {_key('admin1')} AND k2 = {_key('admin2')}) THEN 'OK' ELSE 'REVISIT' END ELSE 'REVISIT' END AS status FROM res""")
def reconciled_locations(spark, d):
    """The whole chain over articles of copied clients: the place of each, its ladder, and whether the article needs a second look."""
    out = unit_search.reconcile_articles(_linked(spark, d), _client_kb(spark, d))
    return out.select("_id", F.explode_outer("reconciled_locations").alias("name", "place"), F.col("reconciled_locations_meta.status").alias("status")).select("_id", "name", "place.*", "status")
