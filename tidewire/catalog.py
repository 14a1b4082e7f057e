"""Queries of the news-corpus operators over the driver's tables, and the SQL that checks them.

The tables stand in for the corpus: documents for articles, pages for urls and HTML, orders for
publishing dates, labels for gates, nations and regions for administrative units.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.functions import nested, placecolumns, text
from tidewire.operators import classify, curate, filters, geo, kb, reports, translate
from tidewire.sources import tables

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query("""
WITH m AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
                  count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS n_include
           FROM orders GROUP BY 1, 2)
SELECT year, month, n, n_include,
       CAST(sum(n) OVER (ORDER BY year, month) AS BIGINT) AS n_running,
       CAST(sum(n_include) OVER (ORDER BY year, month) AS BIGINT) AS n_include_running
FROM m""")
def monthly_counts_running(spark, d):
    orders = _t(spark, d, "orders")
    return reports.monthly_counts(orders, "o_orderdate", orders["o_orderstatus"] == "F")


@_query("SELECT lang, count(*) AS n, count(*) - 1 AS n_reference FROM documents GROUP BY lang")
def language_histogram(spark, d):
    return reports.language_histogram(_t(spark, d, "documents"), "lang")


@_query("SELECT CAST(last_day(m) AS VARCHAR) AS month_end FROM (SELECT unnest(generate_series(DATE '2012-01-01', DATE '2024-03-15', INTERVAL 1 MONTH)) AS m) WHERE last_day(m) <= DATE '2024-03-15'")
def month_range(spark, d):
    return reports.month_range(spark, "2012-01-01", "2024-03-15").select(F.col("month_end").cast("string").alias("month_end"))


_SOURCES = """src AS (SELECT source AS source_domain, count(*) > 1 AS include, [CASE WHEN ascii(right(source, 1)) % 3 = 0 THEN 'KEN' ELSE 'UGA' END] AS primary_location, source LIKE '%7' AS major_international, source LIKE '%9' AS major_regional FROM documents GROUP BY source)"""


def _sources(spark, d):
    return _t(spark, d, "documents").groupBy(F.col("source").alias("source_domain")).agg(
        (F.count("*") > 1).alias("include"), F.array(F.when(F.ascii(F.right(F.first("source"), F.lit(1))) % 3 == 0, "KEN").otherwise("UGA")).alias("primary_location"),
        F.first("source").like("%7").alias("major_international"), F.first("source").like("%9").alias("major_regional"),
    )


@_query(f"WITH {_SOURCES} SELECT doc_id, source FROM documents WHERE source IN (SELECT source_domain FROM src WHERE include AND (list_contains(primary_location, 'KEN') OR major_international OR major_regional))")
def source_semi_join(spark, d):
    domains = filters.eligible_sources(_sources(spark, d), ["KEN"], international=True, regional=True)
    return filters.from_sources(_t(spark, d, "documents").withColumnRenamed("source", "source_domain"), domains).select("doc_id", F.col("source_domain").alias("source"))


@_query(r"SELECT page_id, regexp_replace(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1), '^(www|ww2)\.', '') AS source_domain FROM pages")
def url_domain(spark, d):
    return _t(spark, d, "pages").select("page_id", text.pull_source_domain(F.col("url")).alias("source_domain"))


@_query(r"SELECT page_id, CASE WHEN regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1) = '' THEN url ELSE regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) || regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1), ';[^/]*$', '') END AS clean_url FROM pages")
def url_cut_query(spark, d):
    return _t(spark, d, "pages").select("page_id", text.cut_url_query(F.col("url")).alias("clean_url"))


_RULES = [("blog.tionsh.example.net", ["/fr/", "page="]), ("thther.example.org", ["#top"]), ("www.ththhe.example.com", [])]


def _rules(spark):
    return spark.createDataFrame(_RULES, "source_domain string, blacklist_url_patterns array<string>")


@_query(r"""WITH r(dom, pats) AS (VALUES ('blog.tionsh.example.net', ['/fr/', 'page=']), ('thther.example.org', ['#top']), ('www.ththhe.example.com', CAST([] AS VARCHAR[]))),
p AS (SELECT page_id, url, regexp_extract(url, '//([^/?#]*)', 1) AS dom FROM pages)
SELECT page_id, coalesce(len(list_filter(pats, lambda x: contains(url, x))) = 0, false) AS allowed FROM p LEFT JOIN r USING (dom)""")
def url_blacklist(spark, d):
    pages = _t(spark, d, "pages").select("page_id", "url", F.regexp_extract("url", "//([^/?#]*)", 1).alias("source_domain"))
    return filters.url_allowed(pages, _rules(spark)).select("page_id", "allowed")


@_query(r"""SELECT page_id, coalesce((regexp_extract(url, '//([^/?#]*)', 1) = 'blog.tionsh.example.net' AND regexp_matches(url, '(/fr/|page=)')) OR (regexp_extract(url, '//([^/?#]*)', 1) = 'thther.example.org' AND regexp_matches(url, '(#top)')), false) AS blacklisted FROM pages""")
def url_blacklist_regex(spark, d):
    pages = _t(spark, d, "pages").select("page_id", "url", F.regexp_extract("url", "//([^/?#]*)", 1).alias("source_domain"))
    return filters.blacklist_split(pages, _rules(spark)).select("page_id", "blacklisted")


@_query("""SELECT doc_id, CASE
 WHEN instr(substr(text,1,30), ' — ') > 0 THEN substr(text, instr(text, ' — ') + 3)
 WHEN instr(substr(text,1,30), '--') > 0 THEN substr(text, instr(text, '--') + 2)
 WHEN instr(substr(text,1,30), ' - ') > 0 THEN substr(text, instr(text, ' - ') + 3)
 WHEN instr(substr(text,1,30), '(CNN)') > 0 THEN substr(text, instr(text, '(CNN)') + 5)
 WHEN instr(substr(text,1,20), ': ') > 0 THEN substr(text, instr(text, ': ') + 2)
 WHEN instr(substr(text,1,20), chr(10)) > 0 THEN substr(text, instr(text, chr(10)) + 1)
 ELSE text END AS body FROM documents""")
def cut_dateline(spark, d):
    return _t(spark, d, "documents").select("doc_id", text.cut_dateline(F.col("text")).alias("body"))


@_query(r"""SELECT doc_id, substr(trim(regexp_replace(translate(text, chr(10) || '\“”’', '  ""' || chr(39)), '\s+', ' ', 'g')), 1, 800) AS body FROM documents""")
def clean_text_cap(spark, d):
    return _t(spark, d, "documents").select("doc_id", text.clean_text(F.col("text")).alias("body"))


@_query("""SELECT doc_id, lang || '. ' || translate(substr(text, 1, 1200), chr(10) || '“”"', '') AS combined FROM documents""")
def final_text_en(spark, d):
    return _t(spark, d, "documents").select("doc_id", text.final_text(F.col("lang"), F.col("text"), 1200, always=True).alias("combined"))


@_query(r"""SELECT doc_id, CASE WHEN len(s) >= 2 THEN lang || '. ' || s[1] || s[2] WHEN len(s) = 1 THEN lang || '. ' || s[1] ELSE lang END AS combined
FROM (SELECT doc_id, lang, list_filter(string_split(regexp_replace(trim(text), '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: x <> '') AS s FROM documents)""")
def title_and_sentences(spark, d):
    return _t(spark, d, "documents").select("doc_id", text.build_combined(F.col("lang"), F.col("text")).alias("combined"))


@_query(r"""SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?i)(-+\s*advertisement\s*-+|advertorial|adverts?|publicit[eé]|sponsored\s+post)', '', 'g'), '(?is)<script.*?>.*?</script>', '', 'g'), '(?is)<style.*?>.*?</style>', '', 'g'), '(?is)<iframe.*?>.*?</iframe>', '', 'g') AS html FROM pages""")
def strip_blocks(spark, d):
    return _t(spark, d, "pages").select("page_id", text.strip_blocks(F.col("html")).alias("html"))


@_query(r"""SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(nfc_normalize(text), '[\x00-\x08\x0B\x0C\x0E-\x1F\n\r\t]+', ' ', 'g'), '[^a-zA-Z\x{C0}-\x{24F}0-9\s.,;:\-''"?!()&%$@#=_/\\]+', ' ', 'g'), '\s+', ' ', 'g')) AS body FROM documents""")
def moderate_clean(spark, d):
    return _t(spark, d, "documents").select("doc_id", text.moderate_clean(F.col("text")).alias("body"))


@_query(r"""SELECT doc_id, trim(regexp_replace(regexp_replace(lower(strip_accents(text)), '[^\p{L}\p{N}_\s]', ' ', 'g'), '\s+', ' ', 'g')) AS key FROM documents""")
def match_keys_whole(spark, d):
    return _t(spark, d, "documents").select("doc_id", text.normalize_for_match(F.col("text")).alias("key"))


@_query("SELECT min(doc_id) AS doc_id, text FROM documents GROUP BY text")
def dedup_keep_first(spark, d):
    return curate.split_duplicates(_t(spark, d, "documents"), ["text"], "doc_id")[0].select("doc_id", "text")


@_query("SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS r FROM documents) WHERE r > 1")
def dedup_tombstones(spark, d):
    return curate.split_duplicates(_t(spark, d, "documents"), ["text"], "doc_id")[1].select("doc_id")


@_query("SELECT min(doc_id) AS doc_id FROM documents GROUP BY source, text")
def dedup_two_columns(spark, d):
    return curate.split_duplicates(_t(spark, d, "documents"), ["source", "text"], "doc_id")[0].select("doc_id")


@_query("""SELECT event_id, CASE WHEN a >= b AND a >= c THEN 'a' WHEN b >= c THEN 'b' ELSE 'c' END AS best,
CASE WHEN greatest(a, b, c) < CASE WHEN a >= b AND a >= c THEN 0.5 WHEN b >= c THEN 3.0 ELSE 'Infinity'::DOUBLE END THEN '-999' ELSE CASE WHEN a >= b AND a >= c THEN 'a' WHEN b >= c THEN 'b' ELSE 'c' END END AS event_type
FROM (SELECT event_id, value % 7.0 AS a, CAST(user_id % 5 AS DOUBLE) AS b, CAST(event_id % 3 AS DOUBLE) AS c FROM events)""")
def map_argmax_cutoff(spark, d):
    e = _t(spark, d, "events").select("event_id", (F.col("value") % 7.0).alias("a"), (F.col("user_id") % 5).cast("double").alias("b"), (F.col("event_id") % 3).cast("double").alias("c"))
    scores = F.create_map(F.lit("a"), "a", F.lit("b"), "b", F.lit("c"), "c")
    cut = F.create_map(F.lit("a"), F.lit(0.5), F.lit("b"), F.lit(3.0))
    event = F.struct(F.lit("x").alias("event_type"), scores.alias("model_outputs"))
    fixed = curate.repair_cutoff(event, cut)["event_type"]
    return e.select("event_id", nested.map_argmax(scores).alias("best"), F.when(fixed == "-999", fixed).otherwise(nested.map_argmax(scores)).alias("event_type"))


@_query("""WITH r AS (SELECT vec_id, i, embedding[i + 1]::DOUBLE AS p, row_number() OVER (PARTITION BY vec_id ORDER BY embedding[i + 1]::DOUBLE DESC, i) AS k FROM embeddings, range(64) t(i))
SELECT vec_id, CAST(max(i) FILTER (k = 1) AS INTEGER) AS first_label, CAST(max(i) FILTER (k = 2 AND p > 0.25) AS INTEGER) AS second_label FROM r GROUP BY vec_id""")
def top2_threshold(spark, d):
    labels = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: i)
    two = nested.top_two(F.col("embedding").cast("array<double>"), labels, 0.25)
    return _t(spark, d, "embeddings").select("vec_id", two["env_max"].alias("first_label"), two["env_sec"].alias("second_label"))


@_query("""SELECT vec_id, round(list_max(s), 6) AS top, round(list_sum(s), 6) AS total FROM (
SELECT vec_id, list_transform(e, lambda x: exp(x - list_max(e)) / list_sum(list_transform(e, lambda y: exp(y - list_max(e))))) AS s FROM (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings))""")
def softmax(spark, d):
    s = nested.softmax(F.col("embedding").cast("array<double>"))
    return _t(spark, d, "embeddings").select("vec_id", F.round(F.array_max(s), 6).alias("top"), F.round(F.aggregate(s, F.lit(0.0), lambda a, x: a + x), 6).alias("total"))


@_query("""SELECT r_name AS iso, string_agg(n_name, ',' ORDER BY n_nationkey) AS names FROM region JOIN nation ON r_regionkey = n_regionkey GROUP BY r_name""")
def iso_name_map(spark, d):
    rows = _t(spark, d, "nation").join(_t(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    one = rows.agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "r_name", "n_name"))).alias("m"))
    m = geo.group_names(F.concat("m", "m"), lambda x: x["r_name"], lambda x: x["n_name"])
    return one.select(F.explode(m).alias("iso", "names")).select("iso", F.array_join("names", ",").alias("names"))


@_query("""SELECT n_name AS name, min(r_name) AS iso FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY n_name""")
def names_deduplicated_overall(spark, d):
    rows = _t(spark, d, "nation").join(_t(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    one = rows.agg(F.array_sort(F.collect_list(F.struct(F.col("n_nationkey"), F.col("n_name").alias("name"), F.col("r_name").alias("country_code3")))).alias("m"))
    return one.select(F.explode(geo.places_deduplicated_overall(F.concat("m", "m"))).alias("iso", "names")).select(F.explode("names").alias("name"), "iso")


@_query("""SELECT doc_id, CASE WHEN contains(text, 'West Africa') THEN 'x' ELSE '' END || CASE WHEN source LIKE '%1' AND regexp_matches(text, '(?i)the([^A-Za-z]|$)') AND NOT regexp_matches(text, '(?i)angola') THEN 'None=Sahel,West Africa' ELSE 'AGO=Republic of Angola;None=Sahel' END AS places FROM documents""")
def array_union_patch(spark, d):
    docs = _t(spark, d, "documents")
    t = F.when(F.col("source").like("%1"), F.regexp_replace("text", r"(?i)\bthe\b(?=[^A-Za-z]|$)|the(?=[^A-Za-z]|$)", "West Africa")).otherwise(F.lit(""))
    m = F.create_map(F.lit("AGO"), F.array(F.lit("Republic of Angola")), F.lit("None"), F.array(F.lit("Sahel")))
    out = curate.west_africa_patch(m, t)
    return docs.select("doc_id", F.concat(F.when(F.contains("text", F.lit("West Africa")), "x").otherwise(""), F.array_join(F.transform(F.map_entries(out), lambda e: F.concat(e["key"], F.lit("="), F.array_join(e["value"], ","))), ";")).alias("places"))


@_query("""WITH p AS (SELECT s_nationkey AS doc, s_suppkey AS position, CASE WHEN s_suppkey % 3 = 0 THEN lower(n_name) WHEN s_suppkey % 3 = 1 THEN 'Republic of ' || n_name ELSE n_name || ' area' END AS name, CASE WHEN s_suppkey % 5 = 0 THEN 'UNKNOWN' ELSE 'ADMIN0' END AS lvl, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey),
r AS (SELECT *, row_number() OVER (PARTITION BY doc, CASE WHEN lvl = 'UNKNOWN' THEN 'u' || position ELSE n_name END ORDER BY CASE WHEN position % 3 = 0 THEN 0 ELSE 1 END, CASE WHEN position % 3 = 1 THEN 2 ELSE 0 END, length(name), position) AS k FROM p)
SELECT CAST(doc AS INTEGER) AS doc, position, name FROM r WHERE k = 1""")
def ladder_dedup(spark, d):
    rows = _t(spark, d, "supplier").join(_t(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    k = F.col("s_suppkey") % 3
    places = rows.select(
        F.col("s_nationkey").alias("doc"), F.col("s_suppkey").alias("position"), F.when(k == 0, F.lower("n_name")).when(k == 1, F.concat(F.lit("Republic of "), "n_name")).otherwise(F.concat("n_name", F.lit(" area"))).alias("name"),
        F.when(F.col("s_suppkey") % 5 == 0, "UNKNOWN").otherwise("ADMIN0").alias("location_level"), F.col("n_name").alias("admin0"), F.lit("Unknown").alias("admin1"), F.lit("Unknown").alias("admin2"),
    )
    return kb.deduplicate_ladders(places, "doc").select("doc", "position", "name")


def _ladder_kb(spark, d):
    rows = _t(spark, d, "supplier").join(_t(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(_t(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.select(F.col("r_name").alias("Admin0"), F.col("n_name").alias("Admin1"), F.col("s_name").alias("Admin2"), F.substring("r_name", 1, 3).alias("Admin0_ISO3"))


@_query(r"""WITH v AS (SELECT DISTINCT p_name AS value FROM part), t AS (SELECT DISTINCT unnest(string_split(trim(regexp_replace(regexp_replace(lower(value), '[^a-z0-9_\s]', ' ', 'g'), '\s+', ' ', 'g')), ' ')) AS token, value FROM v)
SELECT token, count(*) AS n FROM t WHERE token <> '' AND token NOT IN ('north','south','east','west','central','northern','southern','eastern','western','northwest','northeast','southwest','southeast','upper','lower','mid','middle','province','district','region','oblast','state','county','municipality','department','prefecture','commune','governorate','republic','kingdom','emirate','federation','city','town','village','villa','river','lake','mount','mountain','valley','bay','gulf','ocean','sea','strait','channel','island','islands','airport','road','street','avenue','highway','bridge','port','new','old') GROUP BY token""")
def kb_token_frequency(spark, d):
    units = _t(spark, d, "part").select(F.lit("").alias("Admin0"), F.col("p_name").alias("Admin1"), F.lit("").alias("Admin2"), F.lit("XXX").alias("Admin0_ISO3"))
    return kb.token_frequency(kb.with_keys(units), ("Admin1",))


@_query("""SELECT c_custkey, CASE WHEN count(s_suppkey) > 0 THEN string_agg(DISTINCT substr(r_name, 1, 3), ',') END AS isos FROM customer
JOIN nation n ON c_nationkey = n.n_nationkey LEFT JOIN (SELECT * FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) s ON s.n_name = n.n_name AND s.r_name = CASE WHEN c_custkey % 2 = 0 THEN (SELECT r_name FROM region WHERE r_regionkey = n.n_regionkey) ELSE 'EUROPE' END GROUP BY c_custkey""")
def kb_exact_grounding(spark, d):
    people = _t(spark, d, "customer").join(_t(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(_t(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    claimed = people.select("c_custkey", text.normalize_for_match(F.when(F.col("c_custkey") % 2 == 0, F.col("r_name")).otherwise("EUROPE")).alias("a0"), text.normalize_for_match(F.col("n_name")).alias("a1"))
    return kb.ground(claimed, kb.with_keys(_ladder_kb(spark, d)), 1, ["a0", "a1"]).select("c_custkey", F.array_join("isos", ",").alias("isos"))


@_query("""WITH c AS (SELECT c_mktsegment AS iso, n_name AS name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY iso ORDER BY n DESC, name) AS k FROM c) SELECT upper(iso) AS iso, name FROM r WHERE k = 1""")
def kb_country_names(spark, d):
    rows = _t(spark, d, "customer").join(_t(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    units = rows.select(F.col("n_name").alias("Admin0"), F.lit("").alias("Admin1"), F.lit("").alias("Admin2"), F.col("c_mktsegment").alias("Admin0_ISO3"))
    return kb.country_names(kb.with_keys(units)).select(F.col("Admin0_ISO3").alias("iso"), F.col("Admin0").alias("name"))


@_query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, len(json_keys(props)) AS n_keys FROM events""")
def json_props(spark, d):
    m = nested.load_map(F.col("props"), "bigint")
    return _t(spark, d, "events").select("event_id", F.try_element_at(m, F.lit("k")).alias("k"), F.size(m).cast("long").alias("n_keys"))


@_query("""SELECT doc_id, CASE WHEN quality = 1 THEN 'Yes' ELSE 'No' END AS relevance, CASE WHEN quality = 1 THEN CASE WHEN toxic = 1 THEN 'Yes' ELSE 'No' END END AS event FROM documents JOIN labels USING (doc_id)""")
def cascade_gate(spark, d):
    rows = _t(spark, d, "documents").join(_t(spark, d, "labels"), "doc_id").select("doc_id", F.concat(F.col("quality"), F.col("toxic")).alias("t"))

    def gate():
        import numpy as np

        return lambda texts: np.array([[float(t[0] == "1"), float(t[0] != "1")] for t in texts])

    def event():
        import numpy as np

        return lambda texts: np.array([[float(t[1] == "1"), float(t[1] != "1")] for t in texts])

    out = classify.cascade(rows, F.col("t"), gate, list(classify.BINARY_LABELS), {"event": (event, list(classify.BINARY_LABELS))}, "relevance")
    return out.select("doc_id", F.col("relevance.result").alias("relevance"), F.col("event.result").alias("event"))


@_query("""SELECT doc_id, CASE WHEN length(text) >= 5 AND lang = 'fr' THEN upper(substr(trim(regexp_replace(translate(text, chr(10) || '\\“”’', '  ""' || chr(39)), '\\s+', ' ', 'g')), 1, 800)) END AS maintext_translated FROM documents""".replace("\\\\", "\\"))
def translate_cascade_whole(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", F.lit(True).alias("include"), F.col("lang").alias("language"), F.concat(F.lit("Title "), "doc_id").alias("title"), F.col("text").alias("maintext"), *[F.lit(None).cast("string").alias(c) for c in ("title_translated", "maintext_translated", "language_translated")])
    return translate.translate_articles(docs, "fr", lambda: (lambda items: [text.upper_letters(x) for x in items], None)).select("doc_id", "maintext_translated")


@_query("""SELECT doc_id, coalesce(source, '') NOT IN ('src1', 'src2') AS outside, source IN ('src1', 'src3') AS inside, text <> '' AND source IS NOT NULL AS filled FROM documents""")
def predicates(spark, d):
    return _t(spark, d, "documents").select("doc_id", filters.not_among(F.col("source"), ["src1", "src2"]).alias("outside"), filters.among(F.col("source"), ["src1", "src3"]).alias("inside"), (filters.filled(F.col("text")) & filters.present(F.col("source"))).alias("filled"))


@_query("""SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE year(o_orderdate) END AS INTEGER) AS year, CAST(CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE month(o_orderdate) END AS INTEGER) AS month FROM orders""")
def route_by_date(spark, d):
    k = F.col("o_orderkey")
    rows = _t(spark, d, "orders").select("o_orderkey", F.when((k % 7 != 0) & (k % 2 == 0), F.col("o_orderdate")).alias("date_publish"), F.when(k % 7 == 0, "no date").when(k % 2 == 1, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date_publish_raw"))
    return tables.route_by_date(rows).select("o_orderkey", "year", "month")


@_query("""SELECT doc_id, CASE WHEN source = 'src3' AND lang = 'en' THEN 'sq' WHEN source = 'src4' AND doc_id % 2 = 0 THEN 'tr' WHEN doc_id % 2 = 0 AND source <> 'src3' THEN NULL ELSE lang END AS language FROM documents""")
def language_patches(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", F.col("source").alias("source_domain"), F.when((F.col("doc_id") % 2 == 0) & (F.col("source") != "src3"), None).otherwise(F.col("lang")).alias("language"))
    return curate.override_language(curate.fill_language(docs, "src4", "tr"), "src3", "sq").select("doc_id", "language")


@_query("""SELECT c_custkey, n_name, CASE WHEN c_custkey % 4 = 0 THEN 'new' ELSE c_mktsegment END AS segment FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def update_field(spark, d):
    rows = _t(spark, d, "customer").join(_t(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name", F.col("c_mktsegment").alias("segment"))
    new = rows.where(F.col("c_custkey") % 4 == 0).select("c_custkey", F.lit("new").alias("segment"))
    return tables.update_field(rows, new, "segment", "c_custkey")


@_query("""SELECT split_part(url, '?', 1) AS url, CAST(min(page_id) AS BIGINT) AS _id FROM pages GROUP BY 1""")
def insert_ignore(spark, d):
    pages = _t(spark, d, "pages").select(F.substring_index("url", "?", 1).alias("url"), F.col("page_id").alias("_id"))
    half = spark.read.parquet(f"{d}/pages.parquet").select(F.substring_index("url", "?", 1).alias("url"), F.col("page_id").alias("_id")).groupBy("url").agg(F.min("_id").alias("_id")).where(F.col("_id") % 2 == 0)
    return tables.insert_new(half.select("url", "_id"), pages.select("url", "_id"))


@_query("""SELECT doc_id, CASE WHEN contains(text, 'the ') THEN 'SDN=Khartoum;SSD=' || CASE WHEN contains(text, 'the of') THEN 'South Sudan,Juba' ELSE 'Juba' END ELSE 'SDN=Khartoum' END AS places FROM documents""")
def south_sudan_patch(spark, d):
    t = F.replace(F.replace(F.col("text"), F.lit("the of"), F.lit("South Sudan the of")), F.lit("the "), F.lit("Juba "))
    out = curate.south_sudan_patch(F.create_map(F.lit("SDN"), F.array(F.lit("Khartoum"))), t, F.lit(True))
    return _t(spark, d, "documents").select("doc_id", F.array_join(F.transform(F.map_entries(out), lambda e: F.concat(e["key"], F.lit("="), F.array_join(e["value"], ","))), ";").alias("places"))


@_query("""SELECT substr(s_name, 1, 3) || n_name AS geonameid, n_name AS name, r_name AS admin1_name, CAST(count(*) AS BIGINT) AS n FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 2 = 0 GROUP BY ALL
UNION ALL SELECT substr(s_name, 1, 3) || n_name, n_name, '', CAST(count(*) AS BIGINT) FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_nationkey % 2 = 1 GROUP BY ALL""")
def gazetteer_enrichment(spark, d):
    rows = _t(spark, d, "supplier").join(_t(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    blank = {c: F.lit("") for c in ("asciiname", "alternatenames", "latitude", "longitude", "feature_class", "feature_code", "admin2_code", "admin3_code", "admin4_code", "population")}
    raw = rows.select(F.concat(F.substring("s_name", 1, 3), "n_name").alias("geonameid"), F.col("n_name").alias("name"), F.lit("KE").alias("country_code"), F.when(F.col("n_nationkey") % 2 == 0, F.col("n_regionkey").cast("string")).otherwise("9").alias("admin1_code")).withColumns(blank)
    admin1 = _t(spark, d, "region").select(F.concat(F.lit("KE."), F.col("r_regionkey").cast("string")).alias("code"), F.col("r_name").alias("name"))
    out = tables.enrich_geonames(raw, admin1, spark.createDataFrame([], "code string, name string"), {"KE": "KEN"}, expand_ascii=False)
    return out.groupBy("geonameid", "name", "admin1_name").agg(F.count("*").alias("n"))


@_query("""SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, CASE WHEN o_orderpriority LIKE '1%' THEN 'other' ELSE o_orderpriority END AS via, count(*) AS n FROM orders GROUP BY ALL""")
def histogram_by_month(spark, d):
    rows = _t(spark, d, "orders").select(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"), F.when(~F.col("o_orderpriority").like("1%"), F.col("o_orderpriority")).alias("via"))
    return reports.histogram_by_month(rows, "via")


@_query("""SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS processed, count(*) FILTER (o_orderstatus = 'O') AS eligible FROM orders GROUP BY ALL""")
def eligible_by_month(spark, d):
    rows = _t(spark, d, "orders").select(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"), "o_orderstatus")
    return reports.eligible_by_month(rows, F.col("o_orderstatus") == "O")


@_query("""SELECT CAST(count(*) FILTER (doc_id % 10 <> 0 AND lang = 'fr') AS BIGINT) AS modified_count, CAST(count(*) FILTER (doc_id % 10 = 0) AS BIGINT) AS deleted_count FROM documents""")
def changed_rows(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", "lang")
    after = docs.where(F.col("doc_id") % 10 != 0).withColumn("lang", F.when(F.col("lang") == "fr", "FR").otherwise(F.col("lang")))
    return reports.changed_rows(docs, after, "doc_id", "lang")


@_query("""SELECT doc_id, substr(translate(text, chr(10) || '"“', ''), 1, 800) AS body FROM documents""")
def legacy_clean(spark, d):
    return _t(spark, d, "documents").select("doc_id", text.legacy_clean(F.col("text")).alias("body"))


@_query("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) WHEN event_id % 3 = 1 THEN event_id END AS k FROM events""")
def polymorphic_maps(spark, d):
    raw = F.when(F.col("event_id") % 3 == 0, F.col("props")).when(F.col("event_id") % 3 == 1, F.concat(F.lit("{'k': "), F.col("event_id").cast("string"), F.lit(", }"))).otherwise("neither")
    return _t(spark, d, "events").select("event_id", F.try_element_at(nested.load_map_or_literal(raw, "bigint"), F.lit("k")).alias("k"))


@_query("""SELECT o_orderkey FROM orders WHERE year(o_orderdate) * 12 + month(o_orderdate) BETWEEN 1996 * 12 + 3 AND 1998 * 12 + 11""")
def month_window(spark, d):
    rows = _t(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    return rows.where(tables.month_between((1996, 3), (1998, 11))).select("o_orderkey")


@_query("""SELECT c_custkey, n_name, CASE WHEN c_custkey % 5 = 0 THEN 'v2' ELSE 'v1' END AS version FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def upsert_by_url(spark, d):
    rows = _t(spark, d, "customer").join(_t(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").cast("string").alias("url"), F.col("c_custkey").alias("_id"), "n_name", F.lit("v1").alias("version"))
    new = rows.where(F.col("_id") % 5 == 0).withColumn("version", F.lit("v2"))
    return tables.upsert(rows, new).select(F.col("_id").alias("c_custkey"), "n_name", "version")


@_query("""SELECT s_nationkey, string_agg(s_name || '@' || CAST(s_suppkey % 4 AS VARCHAR), ',' ORDER BY s_suppkey) AS places FROM supplier GROUP BY s_nationkey""")
def places_with_coordinates(spark, d):
    rows = _t(spark, d, "supplier").groupBy("s_nationkey").agg(F.array_sort(F.collect_list(F.struct("s_suppkey", F.col("s_name").alias("name"), F.lit("KE").alias("countryCode"), (F.col("s_suppkey") % 4).cast("double").alias("lat"), F.lit(0.0).alias("lon")))).alias("m"))
    found = geo.places_by_country(F.concat("m", "m"), {"KE": "KEN"}, with_coordinates=True)
    return rows.select("s_nationkey", F.array_join(F.transform(F.element_at(found, "KEN"), lambda p: F.concat(p["name"], F.lit("@"), p["lat"].cast("int").cast("string"))), ",").alias("places"))


@_query("""SELECT page_id, CASE WHEN page_id % 2 = 0 THEN CAST(TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(page_id AS INTEGER)) AS VARCHAR) END AS published FROM pages""")
def linked_data_dates(spark, d):
    date = F.date_format(F.date_add(F.to_date(F.lit("2024-01-01")), F.col("page_id").cast("int")), "yyyy-MM-dd'T'00:00:00")
    html = F.when(F.col("page_id") % 2 == 0, F.concat("html", F.lit('<script type="application/ld+json">{"datePublished": "'), date, F.lit('Z"}</script>'))).otherwise(F.col("html"))
    return _t(spark, d, "pages").select("page_id", text.linked_data_date(html).cast("string").alias("published"))


@_query("""SELECT doc_id, CASE WHEN regexp_matches(lower(text), 'worthless|pathetic|idiot|loser') THEN 'coup' ELSE source END AS event_type FROM documents""")
def keyword_override(spark, d):
    return _t(spark, d, "documents").select("doc_id", classify.keyword_override(F.col("source"), F.col("text"), "coup", "worthless|pathetic|idiot|loser").alias("event_type"))


@_query(r"""WITH k AS (SELECT p_partkey, trim(regexp_replace(regexp_replace(lower(CASE p_partkey % 6 WHEN 0 THEN 'Gulf of ' || p_name WHEN 1 THEN p_name || ' Province' WHEN 2 THEN 'North-East' WHEN 3 THEN 'The World' WHEN 4 THEN p_name || ' Lake River' ELSE p_name || ' school' END), '[^a-z0-9_\s]', ' ', 'g'), '\s+', ' ', 'g')) AS key FROM part),
t AS (SELECT *, string_split(key, ' ') AS tok, ['gulf','sea','ocean','river','lake','bay','strait','channel','mount','mountain','valley','island','islands'] AS feat, ['north','south','east','west','central','northern','southern','eastern','western','northwest','northeast','southwest','southeast','upper','lower','mid','middle'] AS dirs, regexp_matches(key, 'province|oblast|region|district|state|department|governorate|prefecture|county|commune|municipality') AS unit FROM k)
SELECT p_partkey, key = 'the world' AS generic, len(list_filter(tok, lambda x: NOT list_contains(dirs, x))) = 0 AS directional, unit,
 NOT unit AND list_has_any(tok, feat) AND len(list_filter(tok, lambda x: NOT (list_contains(feat, x) OR list_contains(dirs, x) OR x IN ('of', 'the')))) <= 1 AS feature,
 regexp_matches(key, 'school|university|college|hospital|clinic|airport|road|street|avenue|highway|bridge|station|market|mosque|church|temple|park|reserve|forest') AS poi FROM t""")
def place_name_tests(spark, d):
    n, k = F.col("p_name"), F.col("p_partkey") % 6
    name = F.when(k == 0, F.concat(F.lit("Gulf of "), n)).when(k == 1, F.concat(n, F.lit(" Province"))).when(k == 2, "North-East").when(k == 3, "The World").when(k == 4, F.concat(n, F.lit(" Lake River"))).otherwise(F.concat(n, F.lit(" school")))
    key = F.col("key")
    rows = _t(spark, d, "part").select("p_partkey", text.normalize_for_match(name).alias("key"))
    return rows.select("p_partkey", placecolumns.is_generic(key).alias("generic"), placecolumns.is_directional(key).alias("directional"), placecolumns.is_admin_unit(key).alias("unit"), placecolumns.is_feature(key).alias("feature"), placecolumns.is_poi(key).alias("poi"))


@_query("""SELECT s_suppkey, CASE s_suppkey % 5 WHEN 0 THEN 'ADMIN0' WHEN 1 THEN 'ADMIN1' WHEN 2 THEN 'ADMIN2' WHEN 3 THEN 'UNKNOWN' ELSE 'ADMIN2' END AS level, CASE WHEN s_suppkey % 3 = 0 THEN 'Unknown' ELSE s_name END AS admin0, CASE WHEN s_suppkey % 4 = 0 THEN 'KEN' END AS iso FROM supplier""")
def sanitized_places(spark, d):
    k = F.col("s_suppkey")
    raw = F.when(k % 5 == 0, "Country").when(k % 5 == 1, "oblast").when(k % 5 == 2, " City ").when(k % 5 == 3, "galaxy").otherwise("admin2")
    rows = _t(spark, d, "supplier").select("s_suppkey", raw.alias("raw"), F.when(k % 3 == 0, "not sure").otherwise(F.concat(F.col("s_name"), F.lit(" "))).alias("a0"), F.when(k % 4 == 0, "ken").when(k % 4 == 1, "UNK").otherwise("K3N").alias("code"))
    key = lambda c: text.normalize_for_match(F.col(c))
    return rows.select("s_suppkey", placecolumns.level(F.col("raw"), key("raw")).alias("level"), placecolumns.known(F.col("a0"), key("a0")).alias("admin0"), placecolumns.iso_key(F.col("code")).alias("iso"))


@_query("""SELECT n_nationkey, lower(n_name) AS phrase, n_nationkey % 2 = 0 AS overlap FROM nation""")
def clean_phrases(spark, d):
    rows = _t(spark, d, "nation").select("n_nationkey", text.normalize_for_match(F.concat(F.lit("Republic of "), "n_name", F.lit(" Province"))).alias("key"), text.normalize_for_match(F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("Old "), "n_name")).otherwise("Republic Province")).alias("other"))
    return rows.select("n_nationkey", placecolumns.clean_phrase(F.col("key")).alias("phrase"), placecolumns.content_overlap(F.col("key"), F.col("other")).alias("overlap"))


from tidewire import catalog_corpus, catalog_places, catalog_runs, catalog_units  # noqa: E402, F401  add their queries to these
