"""Queries of bulk updates, the search index, resumable runs, fields without a type and free-form dates.

Those that write files use a new folder of the shared one at every call and read it back; they have no SQL.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidewire.catalog import _query, _t
from tidewire.functions import dates, variant
from tidewire.functions.text import normalize_for_match
from tidewire.plans import ledger
from tidewire.plans.staging import shared_folder
from tidewire.schemas import GEONAMES
from tidewire.sources import merge, search_index, tables


def _folder(spark, label):
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


@_query()
def merged_sales(spark, d):
    """Sales by month, of which those with a returned line of February or March are marked so: only their months are written again."""
    sales = _t(spark, d, "sales").select("sale_id", "status", "total", "sold_at").withColumns({"year": F.year("sold_at"), "month": F.month("sold_at")})
    path = _folder(spark, "sales")
    sales.write.partitionBy("year", "month").parquet(path)
    lines = _t(spark, d, "sale_lines").where(F.col("shipped_at").between("2024-02-01", "2024-03-31") & (F.col("flag") == "R"))
    back = lines.groupBy("sale_id").agg(F.round(F.sum("amount"), 2).alias("total")).withColumn("status", F.lit("returned"))
    in_time = sales.where("year = 2024 AND month IN (2, 3)").select("sale_id", "year", "month").distinct()
    merge.merge_changes(spark, path, back.join(in_time, "sale_id"), "returns", key="sale_id")
    return spark.read.parquet(path).select("sale_id", "status", "total", "year", "month")


@_query()
def indexed_names(spark, d):
    """For each client that is a copy, the clients that are not and have its very name, through the search index."""
    clients = _t(spark, d, "clients").where("name IS NOT NULL")
    path = _folder(spark, "names")
    search_index.write_index(clients.where("client_id = master_id").select("client_id", "name"), path, id_col="client_id", lists=())
    asked = clients.where("client_id <> master_id").select("client_id", normalize_for_match(F.col("name")).alias("key"))
    return search_index.match_names(asked, path).select("client_id", "key", F.col("id").cast("bigint").alias("master"))


@_query()
def resumed_runs(spark, d):
    """Sales of each month in four chunks, through two runs: the first ends after three chunks, the second does the rest."""
    sales = _t(spark, d, "sales").where("sold_at IS NOT NULL").withColumns({"of": F.date_format("sold_at", "yyyy-MM"), "chunk": ledger.chunk_of(F.col("sale_id"), 4)})
    path = _folder(spark, "runs")
    months = [r[0] for r in sales.select("of").distinct().orderBy("of").collect()]
    ticks = iter(range(10**6))
    work = lambda month, chunk: sales.where((F.col("of") == month) & (F.col("chunk") == chunk)).select("sale_id", (F.col("total") > 100).alias("large"))
    ledger.run_chunks(spark, path, months, 4, work, stop=3, now=lambda: next(ticks))
    ledger.run_chunks(spark, path, months, 4, work)
    return ledger.read_chunks(spark, path).select("sale_id", "large", "of_month")


@_query()
def months_read(spark, d):
    """Sales written as articles by month, of which the months from February 2024 on are read; months without any are skipped."""
    sales = _t(spark, d, "sales").select(F.col("sale_id").alias("_id"), F.concat(F.lit("http://shop.example/"), "sale_id").alias("url"), F.col("sold_at").alias("date_publish"))
    path = _folder(spark, "articles")
    tables.write_articles(tables.route_by_date(sales, raw=None), path)
    return tables.read_articles(spark, path, first=(2024, 2), last=(2031, 12)).select(F.col("_id").alias("sale_id"), "year", "month")


@_query()
def tweet_files(spark, d):
    """Time stamps as tweets: written as CSV by language and month, one language read back."""
    day = F.to_date(dates.parse_date(F.col("raw")))
    rows = _t(spark, d, "stamps").select(F.col("stamp_id").cast("string").alias("_id"), day.alias("date"), F.substring("zone", 1, 2).alias("language"), F.concat(F.lit('a "quoted", text\n'), F.coalesce("raw", F.lit(""))).alias("text")).where("date IS NOT NULL AND language IS NOT NULL")
    path = _folder(spark, "tweets")
    tables.write_tweets(rows, path)
    back = tables.read_tweets(spark, path)
    return back.where("language = 'Am'").select(F.col("_id").cast("bigint").alias("stamp_id"), "date", "year", "month", F.length("text").alias("n_chars"))


@_query()
def gazetteer_files(spark, d):
    """Vendors as a gazetteer's text files: read, enriched with the names of their units, written by country and read back."""
    vendors = _t(spark, d, "vendors").where("vendor_id IS NOT NULL")
    path = _folder(spark, "gazetteer")
    fields = [f.split()[0] for f in GEONAMES.split(", ")]
    known = {"geonameid": F.col("vendor_id").cast("string"), "name": F.col("name"), "alternatenames": F.concat_ws(",", "name", F.upper("name")), "latitude": F.lit("1.5"), "longitude": F.lit("2.5"), "country_code": F.lit("KE"), "admin1_code": F.col("nation_id").cast("string")}
    vendors.select(*[known.get(c, F.lit(None).cast("string")).alias(c) for c in fields]).write.csv(f"{path}/all", sep="\t")
    nation = _t(spark, d, "nation")
    nation.select(F.concat(F.lit("KE."), F.col("n_nationkey").cast("string")), "n_name").write.csv(f"{path}/codes", sep="\t")
    codes = tables.read_codes(spark, f"{path}/codes")
    rich = tables.enrich_geonames(tables.read_geonames(spark, f"{path}/all"), codes, codes.limit(0), {"KE": "KEN"})
    tables.write_gazetteer(rich, f"{path}/out")
    back = spark.read.parquet(f"{path}/out")
    return back.select(F.col("geonameid").cast("bigint").alias("vendor_id"), "name", "coordinates", "country_code3", "admin1_name", F.size("alternativenames").alias("n_names"))


_KIND = lambda path: f"CASE json_type(j, '{path}') WHEN 'NULL' THEN 'null' WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'bool' WHEN 'ARRAY' THEN 'array' WHEN 'OBJECT' THEN 'object' ELSE CASE WHEN json_type(j, '{path}') IS NULL THEN 'missing' ELSE 'number' END END"


@_query(f"""WITH p AS (SELECT click_id, props, CASE WHEN json_valid(props) THEN CAST(props AS JSON) END AS j FROM clicks)
SELECT click_id, j IS NOT NULL AS parsed, {_KIND('$.k')} AS k_kind, {_KIND('$.tags')} AS tags_kind, {_KIND('$.device.os')} AS os_kind, {_KIND('$.items[0].qty')} AS qty_kind,
  CASE json_type(j, '$.k') WHEN 'VARCHAR' THEN CASE WHEN regexp_full_match(j->>'$.k', '\\s*[+-]?\\d{{1,18}}\\s*') THEN CAST(trim(j->>'$.k') AS BIGINT) END WHEN 'UBIGINT' THEN CAST(j->>'$.k' AS BIGINT) WHEN 'BIGINT' THEN CAST(j->>'$.k' AS BIGINT) END AS k, j->>'$.device.os' AS os
FROM p WHERE json_type(j, '$.k') IN ('VARCHAR', 'UBIGINT', 'BIGINT') OR json_type(j, '$.tags') IN ('ARRAY', 'NULL') OR j IS NULL""")
def typed_fields(spark, d):
    """Clicks whose ``k`` is a number or text, whose tags are a list or null, or that have no properties: kinds and values of fields."""
    rows = _t(spark, d, "clicks").select("click_id", variant.parse(F.col("props")).alias("v"))
    v = F.col("v")
    keep = variant.is_kind(v, "$.k", "string", "number") | variant.is_kind(v, "$.tags", "array", "null") | v.isNull()
    kind = lambda path, name: variant.kind_of(v, path).alias(name)
    return rows.where(keep).select("click_id", v.isNotNull().alias("parsed"), kind("$.k", "k_kind"), kind("$.tags", "tags_kind"), kind("$.device.os", "os_kind"), kind("$.items[0].qty", "qty_kind"), variant.as_long(v, "$.k").alias("k"), variant.as_text(v, "$.device.os").alias("os"))


@_query(r"""WITH s AS (SELECT stamp_id, source, lower(trim(raw)) AS r FROM stamps),
p AS (SELECT *, CASE WHEN regexp_full_match(r, '\d{4}-\d{2}-\d{2}[ t]\d{2}:\d{2}:\d{2}z?|\d{8}|\d{2}\.\d{2}\.\d{4} \d{2}:\d{2}:\d{2}|\d{2} [a-z]{3} \d{4} \d{2}:\d{2}|\d{2}/\d{2}/\d{4} \d{2}:\d{2}( [ap]m)?')
  THEN try_strptime(r, ['%Y-%m-%d %H:%M:%S', '%Y-%m-%dt%H:%M:%Sz', '%Y%m%d', '%d.%m.%Y %H:%M:%S', '%d %b %Y %H:%M', '%m/%d/%Y %H:%M', '%d/%m/%Y %H:%M', '%m/%d/%Y %I:%M %p', '%d/%m/%Y %I:%M %p']) END AS found FROM s),
o AS (SELECT *, regexp_extract(r, '^(\d{4}-\d{2}-\d{2}t\d{2}:\d{2}:\d{2})([+-])(\d{2}):?(\d{2})$', ['t', 's', 'h', 'm']) AS z FROM p)
SELECT stamp_id, CAST(CASE WHEN regexp_full_match(r, '\d{10}') THEN make_timestamp(TRY_CAST(r AS BIGINT) * 1000000) WHEN regexp_full_match(r, '\d{13}') THEN make_timestamp(TRY_CAST(r AS BIGINT) * 1000)
  WHEN z.t <> '' THEN try_strptime(z.t, '%Y-%m-%dt%H:%M:%S') - to_minutes(CASE z.s WHEN '-' THEN -1 ELSE 1 END * (60 * TRY_CAST(z.h AS INTEGER) + TRY_CAST(z.m AS INTEGER)))
  WHEN regexp_full_match(r, '\d{4}-\d{2}') THEN try_strptime(r || '-01', '%Y-%m-%d') WHEN regexp_full_match(r, '\d{2} [a-z]{3}') THEN try_strptime(r || ' 1970', '%d %b %Y') ELSE found END AS TIMESTAMP) AS moment FROM o""")
def stamped_at(spark, d):
    """The moment of every time stamp, whatever its source writes; the month comes first where a stamp leaves it open."""
    return _t(spark, d, "stamps").select("stamp_id", dates.parse_date(F.col("raw")).alias("moment"))
