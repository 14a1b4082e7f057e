"""The plans that the operators must get: pruned scans, semi joins, no windows over hot keys."""

from pyspark.sql import functions as F

from tidewire.functions import text
from tidewire.operators import curate, filters, kb, reports
from tidewire.sources import tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_months_and_columns_are_pruned(spark, tmp_path):
    rows = spark.range(100).select(F.col("id").cast("string").alias("_id"), F.lit("t").alias("title"), F.lit("m").alias("maintext"), (2019 + F.col("id") % 3).cast("int").alias("year"), (1 + F.col("id") % 12).cast("int").alias("month"))
    tables.write_articles(rows, f"{tmp_path}/a")
    got = plan(tables.read_articles(spark, f"{tmp_path}/a", first=(2020, 3), last=(2020, 9)).where(F.col("title") == "t").select("_id"))
    scan = got[got.index("FileScan"):]
    assert "PartitionFilters: [isnotnull(year" in scan and "maintext" not in scan and "EqualTo(title,t)" in scan


def test_sources_are_a_semi_join(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumnRenamed("source", "source_domain")
    sources = docs.select("source_domain", F.lit(True).alias("include"), F.array(F.lit("KEN")).alias("primary_location"), F.lit(None).cast("boolean").alias("major_international"), F.lit(None).cast("boolean").alias("major_regional"))
    got = plan(filters.from_sources(docs, filters.eligible_sources(sources, ["KEN"])).select("doc_id"))
    assert "LeftSemi" in got and "CartesianProduct" not in got and "text" not in got.split("ReadSchema")[1].split("\n")[0]


def test_duplicates_need_no_window(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = plan(curate.split_duplicates(docs, ["source", "text"], "doc_id")[0])
    assert "Window" not in got and "partial_min" in got


def test_counts_combine_before_the_shuffle(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert "partial_count" in plan(reports.language_histogram(docs, "lang"))
    units = docs.select(F.col("lang").alias("Admin0"), F.lit("").alias("Admin1"), F.lit("").alias("Admin2"), F.lit("XXX").alias("Admin0_ISO3"))
    assert "partial_collect_set" in plan(kb.membership(kb.with_keys(units), 0))


def test_text_functions_stay_in_the_jvm(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = plan(docs.select(text.cut_dateline(F.col("text")), text.clean_text(F.col("text")), text.final_text(F.col("lang"), F.col("text")), text.strip_blocks(F.col("text")), text.build_combined(F.col("lang"), F.col("text"))))
    assert "Python" not in got and "Exchange" not in got
