"""Readers and writers of the corpus tables and files."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.functions.text import publish_date, strip_accents
from tidewire.operators.geo import iso3
from tidewire.schemas import GEONAMES, KB, schema


def read_articles(spark: SparkSession, path: str, first: tuple[int, int] | None = None, last: tuple[int, int] | None = None, undated: bool = False) -> DataFrame:
    """Articles from month ``first`` to month ``last`` (inclusive); the bounds prune partitions."""
    df = spark.read.parquet(path)
    keep = month_between(first, last)
    return df.where(keep | F.col("year").isNull()) if undated else df.where(keep)


def month_between(first: tuple[int, int] | None, last: tuple[int, int] | None) -> Column:
    keep = F.col("year").isNotNull()
    if first:
        keep = keep & ((F.col("year") > first[0]) | (F.col("year") == first[0]) & (F.col("month") >= first[1]))
    if last:
        keep = keep & ((F.col("year") < last[0]) | (F.col("year") == last[0]) & (F.col("month") <= last[1]))
    return keep


def route_by_date(df: DataFrame, raw: str | None = "date_publish_raw") -> DataFrame:
    """Year and month of the publishing date, or of its text form; null without either."""
    date = F.col("date_publish") if raw is None else F.coalesce("date_publish", publish_date(F.col(raw)))
    return df.withColumns({"year": F.year(date), "month": F.month(date)})


def write_articles(df: DataFrame, path: str, mode: str = "overwrite", index_by: tuple[str, ...] = ("url",)) -> None:
    """Write by month; overwriting replaces only the months that ``df`` holds.

    Files are sorted by the columns of ``index_by`` and hold Bloom filters of them, by which lookups
    skip most files and row groups.
    """
    keys = [c for c in index_by if c in df.columns]
    rows = df.repartition("year", "month", F.pmod(F.xxhash64("_id"), F.lit(16))).sortWithinPartitions("year", "month", *keys)
    writer = rows.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("year", "month")
    for c in keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    writer.parquet(path)


def tweets_between(tweets: DataFrame, first: str, last: str, language: str | None = None) -> DataFrame:
    """Tweets of the days from ``first`` to ``last``, of one language if given; day and language prune partitions."""
    keep = F.col("date").between(F.to_date(F.lit(first)), F.to_date(F.lit(last)))
    return tweets.where(keep if language is None else keep & (F.col("language") == language))


def update_field(articles: DataFrame, results: DataFrame, field: str, key: str = "_id") -> DataFrame:
    """Set one field of the rows that ``results`` (key, field) names; one result a key."""
    new = results.select(F.col(key).alias("__key"), F.struct(F.col(field)).alias("__new"))
    joined = articles.join(new, articles[key] == new["__key"], "left")
    value = F.when(F.col("__new").isNotNull(), F.col(f"__new.{field}"))
    return joined.withColumn(field, value.otherwise(articles[field]) if field in articles.columns else value).drop("__key", "__new")


def insert_new(existing: DataFrame, new: DataFrame, key: str = "url") -> DataFrame:
    """New rows with unseen keys, one a key (smallest _id); existing ones stay."""
    first = new.groupBy(key).agg(F.min("_id").alias("__id"))
    fresh = new.join(first, (new[key] == first[key]) & (new["_id"] == first["__id"]), "left_semi")
    return existing.unionByName(fresh.join(existing.select(key), key, "left_anti"), allowMissingColumns=True)


def upsert(existing: DataFrame, new: DataFrame, key: str = "url") -> DataFrame:
    """New rows replace existing ones of their key; of several, the largest _id stays."""
    last = new.groupBy(key).agg(F.max("_id").alias("__id"))
    fresh = new.join(last, (new[key] == last[key]) & (new["_id"] == last["__id"]), "left_semi")
    return existing.join(fresh.select(key), key, "left_anti").unionByName(fresh, allowMissingColumns=True)


def download_pages(df: DataFrame, fetch: Callable[[str], str | None], parse: Callable[[str, str], dict], via: str | None = None, url_col: str = "url") -> DataFrame:
    """Fetch and parse urls with injected functions: url, title, maintext, html, date_download, download_via and error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for url in pdf[url_col]:
                try:
                    html = fetch(url)
                    row = parse(url, html) if html else {}
                    out.append((url, row.get("title"), row.get("maintext"), html, None))
                except Exception as e:  # noqa: BLE001  the error is the row's result
                    out.append((url, None, None, None, repr(e)))
            yield pd.DataFrame(out, columns=["url", "title", "maintext", "html", "error"])

    got = df.select(url_col).mapInPandas(run, "url string, title string, maintext string, html string, error string")
    return got.withColumns({"date_download": F.current_timestamp(), "download_via": F.lit(via).cast("string")})


def errors_of(df: DataFrame, column: str = "error") -> DataFrame:
    return df.where(F.col(column).isNotNull())


def write_tweets(df: DataFrame, path: str) -> None:
    """CSV by language, year and month; quotes inside texts are doubled, as other readers expect, and blanks at their ends stay."""
    df.withColumns({"year": F.year("date"), "month": F.month("date")}).write.mode("overwrite").partitionBy("language", "year", "month").csv(path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def read_tweets(spark: SparkSession, path: str) -> DataFrame:
    """What ``write_tweets`` wrote, line ends and quotes inside texts included."""
    columns = "_id string, date date, text string, language string, year int, month int"
    return spark.read.csv(path, header=True, multiLine=True, escape='"', schema=columns, enforceSchema=False)


def read_kb(spark: SparkSession, path: str) -> DataFrame:
    """Administrative units from CSV: blanks for missing names, upper-case codes; an error where a column is missing."""
    df = spark.read.csv(path, header=True)
    missing = [c for c in schema(KB).names if c not in df.columns]
    if missing:
        raise ValueError(f"knowledge base lacks {missing}")
    return df.na.fill("").withColumn("Admin0_ISO3", F.upper("Admin0_ISO3"))


def read_codes(spark: SparkSession, path: str) -> DataFrame:
    """Code and name of administrative units; of repeated codes the last row stays."""
    rows = spark.read.csv(path, sep="\t", schema="code string, name string").withColumn("at", F.monotonically_increasing_id())
    return rows.groupBy("code").agg(F.max_by("name", "at").alias("name"))


def read_geonames(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema=GEONAMES, quote='"')


def enrich_geonames(raw: DataFrame, admin1: DataFrame, admin2: DataFrame, codes: dict[str, str], expand_ascii: bool = True) -> DataFrame:
    """The gazetteer: alternative names with and without accents, names of units, coordinates, country code.

    The code tables join by key; Spark broadcasts them when their measured size allows it.
    """
    #: Additional names of two countries, by id. Fixed values.
    more = F.when(F.col("geonameid") == "6252001", F.array(F.lit("US"), F.lit("U.S."))).when(F.col("geonameid") == "239880", F.array(F.lit("C.A.R."))).otherwise(F.array().cast("array<string>"))
    names = F.concat(F.array_distinct(F.split(F.coalesce("alternatenames", F.lit("")), ",")), more)
    plain = F.split(strip_accents(F.array_join(names, "\u0001")), "\u0001")
    k1 = F.when(F.coalesce("admin1_code", F.lit("")) != "", F.concat_ws(".", "country_code", "admin1_code"))
    k2 = F.when(F.coalesce("admin2_code", F.lit("")) != "", F.concat_ws(".", "country_code", "admin1_code", "admin2_code"))
    a1, a2 = admin1.select(F.col("code").alias("__c1"), F.col("name").alias("admin1_name")), admin2.select(F.col("code").alias("__c2"), F.col("name").alias("admin2_name"))
    joined = raw.withColumns({"__k1": k1, "__k2": k2}).join(a1, F.col("__k1") == F.col("__c1"), "left").join(a2, F.col("__k2") == F.col("__c2"), "left")
    return joined.select(
        "geonameid", "name", "asciiname", (F.array_union(names, plain) if expand_ascii else names).alias("alternativenames"), F.concat_ws(",", "latitude", "longitude").alias("coordinates"), "feature_class", "feature_code",
        iso3(F.col("country_code"), codes, "NA").alias("country_code3"), "admin1_code", F.coalesce("admin1_name", F.lit("")).alias("admin1_name"), "admin2_code", F.coalesce("admin2_name", F.lit("")).alias("admin2_name"),
        "admin3_code", "admin4_code", "population", F.size(names).alias("alt_name_length"), F.date_format(F.current_date(), "yyyy-MM-dd").alias("modification_date"),
    )


def write_gazetteer(df: DataFrame, path: str) -> None:
    """One row an id, clustered by country for later lookups."""
    df.dropDuplicates(["geonameid"]).repartition("country_code3", F.pmod(F.xxhash64("geonameid"), F.lit(8))).write.mode("overwrite").parquet(path)
