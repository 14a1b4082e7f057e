"""A search index over the gazetteer's names: postings of names and their words, in buckets that a lookup picks.

A posting is (bucket, term, id, whole). The bucket follows from the term, so a lookup reads the files of its
terms' buckets only; they are sorted by term and have Bloom filters of it, so most row groups are skipped too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.functions.text import normalize_for_match

SCHEMA = "term string, id string, whole boolean, bucket int"


def bucket_of(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def postings(gazetteer: DataFrame, id_col: str = "geonameid", names: tuple[str, ...] = ("name",), lists: tuple[str, ...] = ("alternativenames",)) -> DataFrame:
    """(term, id, whole) of every name, and of every word of names of several words; each once an id."""
    every = F.concat(F.array(*[F.col(c) for c in names]), *[F.coalesce(F.col(c), F.array().cast("array<string>")) for c in lists])
    keys = gazetteer.select(F.col(id_col).cast("string").alias("id"), F.explode(F.array_distinct(every)).alias("name")).withColumn("key", normalize_for_match(F.col("name"))).where("key <> ''")
    words = F.filter(F.split("key", " "), lambda w: w != F.col("key"))
    terms = F.concat(F.array(F.struct(F.col("key").alias("term"), F.lit(True).alias("whole"))), F.transform(words, lambda w: F.struct(w.alias("term"), F.lit(False).alias("whole"))))
    return keys.select("id", F.explode(terms).alias("t")).groupBy("t.term", "id").agg(F.max("t.whole").alias("whole"))


def write_index(gazetteer: DataFrame, path: str, buckets: int = 64, **columns) -> None:
    """Write the postings of a gazetteer; running it again replaces them."""
    rows = postings(gazetteer, **columns).withColumn("bucket", bucket_of(F.col("term"), buckets))
    rows = rows.repartition("bucket").sortWithinPartitions("bucket", "term", "id")
    rows.write.mode("overwrite").option("parquet.bloom.filter.enabled#term", "true").partitionBy("bucket").parquet(path)


def lookup(spark: SparkSession, path: str, names: list[str], buckets: int = 64, words: bool = False) -> DataFrame:
    """(name, id, whole) of the ids that have one of a few names, or with ``words`` a name that holds one of them as a word."""
    asked = spark.createDataFrame([(n,) for n in names], "name string").withColumn("term", normalize_for_match(F.col("name"))).where("term <> ''")
    terms = asked.withColumn("bucket", bucket_of(F.col("term"), buckets)).collect()
    found = spark.read.schema(SCHEMA).parquet(path).where(F.col("bucket").isin(sorted({r["bucket"] for r in terms})) & F.col("term").isin(sorted({r["term"] for r in terms})))
    if not words:
        found = found.where("whole")
    known = spark.createDataFrame([(r["name"], r["term"]) for r in terms], "name string, term string")
    return found.join(known, "term").select("name", "id", "whole")


def match_names(queries: DataFrame, path: str, key: str = "key") -> DataFrame:
    """``queries`` joined with the ids that have their normalized name ``key``: many lookups at once, by the term."""
    index = queries.sparkSession.read.schema(SCHEMA).parquet(path).where("whole").select(F.col("term").alias(key), "id")
    return queries.join(index, key)
