"""Incremental runs: new article files go through the same batch functions.

The corpus has no streaming operators of its own; this is an extension. Each micro-batch is written
under its number, so that a repeated batch replaces itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidewire.schemas import ARTICLES, schema


def process_new_articles(spark: SparkSession, source: str, target: str, checkpoint: str, work: Callable[[DataFrame], DataFrame], articles: str = ARTICLES, files_per_batch: int = 100) -> StreamingQuery:
    """Apply ``work`` to the article files that arrived since the last run, then stop."""
    new = spark.readStream.schema(schema(articles)).option("maxFilesPerTrigger", files_per_batch).parquet(source)

    def write(batch: DataFrame, number: int) -> None:
        work(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return new.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def unprocessed(articles: DataFrame, results: DataFrame, key: str = "_id") -> DataFrame:
    """Articles without a result: resume by anti join instead of by missing fields."""
    return articles.join(results.select(key), key, "left_anti")
