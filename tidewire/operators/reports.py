"""Counts and histograms over the corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def monthly_counts(df: DataFrame, date_col: str, include: Column) -> DataFrame:
    """Rows, included rows and their running totals by month.

    Months between the first and the last one without rows count zero. The window runs over one
    row a month, after the aggregation, so it needs no partitioning.
    """
    by_month = df.where(F.col(date_col).isNotNull()).groupBy(F.year(date_col).alias("year"), F.month(date_col).alias("month")).agg(
        F.count("*").alias("n"), F.count_if(include).alias("n_include")
    )
    span = by_month.agg(F.min(F.col("year") * 12 + F.col("month") - 1).alias("lo"), F.max(F.col("year") * 12 + F.col("month") - 1).alias("hi"))
    months = span.select(F.explode(F.sequence("lo", "hi")).alias("ym")).select((F.floor(F.col("ym") / 12)).cast("int").alias("year"), (F.col("ym") % 12 + 1).cast("int").alias("month"))
    full = months.join(by_month, ["year", "month"], "left").na.fill(0, ["n", "n_include"])
    w = Window.orderBy("year", "month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return full.select("year", "month", "n", "n_include", F.sum("n").over(w).alias("n_running"), F.sum("n_include").over(w).alias("n_include_running"))


def language_histogram(df: DataFrame, by: str = "language") -> DataFrame:
    """Rows by language; ``n_reference`` is one less, as older reports counted."""
    return df.groupBy(by).agg(F.count("*").alias("n"), (F.count("*") - 1).alias("n_reference"))


def month_range(spark, start: str, end: str) -> DataFrame:
    """Month ends from ``start`` on, the last one not after ``end``."""
    days = spark.range(1).select(F.explode(F.sequence(F.trunc(F.to_date(F.lit(start)), "month"), F.to_date(F.lit(end)), F.expr("interval 1 month"))).alias("m"))
    return days.select(F.last_day("m").alias("month_end")).where(F.col("month_end") <= F.to_date(F.lit(end)))


def months_until(spark, start: str, now: str, ahead_days: int | None = None) -> DataFrame:
    """Month ends from ``start`` until a month after ``now``, or until ``ahead_days`` days after it."""
    end = F.add_months(F.to_date(F.lit(now)), 1) if ahead_days is None else F.date_add(F.to_date(F.lit(now)), ahead_days)
    months = spark.range(1).select(F.explode(F.sequence(F.trunc(F.to_date(F.lit(start)), "month"), end, F.expr("interval 1 month"))).alias("m"), end.alias("end"))
    return months.select(F.last_day("m").alias("month_end"), "end").where(F.col("month_end") <= F.col("end")).drop("end")


def eligible_by_month(df: DataFrame, predicate: Column) -> DataFrame:
    return df.groupBy("year", "month").agg(F.count("*").alias("processed"), F.count_if(predicate).alias("eligible"))


def histogram_by_month(df: DataFrame, by: str, missing: str = "other") -> DataFrame:
    """Rows by month and value; null values count as ``missing``."""
    return df.groupBy("year", "month", F.coalesce(by, F.lit(missing)).alias(by)).agg(F.count("*").alias("n"))


def changed_rows(before: DataFrame, after: DataFrame, key: str, column: str) -> DataFrame:
    """One row: how many rows an update changed, and how many it removed."""
    b, a = before.select(F.col(key).alias("k"), F.col(column).alias("was")), after.select(F.col(key).alias("k2"), F.col(column).alias("now"))
    joined = b.join(a, F.col("k") == F.col("k2"), "left")
    return joined.agg(F.count_if(F.col("k2").isNotNull() & ~F.col("was").eqNullSafe(F.col("now"))).alias("modified_count"), F.count_if(F.col("k2").isNull()).alias("deleted_count"))
