"""Deduplication, flags, dates, language fixes and patches of located places."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.functions import nested
from tidewire.operators.filters import mentions

NAMES = "array<string>"


def split_duplicates(df: DataFrame, keys: list[str], order: str = "_id") -> tuple[DataFrame, DataFrame]:
    """The first row of every key by ``order``, and the other rows as tombstones.

    The survivors come from one aggregation that combines before its shuffle, so a key with very
    many rows is no burden; ``order`` must be unique. Rows with a null key are all kept.
    """
    no_null = F.lit(True)
    for k in keys:
        no_null = no_null & F.col(k).isNotNull()
    first = df.where(no_null).groupBy(*keys).agg(F.min(order).alias("__first")).select("__first")
    marked = df.withColumn("__whole", no_null).join(first, F.col(order) == F.col("__first"), "left")
    keep = F.col("__first").isNotNull() | ~F.col("__whole")
    return marked.where(keep).drop("__first", "__whole"), marked.where(~keep).drop("__first", "__whole")


def set_include(df: DataFrame, domains: list[str]) -> DataFrame:
    return df.withColumn("include", F.when(F.col("source_domain").isin(domains), F.lit(True)).otherwise(F.col("include")))


def derive_month(df: DataFrame, domains: list[str] | None = None) -> DataFrame:
    """Year and month of included articles with a real date that lack a month."""
    due = F.coalesce("include", F.lit(False)) & F.col("date_publish").isNotNull() & F.col("month").isNull()
    if domains is not None:
        due = due & F.col("source_domain").isin(domains)
    return df.withColumns({"year": F.when(due, F.year("date_publish")).otherwise(F.col("year")), "month": F.when(due, F.month("date_publish")).otherwise(F.col("month"))})


def fill_language(df: DataFrame, domain: str, language: str) -> DataFrame:
    due = (F.col("source_domain") == domain) & F.col("language").isNull()
    return df.withColumn("language", F.when(due, language).otherwise(F.col("language")))


def override_language(df: DataFrame, domain: str, language: str, was: str = "en", included_only: bool = False) -> DataFrame:
    due = (F.col("source_domain") == domain) & (F.col("language") == was)
    if included_only:
        due = due & F.coalesce("include", F.lit(False))
    return df.withColumn("language", F.when(due, language).otherwise(F.col("language")))


def english_passthrough(df: DataFrame) -> DataFrame:
    """English articles are their own translation; those that lack title or text are left alone."""
    due = F.coalesce("include", F.lit(False)) & (F.col("language") == "en") & F.col("language_translated").isNull() & F.col("title").isNotNull() & F.col("maintext").isNotNull()
    pick = lambda new, old: F.when(due, new).otherwise(F.col(old))
    return df.withColumns({"language_translated": pick(F.lit("en"), "language_translated"), "title_translated": pick(F.col("title"), "title_translated"), "maintext_translated": pick(F.col("maintext"), "maintext_translated")})


def gaza_patch(locations: Column, *texts: Column) -> Column:
    """Texts that name it set the key PSE to Gaza."""
    return F.when(mentions("Ghaza([^A-Za-z]|$)", *texts), nested.upsert_key(locations, "PSE", F.array(F.lit("Gaza")).cast(NAMES))).otherwise(locations)


def west_africa_patch(locations: Column, *texts: Column) -> Column:
    """Angola found only as its full name, in texts about West Africa that don't name Angola, moves to the key None."""
    lone = F.coalesce(F.try_element_at(locations, F.lit("AGO")) == F.array(F.lit("Republic of Angola")), F.lit(False))
    due = lone & mentions("West Africa([^A-Za-z]|$)", *texts, ignore_case=True) & ~mentions("Angola", *texts, ignore_case=True)
    old = F.coalesce(F.try_element_at(locations, F.lit("None")), F.array().cast(NAMES))
    moved = nested.upsert_key(F.map_filter(locations, lambda k, _: k != "AGO"), "None", F.array_union(old, F.array(F.lit("West Africa"))))
    return F.when(due, moved).otherwise(locations)


def south_sudan_patch(locations: Column, text: Column, applies: Column) -> Column:
    """Add South Sudan by name, and Juba where Sudan was found, unless SSD is already there; a null map stays null."""
    has = lambda k: F.coalesce(F.array_contains(F.map_keys(locations), k), F.lit(False))
    found = F.array_compact(F.array(F.when(F.contains(text, F.lit("South Sudan")), "South Sudan"), F.when(F.contains(text, F.lit("Juba")) & has("SDN"), "Juba")))
    due = locations.isNotNull() & applies & ~has("SSD") & (F.size(found) > 0)
    return F.when(due, F.map_concat(locations, F.create_map(F.lit("SSD"), found))).otherwise(locations)


def repair_cutoff(event: Column, cutoffs: Column) -> Column:
    """Set the event type to -999 where the best score misses its cutoff, else leave it."""
    best = nested.map_argmax(event["model_outputs"])
    cut = F.coalesce(F.try_element_at(cutoffs, best), F.lit(float("inf")))
    low = F.array_max(F.map_values(event["model_outputs"])) < cut
    return F.when(low, F.struct(F.lit("-999").alias("event_type"), event["model_outputs"].alias("model_outputs"))).otherwise(event)


def repair_label(df: DataFrame, label: str = "coup", source: str = "civic_new", target: str = "civic") -> DataFrame:
    """Where ``source`` has the label, write the best label of its scores into ``target``."""
    due = F.col(f"{source}.event_type") == label
    return df.withColumn(target, F.when(due, F.struct(nested.map_argmax(F.col(f"{source}.model_outputs")).alias("event_type"))).otherwise(F.col(target)))
