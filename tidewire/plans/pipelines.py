"""Whole runs over the corpus, each one plan of the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.functions.text import build_combined, final_text
from tidewire.operators import classify, curate, filters, geo, grounding, unit_search
from tidewire.sources.tables import route_by_date


def curate_articles(articles: DataFrame, sources: DataFrame) -> dict[str, DataFrame]:
    """Blacklist, deduplicate, date and pass English through: ``articles``, ``duplicates`` and ``blacklisted``."""
    marked = filters.blacklist_split(articles, sources)
    kept, gone = curate.split_duplicates(marked.where(~F.col("blacklisted")).drop("blacklisted"), ["source_domain", "title"])
    return {"articles": curate.english_passthrough(route_by_date(kept)), "duplicates": gone, "blacklisted": marked.where("blacklisted").drop("blacklisted")}


def classify_environment(articles: DataFrame, domains: DataFrame, models: DataFrame, binary: Callable, events: Callable) -> DataFrame:
    """Relevance first, then the event model with its second label, for eligible articles."""
    due = filters.from_sources(articles, domains).where(filters.classifiable("environmental_binary"))
    text = build_combined(F.col("title_translated"), F.col("maintext_translated"))
    labels, event_labels = classify.model_labels(models, "env_binary"), classify.model_labels(models, "env_classifier")
    out = classify.cascade(due, text, binary, labels, {}, "environmental_binary")
    passes = F.col("environmental_binary.result") == "Yes"
    out = classify.score(out, F.when(passes, text), classify._skipping(events, len(event_labels)), "__x")
    return out.withColumn("env_classifier", F.when(passes, classify.top_two(F.col("__x"), event_labels))).drop("__x")


def geoparse_articles(articles: DataFrame, domains: DataFrame, parser: Callable, codes: dict[str, str], south_sudan: DataFrame | None = None) -> DataFrame:
    """Places by country with the name patches; South Sudan's only for the domains of ``south_sudan``."""
    due = filters.from_sources(articles, domains).where(F.col("include") & (F.col("language_translated") == "en") & F.col("cliff_locations").isNull())
    title, body = F.col("title_translated"), F.col("maintext_translated")
    text = final_text(title, body)
    out = geo.geoparse(due, text, parser).withColumn("cliff_locations", geo.places_by_country(F.col("geoparsed.mentions"), codes)).drop("geoparsed")
    if south_sudan is not None:
        marked = south_sudan.select(F.col("source_domain").alias("__d")).distinct()
        out = out.join(marked, out["source_domain"] == marked["__d"], "left")
        out = out.withColumn("cliff_locations", curate.south_sudan_patch(F.col("cliff_locations"), text, F.col("__d").isNotNull())).drop("__d")
    patched = curate.gaza_patch(F.col("cliff_locations"), title, body)
    return out.withColumn("cliff_locations", patched).withColumn("cliff_locations", curate.west_africa_patch(F.col("cliff_locations"), title, body))


def reconcile_corpus(articles: DataFrame, kb: DataFrame, force: bool = False, threshold: float = grounding.MATCH) -> DataFrame:
    return unit_search.reconcile_articles(articles.where(filters.for_reconciling(force)), kb, threshold)
