"""Predicates over articles. Absent and null fields are one; the guards say what each admits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def present(c: Column) -> Column:
    """Not null; empty strings pass."""
    return c.isNotNull()


def filled(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def among(c: Column, values: list) -> Column:
    return F.coalesce(c.isin([v for v in values if v is not None]), F.lit(False))


def not_among(c: Column, values: list) -> Column:
    """Negative membership: a list that holds None rejects missing fields, one that doesn't admits them."""
    known = [v for v in values if v is not None]
    return (c.isNotNull() & ~c.isin(known)) if None in values else (c.isNull() | ~c.isin(known))


def both_missing(*conditions: Column) -> Column:
    """Joint denial; a null operand counts as false, so missing fields pass."""
    out = F.lit(True)
    for c in conditions:
        out = out & ~F.coalesce(c, F.lit(False))
    return out


def mentions(pattern: str, *texts: Column, ignore_case: bool = False) -> Column:
    out = F.lit(False)
    for t in texts:
        out = out | F.coalesce(t.rlike(("(?i)" if ignore_case else "") + pattern), F.lit(False))
    return out


def same_array(c: Column, values: list) -> Column:
    return F.coalesce(c == F.array(*map(F.lit, values)), F.lit(False))


def spot(df: DataFrame, domains: list[str] | None = None, not_languages: list[str] | None = None, columns: tuple[str, ...] = (), limit: int | None = None) -> DataFrame:
    """Articles of some domains and none of some languages, of which only ``columns`` are read, at most ``limit`` if given."""
    keep = F.lit(True)
    if domains is not None:
        keep = keep & among(F.col("source_domain"), domains)
    if not_languages is not None:
        keep = keep & not_among(F.col("language"), not_languages)
    out = df.where(keep)
    out = out.select(*columns) if columns else out
    return out if limit is None else out.limit(limit)


def long_enough(title: Column, body: Column, least_title: int = 3, least_body: int = 5) -> Column:
    return (F.length(title) >= least_title) & (F.length(body) >= least_body)


def untranslated(language: str) -> Column:
    """Included articles of a language with text, of which either translation is absent."""
    return F.col("include") & (F.col("language") == language) & filled(F.col("title")) & filled(F.col("maintext")) & (F.col("title_translated").isNull() | F.col("maintext_translated").isNull())


def classifiable(field: str, gate: Column | None = None, strict_non_empty: bool = False) -> Column:
    """English articles with a translated title that the model of ``field`` hasn't seen."""
    guard = filled if strict_non_empty else present
    out = (F.col("language_translated") == "en") & guard(F.col("title_translated")) & F.col(field).isNull()
    return out if gate is None else out & gate


def environmental(exclude: tuple[str, ...] = ("-999", "environmental -999")) -> Column:
    """A positive relevance result with a usable first or second label."""
    bad = [*exclude, None]
    return (F.col("environmental_binary.result") == "Yes") & (not_among(F.col("env_classifier.env_max"), bad) | not_among(F.col("env_classifier.env_sec"), bad))


def for_geoparsing() -> Column:
    return environmental() & F.col("gemini_locations").isNull()


def for_reconciling(force: bool = False) -> Column:
    some = F.col("gemini_locations").isNotNull() | F.col("gemini_locations_normalized").isNotNull() | F.col("cliff_locations").isNotNull()
    return environmental() & some & (F.lit(True) if force else F.col("reconciled_locations").isNull())


def eligible_sources(sources: DataFrame, countries: list[str] | None = None, international: bool = False, regional: bool = False) -> DataFrame:
    """Included domains of the countries, or of major international or regional outlets."""
    chosen = F.lit(False)
    if countries is not None:
        chosen = chosen | F.coalesce(F.arrays_overlap("primary_location", F.array(*map(F.lit, countries))), F.lit(False))
    if international:
        chosen = chosen | F.coalesce("major_international", F.lit(False))
    if regional:
        chosen = chosen | F.coalesce("major_regional", F.lit(False))
    return sources.where(F.coalesce("include", F.lit(False)) & chosen).select("source_domain").distinct()


def from_sources(articles: DataFrame, domains: DataFrame) -> DataFrame:
    """Semi join on the domain; Spark broadcasts the domains when their measured size allows it."""
    return articles.join(domains, "source_domain", "left_semi")


def url_allowed(urls: DataFrame, sources: DataFrame, url_col: str = "url", domain_col: str = "source_domain") -> DataFrame:
    """``allowed`` for every url: false for unknown domains and for urls that hold one of the domain's patterns."""
    rules = sources.groupBy(F.col("source_domain").alias("rule_domain")).agg(F.flatten(F.collect_list(F.coalesce("blacklist_url_patterns", F.array().cast("array<string>")))).alias("patterns"))
    joined = urls.join(rules, urls[domain_col] == rules["rule_domain"], "left")
    allowed = F.coalesce(~F.exists("patterns", lambda p: F.contains(F.col(url_col), p)), F.lit(False))
    return joined.select(*[urls[c] for c in urls.columns], allowed.alias("allowed"))


def blacklist_split(articles: DataFrame, sources: DataFrame) -> DataFrame:
    """``blacklisted`` for every article: its url matches one of its domain's regular expressions.

    Domains without patterns blacklist nothing.
    """
    rules = sources.where(F.size("blacklist_url_patterns") > 0).groupBy(F.col("source_domain").alias("rule_domain")).agg(F.array_distinct(F.flatten(F.collect_list("blacklist_url_patterns"))).alias("patterns"))
    joined = articles.join(rules, articles["source_domain"] == rules["rule_domain"], "left")
    hit = F.coalesce(F.exists("patterns", lambda p: F.regexp(F.col("url"), p)), F.lit(False))
    return joined.select(*[articles[c] for c in articles.columns], hit.alias("blacklisted"))
