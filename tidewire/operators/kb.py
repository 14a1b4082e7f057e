"""The administrative-unit knowledge base as tables: membership, names, tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.functions.placenames import STOPWORDS
from tidewire.functions.text import normalize_for_match


def with_keys(kb: DataFrame, key=normalize_for_match) -> DataFrame:
    """Matching keys beside the names; null names are blank, codes upper case."""
    base = kb.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("Admin0", "Admin1", "Admin2")], F.upper(F.trim(F.coalesce("Admin0_ISO3", F.lit("")))).alias("Admin0_ISO3"))
    return base.withColumns({f"{c}_norm": key(F.col(c)) for c in ("Admin0", "Admin1", "Admin2")})


def membership(keyed: DataFrame, depth: int) -> DataFrame:
    """Distinct codes of every ladder of ``depth`` + 1 keys without blanks."""
    keys = [f"Admin{i}_norm" for i in range(depth + 1)]
    full = F.lit(True)
    for k in keys:
        full = full & (F.col(k) != "")
    return keyed.where(full).groupBy(*keys).agg(F.array_sort(F.collect_set("Admin0_ISO3")).alias("isos"))


def country_names(keyed: DataFrame) -> DataFrame:
    """The most frequent non-blank name of every code; ties go to the smaller name."""
    counted = keyed.where(F.trim("Admin0") != "").groupBy("Admin0_ISO3", "Admin0").agg(F.count("*").alias("n"))
    return counted.groupBy("Admin0_ISO3").agg(F.min(F.struct((-F.col("n")).alias("n"), "Admin0")).alias("best")).select("Admin0_ISO3", F.col("best.Admin0").alias("Admin0"))


def token_values(keyed: DataFrame, level: str) -> DataFrame:
    """(token, value): the distinct values of a level by the tokens of their key, without stopwords."""
    values = keyed.where(F.col(level) != "").select(F.col(level).alias("value"), F.col(f"{level}_norm").alias("key")).distinct()
    return values.select(F.explode(F.array_distinct(F.split("key", " "))).alias("token"), "value").where((F.col("token") != "") & ~F.col("token").isin(sorted(STOPWORDS))).distinct()


def token_frequency(keyed: DataFrame, levels: tuple[str, ...] = ("Admin1", "Admin2")) -> DataFrame:
    """Values that hold a token, added up over the levels."""
    parts = [token_values(keyed, level).groupBy("token").agg(F.count("*").alias("n")) for level in levels]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("token").agg(F.sum("n").alias("n"))


def ground(mentions: DataFrame, keyed: DataFrame, depth: int, names: list[str]) -> DataFrame:
    """Exact grounding: adds ``isos`` where the keys of ``names`` are a ladder of the knowledge base, else null."""
    table = membership(keyed, depth)
    cond = F.lit(True)
    for i, c in enumerate(names):
        cond = cond & (F.col(c) == F.col(f"Admin{i}_norm"))
    return mentions.join(table, cond, "left").drop(*[f"Admin{i}_norm" for i in range(depth + 1)])


def ladder_signature() -> Column:
    """One text for each ladder at its level; null for unknown levels."""
    parts = [normalize_for_match(F.col(c)) for c in ("admin0", "admin1", "admin2")]
    level = F.col("location_level")
    return F.when(level == "ADMIN0", F.concat_ws("\u0001", level, parts[0])).when(level == "ADMIN1", F.concat_ws("\u0001", level, *parts[:2])).when(level == "ADMIN2", F.concat_ws("\u0001", level, *parts))


def deduplicate_ladders(places: DataFrame, doc: str = "_id", position: str = "position") -> DataFrame:
    """Keep the best surface name of every ladder of a document: the canonical name first, then fewer stopwords, then shorter, then earlier.

    ``places`` holds one row a place: doc, position, name and the ladder. Rows of unknown level are
    all kept. A document's places are few, so the window is bounded by the document.
    """
    name = normalize_for_match(F.col("name"))
    canonical = normalize_for_match(F.when(F.col("location_level") == "ADMIN0", F.col("admin0")).when(F.col("location_level") == "ADMIN1", F.col("admin1")).otherwise(F.col("admin2")))
    small = F.array(*map(F.lit, sorted(STOPWORDS | {"of", "the"})))
    ranked = places.withColumns({
        "__sig": F.coalesce(ladder_signature(), F.concat(F.lit("\u0002"), F.col(position).cast("string"))),
        "__inexact": (~((canonical != "") & (name == canonical))).cast("int"),
        "__small": F.size(F.filter(F.split(name, " "), lambda t: F.array_contains(small, t))),
        "__length": F.length(name),
    })
    w = Window.partitionBy(doc, "__sig").orderBy("__inexact", "__small", "__length", position)
    return ranked.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__sig", "__inexact", "__small", "__length", "__rank")
