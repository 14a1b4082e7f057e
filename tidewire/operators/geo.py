"""Places found by geoparsers: grouping by country, hierarchies and cleaning of replies."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.functions.nested import bind
from tidewire.schemas import ADMIN_MENTION, FOCUS, LOCATION, MENTION


def iso_codes(spark: SparkSession) -> dict[str, str]:
    """Two-letter to three-letter country codes, from the JVM's own table."""
    locale = spark._jvm.java.util.Locale
    return {c: locale("", c).getISO3Country() for c in locale.getISOCountries()}


def iso3(code: Column, codes: dict[str, str], missing: str, extra: dict[str, str] | None = None) -> Column:
    """Three-letter code by table, ``missing`` for unknown ones."""
    pairs = {**codes, **(extra or {})}
    table = F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])
    return F.coalesce(F.try_element_at(table, code), F.lit(missing))


def group_names(mentions: Column, key: Callable[[Column], Column], value: Callable[[Column], Column], keep: Callable[[Column], Column] | None = None) -> Column:
    """Map of key to distinct values, keys and values in order of first occurrence; null stays null."""
    pairs = F.transform(mentions, lambda m: F.struct(key(m).alias("k"), value(m).alias("v"), (keep(m) if keep else F.lit(True)).alias("ok")))
    return bind(F.filter(pairs, lambda p: p["ok"]), lambda ok: bind(
        F.array_distinct(F.transform(ok, lambda p: p["k"])),
        lambda keys: F.map_from_arrays(keys, F.transform(keys, lambda k: F.array_distinct(F.transform(F.filter(ok, lambda p: p["k"] == k), lambda p: p["v"])))),
    ))


def places_by_country(mentions: Column, codes: dict[str, str], with_coordinates: bool = False) -> Column:
    """Names (or names with coordinates) by country; unknown codes go under the text None."""
    key = lambda m: iso3(m["countryCode"], codes, "None", {"XK": "XKX"})
    value = (lambda m: F.struct(m["name"].alias("name"), m["lat"].alias("lat"), m["lon"].alias("lon"))) if with_coordinates else (lambda m: m["name"])
    return group_names(mentions, key, value, lambda m: ~((m["name"] == "Capitol") & (key(m) == "MYS")))


def places_deduplicated_overall(entities: Column) -> Column:
    """Names by country, each name under the country it is first seen with; countries left without names stay, empty."""
    countries = F.array_distinct(F.transform(entities, lambda e: e["country_code3"]))
    firsts = bind(F.transform(entities, lambda x: x["name"]), lambda names: F.filter(entities, lambda e, i: F.array_position(names, e["name"]) == i + 1))
    return bind(firsts, lambda f: F.map_from_arrays(countries, F.transform(countries, lambda c: F.transform(F.filter(f, lambda e: e["country_code3"] == c), lambda e: e["name"]))))


def admin_hierarchy(mentions: Column, focus: Column, country_names: dict[str, str] | None = None) -> Column:
    """Each mention with its chain: itself, its state and its country where the focus names them."""
    names = F.create_map(*[F.lit(x) for kv in (country_names or {"": ""}).items() for x in kv])
    level = lambda n, l, c: F.struct(n.alias("name"), l.alias("level"), c.alias("country_code"))

    def chain(m: Column) -> Column:
        state = F.get(F.filter(focus["states"], lambda s: s["id"] == m["stateGeoNameId"]), F.lit(0))
        country = F.get(F.filter(focus["countries"], lambda s: s["id"] == m["countryGeoNameId"]), F.lit(0))
        by_code = F.try_element_at(names, m["countryCode"])
        chain_ = F.array_compact(
            F.array(
                level(m["name"], m["featureCode"], m["countryCode"]),
                F.when(state["name"].isNotNull(), level(state["name"], state["featureCode"], state["countryCode"])),
                F.when(country["name"].isNotNull(), level(country["name"], country["featureCode"], country["countryCode"])).otherwise(F.when(by_code.isNotNull(), level(by_code, F.lit("PCLI"), m["countryCode"]))),
            )
        )
        return bind(chain_, lambda steps: bind(F.transform(steps, lambda x: x["name"]), lambda names: F.filter(steps, lambda s, i: F.array_position(names, s["name"]) == i + 1)))

    return F.transform(
        mentions,
        lambda m: F.struct(
            m["name"].alias("location"), m["featureCode"].alias("location_level"), F.lit("Other").alias("original_category"), m["lon"].alias("lon"), m["lat"].alias("lat"), m["confidence"].alias("confidence"), chain(m).alias("admin_hierarchy"),
        ),
    ).cast(f"array<{ADMIN_MENTION}>")


def clean_reply(places: Column) -> Column:
    """Drop the key Unknown and places without details; missing fields become Unknown."""
    filled = F.transform_values(places, lambda _, v: F.struct(*[F.coalesce(v[f], F.lit("Unknown")).alias(f) for f in ("location_level", "admin0", "admin1", "admin2")]))
    return F.map_filter(filled, lambda k, v: (F.lower(F.trim(k)) != "unknown") & F.try_element_at(places, k).isNotNull())


def geoparse(df: DataFrame, text: Column, load: Callable[[], Callable[[str], dict | None]], out: str = "geoparsed") -> DataFrame:
    """Run an injected geoparser over texts; ``load`` runs once a worker. Failures give null."""

    @F.pandas_udf(f"struct<mentions:array<{MENTION}>,focus:{FOCUS}>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        parser = load()
        for texts in batches:
            rows = []
            for t in texts:
                try:
                    rows.append((parser(t) if t else None) or {})
                except Exception:  # noqa: BLE001  a failed text has no places
                    rows.append({})
            yield pd.DataFrame({"mentions": [r.get("mentions") for r in rows], "focus": [r.get("focus") for r in rows]})

    return df.withColumn(out, run(text))


def batch_prompt(titles: Column, bodies: Column) -> Column:
    """The numbered article list of one batch; ``titles`` and ``bodies`` are cleaned arrays."""
    entries = F.transform(F.arrays_zip(titles.alias("t"), bodies.alias("b")), lambda x, i: F.concat((i + 1).cast("string"), F.lit(". Article "), (i + 1).cast("string"), F.lit(" Title: "), F.substring(x["t"], 1, 300), F.lit(" Maintext: "), F.substring(x["b"], 1, 1200)))
    return F.concat(F.lit("\n\nArticles for the Geoparsing:\n"), F.array_join(entries, "\n"))


def geoparse_in_batches(df: DataFrame, ask: Callable[[str], str], id_col: str = "_id", sizes: tuple[int, ...] = (10, 5, 1), tries: int = 3) -> DataFrame:
    """Ask an injected model about batches of articles; rows of failed batches come back in smaller ones.

    ``ask`` takes a prompt and gives a fenced JSON list of one map per article. One pass per batch
    size over each partition; a row is answered at most once. Columns ``title`` and ``body`` must be
    cleaned. Returns ``id_col``, ``gemini_locations`` and ``error`` (the last failed reply).
    """
    import json
    import re

    kind = f"{id_col} {df.schema[id_col].dataType.simpleString()}, gemini_locations map<string,{LOCATION}>, error string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            left, done, errors = list(pdf[[id_col, "title", "body"]].itertuples(index=False, name=None)), {}, {}
            for size in sizes:
                missed = []
                for k in range(0, len(left), size):
                    rows = left[k : k + size]
                    prompt = "\n\nArticles for the Geoparsing:\n" + "\n".join(f"{i + 1}. Article {i + 1} Title: {(t or '')[:300]} Maintext: {(b or '')[:1200]}" for i, (_, t, b) in enumerate(rows))
                    for _ in range(tries):
                        reply = ""
                        try:
                            reply = ask(prompt)
                            parsed = json.loads(re.sub(r"^```(?:json)?\s*|\s*```$", "", reply.strip()))
                            if isinstance(parsed, list) and len(parsed) == len(rows):
                                for (key, _, _), places in zip(rows, parsed):
                                    done[key] = {n: {f: str(v.get(f) or "Unknown") for f in ("location_level", "admin0", "admin1", "admin2")} for n, v in (places or {}).items() if isinstance(v, dict) and n.strip().lower() != "unknown"}
                                break
                        except Exception as e:  # noqa: BLE001  tried again, then left to smaller batches
                            reply = reply or repr(e)
                        for key, _, _ in rows:
                            errors[key] = reply
                    else:
                        missed += rows
                left = missed
            keys = list(pdf[id_col])
            yield pd.DataFrame({id_col: keys, "gemini_locations": [done.get(k) for k in keys], "error": [None if k in done else errors.get(k) for k in keys]})

    return df.select(id_col, "title", "body").mapInPandas(run, kind)
