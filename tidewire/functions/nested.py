"""Maps, arrays and vectors of model outputs."""

from __future__ import annotations

import ast
import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value computed once. Inside a lambda an expression is computed anew for every element, a bound one isn't."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def map_argmax(scores: Column) -> Column:
    """Key of the largest value; ties go to the first key in map order."""
    return bind(F.array_max(F.map_values(scores)), lambda top: F.get(F.filter(F.map_entries(scores), lambda e: e["value"] == top), F.lit(0))["key"])


def softmax(logits: Column) -> Column:
    powers = bind(logits, lambda l: bind(F.array_max(l), lambda top: F.transform(l, lambda x: F.exp(x - top))))
    return bind(powers, lambda e: bind(F.aggregate(e, F.lit(0.0), lambda a, x: a + x), lambda total: F.transform(e, lambda x: x / total)))


def ranked(vector: Column) -> Column:
    """(value, index) pairs, largest first; ties go to the lower index."""
    return F.transform(F.array_sort(F.transform(vector, lambda p, i: F.struct((-p).alias("n"), i.alias("i")))), lambda e: F.struct((-e["n"]).alias("value"), e["i"].alias("index")))


def top_two(probabilities: Column, labels: Column, least_second: float = 0.3) -> Column:
    """First label, and the second one if its probability is above the threshold."""
    r = ranked(probabilities)
    second = F.get(r, F.lit(1))
    return F.struct(F.get(labels, F.get(r, F.lit(0))["index"]).alias("env_max"), F.when(second["value"] > least_second, F.get(labels, second["index"])).alias("env_sec"))


def zip_outputs(labels: Column, vector: Column) -> Column:
    return F.map_from_arrays(labels, vector)


def near_equal_parts(items: Column, batch: int) -> Column:
    """A list cut into one part more than it holds whole batches, of sizes that differ by one at most."""
    def cut(x: Column) -> Column:
        parts = F.floor(F.size(x) / batch).cast("int") + 1
        at = lambda i: F.floor(i.cast("long") * F.size(x) / parts).cast("int")
        return F.transform(F.sequence(F.lit(0), parts - 1), lambda i: F.slice(x, at(i) + 1, at(i + 1) - at(i)))

    return bind(items, cut)


def invert(mapping: Column) -> Column:
    return F.map_from_arrays(F.map_values(mapping), F.map_keys(mapping))


def with_cutoff(scores: Column, cutoffs: Column, below: str = "-999") -> Column:
    """The best label, or ``below`` where its score misses its cutoff; a label without a cutoff never passes."""
    best = map_argmax(scores)
    cut = F.coalesce(F.try_element_at(cutoffs, best), F.lit(float("inf")))
    return F.when(F.array_max(F.map_values(scores)) < cut, below).otherwise(best)


def load_map(text: Column, value: str) -> Column:
    """A map from its JSON text; an empty map for anything else."""
    return F.coalesce(F.from_json(text, f"map<string,{value}>"), F.create_map().cast(f"map<string,{value}>"))


def _literal_to_json(values: pd.Series) -> pd.Series:
    def one(text: str | None) -> str | None:
        try:
            value = ast.literal_eval(text or "")
        except (ValueError, SyntaxError, MemoryError, RecursionError):
            return None
        return json.dumps(value) if isinstance(value, dict) else None

    return values.map(one)


def load_map_or_literal(text: Column, value: str) -> Column:
    """As ``load_map``, but a Python literal counts too; only texts that aren't JSON reach Python."""
    kind = f"map<string,{value}>"
    parsed = F.from_json(text, kind)
    literal = F.pandas_udf(_literal_to_json, StringType())(F.when(parsed.isNull(), text))
    return F.coalesce(parsed, F.from_json(literal, kind), F.create_map().cast(kind))


def first_filled(*maps: Column) -> Column:
    """The first map that has entries, else an empty one: empty and null count alike."""
    out = F.when(F.size(maps[0]) > 0, maps[0])
    for m in maps[1:]:
        out = out.when(F.size(m) > 0, m)
    return out.otherwise(F.map_filter(F.coalesce(*maps), lambda k, v: F.lit(False)))


def upsert_key(m: Column, key: str, value: Column) -> Column:
    return F.map_concat(F.map_filter(m, lambda k, _: k != key), F.create_map(F.lit(key), value))


def parse_batch_reply(reply: Column, rows: Column, value: str) -> Column:
    """The list in a fenced JSON reply, or null where it isn't a list of the batch's length."""
    body = F.regexp_replace(F.trim(reply), r"(?s)^```(?:json)?\s*|\s*```$", "")
    parsed = F.from_json(body, f"array<map<string,{value}>>")
    return F.when(F.size(parsed) == rows, parsed)
