"""Bulk updates of the article table: only months that hold touched rows are read and written.

The months are written anew beside the table, then one small file, the intent, says that they are whole.
From there on the merge can only go forward: every month is swapped in by renames, and whoever finds the
intent first, a retry or the next merge, does what is left. A merge has a name; once done it is not done again.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewire.sources.folders import Folders

MONTH = ["year", "month"]
#: Beside the months; readers skip names that begin so.
_PLACE = "_merge"


@dataclass(frozen=True)
class Merged:
    modified: int
    months: list[str]


def touched_months(spark: SparkSession, path: str, changes: DataFrame, key: str = "_id") -> DataFrame:
    """``changes`` with the months of their rows; the table is read for its keys only, and not at all if the months are given."""
    if set(MONTH) <= set(changes.columns):
        return changes
    return changes.join(spark.read.parquet(path).select(key, *MONTH), key)


def of_months(months: list[tuple]) -> Column:
    """A filter on the partition columns, so other months are not even listed."""
    keep = F.lit(False)
    for year, month in months:
        keep = keep | (F.col("year").eqNullSafe(F.lit(year)) & F.col("month").eqNullSafe(F.lit(month)))
    return keep


def updated(old: DataFrame, changes: DataFrame, key: str = "_id") -> tuple[DataFrame, Column]:
    """Rows of ``old`` with the fields that ``changes`` sets, and whether a row really changes.

    Of several changes of one key the largest counts. Null sets a field to null. Keys that the table lacks change nothing.
    """
    fields = [c for c in changes.columns if c not in (key, *MONTH)]
    new = changes.groupBy(key).agg(F.max(F.struct(*fields)).alias("__new"))
    joined = old.join(new, key, "left")
    touched = F.col("__new").isNotNull()
    differs = F.lit(False)
    for c in fields:
        differs = differs | ~F.col(f"__new.{c}").eqNullSafe(old[c] if c in old.columns else F.lit(None))
    joined = joined.withColumn("__changed", touched & differs)
    values = {c: F.when(touched, F.col(f"__new.{c}")).otherwise(old[c] if c in old.columns else F.lit(None)) for c in fields}
    return joined.withColumns(values).drop("__new"), F.col("__changed")


def merge_changes(spark: SparkSession, path: str, changes: DataFrame, name: str, key: str = "_id") -> Merged:
    """Set the fields of ``changes`` (key, fields, and the months if known) in the table at ``path``; how many rows changed, in which months."""
    folders, place = Folders(spark, path), f"{path}/{_PLACE}/{name}"
    finish_merges(spark, path)
    if folders.exists(f"{place}/done"):
        return Merged(**json.loads(folders.read(f"{place}/done")))
    folders.delete(place)  # of a run that ended before its intent
    located = touched_months(spark, path, changes, key)
    months = [tuple(r) for r in located.select(*MONTH).distinct().collect()]
    staged, modified = [], 0
    if months:
        seen = Observation()
        rows, changed = updated(spark.read.parquet(path).where(of_months(months)), located, key)
        rows.observe(seen, F.count_if(changed).alias("modified")).drop("__changed").write.partitionBy(*MONTH).parquet(f"{place}/data")
        modified = seen.get["modified"]
        staged = [f"{y}/{m}" for y in folders.children(f"{place}/data") if "=" in y for m in folders.children(f"{place}/data/{y}") if "=" in m]
    folders.write(f"{place}/draft", json.dumps({"modified": modified, "months": staged}))
    folders.move(f"{place}/draft", f"{place}/intent")
    finish_merges(spark, path)
    return Merged(modified, staged)


def finish_merges(spark: SparkSession, path: str) -> list[str]:
    """Bring merges to their end that were stopped after their intent; their names. Any step may be repeated."""
    folders, finished = Folders(spark, path), []
    for name in folders.children(f"{path}/{_PLACE}"):
        place = f"{path}/{_PLACE}/{name}"
        if not folders.exists(f"{place}/intent"):
            continue
        for month in json.loads(folders.read(f"{place}/intent"))["months"]:
            new, live, old = f"{place}/data/{month}", f"{path}/{month}", f"{place}/old/{month}"
            if folders.exists(new):
                if folders.exists(live):
                    folders.move(live, old)
                folders.move(new, live)
        folders.move(f"{place}/intent", f"{place}/done")
        folders.delete(f"{place}/data")
        folders.delete(f"{place}/old")
        finished.append(name)
    return finished
