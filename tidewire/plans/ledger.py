"""Runs over months in chunks that can be stopped at any time and go on where they were.

The rows of a chunk are written aside and moved into their place by one rename. That a chunk's folder is in
its place is the ledger: rows and ledger entry can't be there one without the other.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.sources.folders import Folders

Task = tuple[str, int]


def chunk_of(key: Column, chunks: int) -> Column:
    """The chunk of a row, the same one in every run."""
    return F.pmod(F.xxhash64(key), F.lit(chunks)).cast("int")


def _place(path: str, task: Task) -> str:
    return f"{path}/of_month={task[0]}/of_chunk={task[1]}"


def finished(spark: SparkSession, path: str) -> list[Task]:
    """The ledger: (month, chunk) of all chunks in their place."""
    folders = Folders(spark, path)
    return [(m.split("=", 1)[1], int(c.split("=", 1)[1])) for m in folders.children(path) if m.startswith("of_month=") for c in folders.children(f"{path}/{m}")]


def run_chunks(spark: SparkSession, path: str, months: list[str], chunks: int, work: Callable[[str, int], DataFrame], stop: datetime | None = None, now: Callable[[], datetime] = datetime.now) -> list[Task]:
    """Write ``work(month, chunk)`` for every chunk that the ledger lacks, until ``stop``; the chunks that are left."""
    folders, done = Folders(spark, path), set(finished(spark, path))
    due = [(m, c) for m in months for c in range(chunks) if (m, c) not in done]
    for k, task in enumerate(due):
        if stop is not None and now() >= stop:
            return due[k:]
        aside = f"{path}/_aside/{uuid.uuid4().hex}"
        work(*task).write.parquet(aside)
        folders.move(aside, _place(path, task))
    folders.delete(f"{path}/_aside")  # also what stopped runs have left
    return []


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all finished chunks, with ``of_month`` and ``of_chunk``."""
    return spark.read.parquet(path)
