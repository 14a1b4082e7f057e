"""Sessions and run settings."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import SparkSession


def build_session(name: str = "tidewire", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution; a cluster's own settings win over these defaults."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.parquet.filterPushdown": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@dataclass(frozen=True)
class RunConfig:
    """Settings of a scheduled run; ``from_env`` reads RUN_SCHEDULED, WINDOW_START, WINDOW_END, ONCE, CHUNK and PAUSE."""

    scheduled: bool = True
    window_start: str = "21:00"
    window_end: str = "20:59"
    once: bool = False
    chunk_minutes: int = 0
    pause_seconds: int = 0

    @classmethod
    def from_env(cls, env: dict | None = None) -> RunConfig:
        env = os.environ if env is None else env
        flag = lambda k, d: str(env.get(k, d)).strip().lower() in ("1", "true", "yes", "y", "on")
        return cls(flag("RUN_SCHEDULED", "1"), env.get("WINDOW_START", cls.window_start), env.get("WINDOW_END", cls.window_end), flag("ONCE", "0"), int(env.get("CHUNK", 0)), int(env.get("PAUSE", 0)))
