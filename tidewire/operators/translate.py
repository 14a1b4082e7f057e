"""Translation by injected services, with retries, single-item salvage and a fallback model."""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidewire.functions.text import clean_text
from tidewire.operators.filters import filled, long_enough, untranslated

#: Where a reply holds the English text. A fixed value.
REPLY = r'"translated_text":\{"en":"(.*)"\}'
Batch = Callable[[list[str]], list[str]]


def translate_batch(texts: list[str], service: Batch, fallback: Batch | None = None, tries: int = 4, single_tries: int = 2, pause: float = 1.6, sleep: Callable[[float], None] = time.sleep, fallback_batch: int = 8) -> list[str | None]:
    """One output per text: the batch first, then single items, then the fallback in small batches; None where all fail."""

    def attempt(items: list[str], times: int) -> list[str] | None:
        for k in range(times):
            try:
                got = service(items)
                if got is not None and len(got) == len(items) and all(isinstance(x, str) for x in got):
                    return got
            except Exception:  # noqa: BLE001  tried again after a pause
                pass
            if k + 1 < times:
                sleep(pause**k + random.random() / 10)
        return None

    if not texts:
        return []
    whole = attempt(texts, tries)
    if whole is not None:
        return whole
    out: list[str | None] = [(attempt([t], single_tries) or [None])[0] for t in texts]
    missing = [i for i, x in enumerate(out) if x is None]
    if fallback is not None:
        for k in range(0, len(missing), fallback_batch):
            part = missing[k : k + fallback_batch]
            try:
                got = list(fallback([texts[i] for i in part]))
            except Exception:  # noqa: BLE001  these stay untranslated
                continue
            for i, x in zip(part, got + [None] * (len(part) - len(got))):
                out[i] = x
    return out


def translator(load: Callable[[], tuple[Batch, Batch | None]], batch: int = 30, **options):
    """A column function that translates cleaned texts; ``load`` runs once a worker."""

    @F.pandas_udf(StringType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        service, fallback = load()
        for texts in batches:
            distinct = [t for t in dict.fromkeys(texts) if t]
            got: dict[str, str | None] = {}
            for k in range(0, len(distinct), batch):
                part = distinct[k : k + batch]
                got.update(zip(part, translate_batch(part, service, fallback, **options)))
            yield texts.map(lambda t: got.get(t))

    return run


def translate_articles(df: DataFrame, language: str, load: Callable[[], tuple[Batch, Batch | None]], cap: int = 800, everything: bool = False, **options) -> DataFrame:
    """Translate the eligible articles of a language; both outputs must be non-blank to be written.

    ``everything`` translates articles again that have a translation.
    """
    run = translator(load, **options)
    title, body = clean_text(F.col("title"), cap), clean_text(F.col("maintext"), cap)
    due = (F.col("include") & (F.col("language") == language) & filled(F.col("title")) & filled(F.col("maintext"))) if everything else untranslated(language)
    due = F.coalesce(due & long_enough(title, body), F.lit(False))
    step = df.withColumns({"__t": run(F.when(due, title)), "__b": run(F.when(due, body))})
    good = (F.trim(F.coalesce("__t", F.lit(""))) != "") & (F.trim(F.coalesce("__b", F.lit(""))) != "")
    pick = lambda new, old: F.when(good, new).otherwise(F.col(old))
    return step.withColumns({"title_translated": pick(F.col("__t"), "title_translated"), "maintext_translated": pick(F.col("__b"), "maintext_translated"), "language_translated": pick(F.lit("en"), "language_translated")}).drop("__t", "__b")


def pluck_translation(reply: Column) -> Column:
    """The English text of a service's reply, without backslashes: all up to the last quote, whether the reply is sound JSON or not; null without one."""
    found = F.regexp_extract(reply, REPLY, 1)
    return F.when(reply.rlike(REPLY), F.replace(found, F.lit("\\"), F.lit("")))
