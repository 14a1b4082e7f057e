"""Classification by injected models: batched scoring in Python, decoding and gating in Spark."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from tidewire.functions import nested

#: Answers of the binary relevance model by index: fixed value.
BINARY_LABELS = ("Yes", "No")
#: Output fields of models whose field has another name.
FIELD_OF_MODEL = {"env_binary": "environmental_binary", "anti-us_narrative_class": "US_narrative_class", "anti-us_narrative_sentiment": "US_narrative_sentiment"}

#: Spark hands at most so many bytes of texts to a worker at once, unless the session has a setting of its own.
BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", "4m")


def field_of(model: str) -> str:
    return FIELD_OF_MODEL.get(model, model)


def score(df: DataFrame, text: Column, load: Callable[[], Callable[[list[str]], np.ndarray]], out: str = "logits", batch: int = 320) -> DataFrame:
    """Outputs of an injected model for every text. ``load`` runs once a worker and gives a function from texts to rows of outputs, which gets at most ``batch`` texts at once."""

    @F.arrow_udf(ArrayType(DoubleType()))
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = load()
        for texts in batches:
            # Only the model's own texts are made Python strings, the rest of Spark's batch stays as it came.
            parts = [np.asarray(model([t or "" for t in texts.slice(k, batch).to_pylist()]), float) for k in range(0, len(texts), batch)]
            ends = np.cumsum([0] + [len(r) for p in parts for r in p], dtype=np.int32)
            texts = None  # goes before the next batch comes
            yield pa.ListArray.from_arrays(ends, np.concatenate([p.ravel() for p in parts] or [np.zeros(0)]))

    conf = df.sparkSession.conf
    conf.set(BATCH_BYTES[0], conf.get(*BATCH_BYTES))
    # The explosion of one element keeps the model's call out of the expressions that decode it.
    return df.select(*[c for c in df.columns if c != out], run(text).alias("__scored")).select(*[c for c in df.columns if c != out], F.explode(F.array("__scored")).alias(out))


def model_labels(models: DataFrame, name: str) -> list[str]:
    """Labels of a model in order of their index; an error where the model has no mapping."""
    row = models.where(F.col("model_name") == name).select(F.array_sort(F.transform(F.map_entries("event_type_nums"), lambda e: F.struct(e["value"].alias("i"), e["key"].alias("label")))).alias("x")).first()
    if row is None or not row["x"]:
        raise RuntimeError(f"no labels for model {name!r}")
    return [e["label"] for e in row["x"]]


def model_cutoffs(models: DataFrame, name: str) -> dict[str, float]:
    row = models.where(F.col("model_name") == name).select("event_type_cutoffs").first()
    return dict(row[0] or {}) if row else {}


def _labels(names: list[str]) -> Column:
    return F.array(*map(F.lit, names))


def top_one(logits: Column, labels: list[str], softmax: bool = True) -> Column:
    """The best label and all outputs."""
    p = nested.softmax(logits) if softmax else logits
    return F.struct(F.get(_labels(labels), F.get(nested.ranked(p), F.lit(0))["index"]).alias("result"), nested.zip_outputs(_labels(labels), p).alias("model_outputs"))


def top_two(logits: Column, labels: list[str], least_second: float = 0.3) -> Column:
    p = nested.softmax(logits)
    two = nested.top_two(p, _labels(labels), least_second)
    return F.struct(two["env_max"].alias("env_max"), two["env_sec"].alias("env_sec"), nested.zip_outputs(_labels(labels), p).alias("model_outputs"))


def with_cutoffs(outputs: Column, labels: list[str], cutoffs: dict[str, float] | None) -> Column:
    """Event type by the largest raw output; with cutoffs, -999 below the label's own."""
    scores = nested.zip_outputs(_labels(labels), outputs)
    if cutoffs is None:
        event = nested.map_argmax(scores)
    else:
        table = F.create_map(*[F.lit(x) for kv in cutoffs.items() for x in kv]) if cutoffs else F.create_map().cast("map<string,double>")
        event = nested.with_cutoff(scores, table)
    return F.struct(event.alias("event_type"), scores.alias("model_outputs"))


def keyword_override(event: Column, text: Column, label: str = "coup", pattern: str = "coup|depose|overthrow|oust") -> Column:
    """Optional rule: texts with the keywords get the label."""
    return F.when(F.lower(text).rlike(pattern), label).otherwise(event)


def cascade(df: DataFrame, text: Column, gate: Callable[[], Callable], gate_labels: list[str], then: dict[str, tuple[Callable[[], Callable], list[str]]], gate_field: str, passing: tuple[str, ...] = ("Yes",)) -> DataFrame:
    """Score all rows with the gate, and the rows that pass with the other models; one plan, no shuffle.

    The second models see null instead of the text of rows that don't pass, and spend nothing on them.
    """
    out = score(df, text, gate, "__gate").withColumn(gate_field, top_one(F.col("__gate"), gate_labels)).drop("__gate")
    passes = F.col(f"{gate_field}.result").isin(list(passing))
    for field, (load, labels) in then.items():
        out = score(out, F.when(passes, text), _skipping(load, len(labels)), "__x")
        out = out.withColumn(field, F.when(passes, top_one(F.col("__x"), labels))).drop("__x")
    return out


def _skipping(load: Callable[[], Callable], width: int) -> Callable[[], Callable]:
    def make() -> Callable:
        model = load()

        def run(texts: list[str]) -> np.ndarray:
            out, at = np.zeros((len(texts), width)), [i for i, t in enumerate(texts) if t]
            if at:
                out[at] = model([texts[i] for i in at])
            return out

        return run

    return make
