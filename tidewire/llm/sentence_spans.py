"""Substring dedup by sliding sentence spans.

Every run of consecutive sentences is hashed, equal runs are found over the whole corpus, and the
sentences under any occurrence but the first are removed. From each sentence there is one run
forwards and one backwards: the shortest of at least two sentences and ``LEAST_WORDS`` words. A very
long sentence is a run of its own. The two directions together cover a repeated passage up to both of
its ends.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import scratch

LEAST_WORDS, LONE_WORDS = 20, 40
_SENTENCE = re.compile(r"[^.!?\n]*[.!?\n]+[\x20\x09-\x0D]*|[^.!?\n]+")


def sentences(text: str) -> list[str]:
    """Pieces that end after sentence marks or line ends and what white space follows; joined they give the text."""
    return _SENTENCE.findall(text)


def runs(pieces: list[str]) -> tuple[np.ndarray, np.ndarray, list[int], list[int]]:
    """Starts and ends (exclusive) of the runs, and two 64-bit halves of their hashes, which are made of 128-bit digests of the sentences."""
    from xxhash import xxh3_128_digest, xxh3_128_intdigest

    split = [p.encode("utf-8", "surrogatepass").lower().split() for p in pieces]
    digests = b"".join([xxh3_128_digest(b" ".join(w)) for w in split])
    words = np.concatenate([[0], np.cumsum([len(w) for w in split])]).astype(np.int64)
    n = len(pieces)
    at = np.arange(n)
    size = np.diff(words)
    ends = np.where(size >= LONE_WORDS, at + 1, np.maximum(np.searchsorted(words, words[:-1] + LEAST_WORDS, side="left"), at + 2))
    starts = np.where(size >= LONE_WORDS, at, np.minimum(np.searchsorted(words, words[1:] - LEAST_WORDS, side="right") - 1, at - 1))
    forward, backward = ends <= n, starts >= 0
    code = np.unique(np.concatenate([at[forward] * (n + 1) + ends[forward], starts[backward] * (n + 1) + at[backward] + 1]))
    a, b = code // (n + 1), code % (n + 1)
    h = [xxh3_128_intdigest(digests[16 * i : 16 * j]) for i, j in zip(a.tolist(), b.tolist())]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return a, b, [signed(x >> 64) for x in h], [signed(x & 0xFFFFFFFFFFFFFFFF) for x in h]


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("t").to_pylist()
        row, a, b, hi, lo = [], [], [], [], []

        def flush() -> pa.RecordBatch:
            take = pa.array(np.concatenate(row))
            out = [batch.column("id").take(take), batch.column("th").take(take), pa.array(np.concatenate(a).astype(np.int32)), pa.array(np.concatenate(b).astype(np.int32)), pa.array(hi, pa.int64()), pa.array(lo, pa.int64())]
            return pa.RecordBatch.from_arrays(out, ["id", "th", "a", "b", "hi", "lo"])

        for i, text in enumerate(texts):
            x = runs(sentences(text))
            row.append(np.full(len(x[0]), i))
            a.append(x[0])
            b.append(x[1])
            hi += x[2]
            lo += x[3]
            if len(hi) > 100_000:
                yield flush()
                row, a, b, hi, lo = [], [], [], [], []
        if hi:
            yield flush()


def _rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, gone, kept = [], [], []
        for text, spans in zip(batch.column("t").to_pylist(), batch.column("spans").to_pylist()):
            pieces = sentences(text)
            edge = np.zeros(len(pieces) + 1, np.int64)
            for s in spans or ():
                edge[s["a"]] += 1
                edge[s["b"]] -= 1
            covered = np.cumsum(edge)[:-1] > 0
            n.append(len(pieces))
            gone.append(int(covered.sum()))
            kept.append("".join([p for p, c in zip(pieces, covered) if not c]) if covered.any() else text)
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())], ["id", "n_sentences", "n_removed", "text"])


def remove_repeated_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, ``n_sentences``, ``n_removed`` and the ``text`` that stays.

    The first occurrence of a run is the one of the smallest id (null first), then text hash, then
    place. Null and empty texts have no sentences and stay empty. Rows that repeat both id and text
    are one document and keep the same sentences. Texts of any length are read whole. Other columns
    are left out, so clashing names do no harm. An empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    docs = df.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("th"), text.alias("t"))
    kind = docs.schema["id"].dataType.simpleString()
    spans = docs.mapInArrow(_spans, f"id {kind}, th bigint, a int, b int, hi bigint, lo bigint")
    first = scratch(spans.groupBy("hi", "lo").agg(F.count("*").alias("n"), F.min(F.struct("id", "th", "a")).alias("first")).where("n > 1").select("hi", "lo", "first"), "spans")
    # Both sides get fresh exchanges: adaptive execution splits a passage that very many documents share.
    later = spans.join(first, ["hi", "lo"]).where(~F.struct("id", "th", "a").eqNullSafe(F.col("first")))
    marked = later.groupBy("id", "th").agg(F.collect_set(F.struct("a", "b")).alias("spans")).select(F.col("id").alias("mid"), F.col("th").alias("mth"), "spans")
    out = docs.join(marked, (docs["th"] == marked["mth"]) & docs["id"].eqNullSafe(marked["mid"]), "left").select("id", "t", "spans")
    return out.mapInArrow(_rebuild, f"id {kind}, n_sentences bigint, n_removed bigint, text string").withColumnRenamed("id", id_col)
