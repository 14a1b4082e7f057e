"""Hashed n-gram features and the scoring of whole texts, shared by the two text classifiers."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import label_sample, numbered, scratch

_TOKEN = re.compile(r"\w+|[^\w\s]+")
#: Tokens handled at once, so that one very long text needs no more memory than many short ones.
_CHUNK = 1 << 16
#: Tokens before a chunk that are read with it: two that n-grams may reach, and two that these are compared with.
_LEAD = 4
#: The bound of what a fit gathers on the driver.
SAMPLE_BYTES = 96 << 20
#: Bytes of features that leave a Python worker at once.
_HELD = 4 << 20


class _Tokens(dict):
    """Numbers of each token, computed once; emptied when the tokens of a call might not fit any more."""

    def __init__(self, *of: Callable[[str], int], most: int = 400_000):
        super().__init__()
        self.of, self.rows = of, np.zeros((len(of), most), np.uint64)

    def __missing__(self, token: str) -> int:
        k = self[token] = len(self)
        self.rows[:, k] = [f(token) for f in self.of]
        return k

    def numbers(self, tokens: list[str]) -> np.ndarray:
        """One row for each function, one column for each token; at most ``_CHUNK`` + ``_LEAD`` tokens."""
        if len(self) + len(tokens) > self.rows.shape[1]:
            self.clear()
        return self.rows[:, np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))]


def _shape(token: str) -> int:
    """Case pattern of a word, or the punctuation itself."""
    if not (token[0].isalnum() or token[0] == "_"):
        return crc32(token.encode("utf-8", "surrogatepass")) | 1
    if token.isdigit():
        return 2
    return 4 if token.islower() else 6 if token.istitle() else 8 if token.isupper() and len(token) > 1 else 10


def _mix(*parts: np.ndarray, salt: int, bits: int) -> np.ndarray:
    h = np.full(len(parts[0]), salt, np.uint64)
    for p in parts:
        h = (h ^ p) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return ((h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - bits)).view(np.int64)


class QualityFeatures:
    """Indicators of word 1- and 2-grams and of 1- to 3-grams of token shapes, in which a word equal to the word before counts as its own shape."""

    bits = 18

    def __init__(self) -> None:
        self.tokens = _Tokens(lambda t: crc32(t.lower().encode("utf-8", "surrogatepass")), _shape)

    def __call__(self, tokens: list[str], skip: int = 0) -> np.ndarray:
        w, s = self.tokens.numbers(tokens)
        for gap in (1, 2):
            s[gap:][(w[gap:] == w[:-gap]) & (s[gap:] < 16)] = 12
        w, s = w[skip:], s[skip:]
        return np.concatenate([_mix(w, salt=1, bits=self.bits), _mix(w[:-1], w[1:], salt=2, bits=self.bits), _mix(s, salt=3, bits=self.bits), _mix(s[:-1], s[1:], salt=4, bits=self.bits), _mix(s[:-2], s[1:-1], s[2:], salt=5, bits=self.bits)])


class ToxicFeatures:
    """Indicators of words, word beginnings of 4 and 5 letters, 2-grams and skip-grams (one word left out)."""

    bits = 22

    def __init__(self) -> None:
        crc = lambda t: crc32(t.encode("utf-8", "surrogatepass"))
        self.tokens = _Tokens(lambda t: crc(t.lower()), lambda t: crc(t.lower()[:4]), lambda t: crc(t.lower()[:5]))

    def __call__(self, tokens: list[str], skip: int = 0) -> np.ndarray:
        w, a, b = self.tokens.numbers(tokens[skip:])
        return np.concatenate([_mix(w, salt=1, bits=self.bits), _mix(a, salt=2, bits=self.bits), _mix(b, salt=3, bits=self.bits), _mix(w[:-1], w[1:], salt=4, bits=self.bits), _mix(w[:-2], w[2:], salt=5, bits=self.bits)])


def indices(text: str | None, features: Callable[[list[str], int], np.ndarray], among: np.ndarray | None = None) -> np.ndarray:
    """Distinct feature numbers of a whole text, if given only those marked in ``among``; none for null and empty texts.

    Chunks give what the whole text would: the tokens at the start of one are marked by those before them.
    """
    tokens = _TOKEN.findall(text or "")
    parts = [features(tokens[max(0, k - _LEAD) : k + _CHUNK], max(0, min(k, _LEAD) - 2)) for k in range(0, len(tokens), _CHUNK)]
    if among is not None:  # sorting out the few that count is cheaper than sorting all
        parts = [p[among[p]] for p in parts]
    return np.unique(np.concatenate(parts)).astype(np.int32) if parts else np.empty(0, np.int32)


def training_set(docs: DataFrame, labels: DataFrame, label: str, learn: Column, make: type, sample_rows: int, sample_bytes: int = SAMPLE_BYTES) -> tuple[np.ndarray, list[np.ndarray]]:
    """Labels (0, 1) and feature numbers of at most ``sample_rows`` labelled documents, gathered on the driver.

    The sample takes the smallest hashes of doc_id among the labelled rows that ``learn`` admits, as
    far as their features fit into ``sample_bytes``, and is the same in every run. A doc_id with
    several texts counts once. Features are made on the executors.
    """
    chosen = label_sample(labels, label, sample_rows, learn)
    texts = numbered(docs.select("doc_id", F.col("text").cast("string").alias("t")), "texts")
    # One row of each sampled id, chosen without reading the texts.
    first = texts.select("doc_id", "rid").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("rid").alias("rid"))
    rows = texts.select("rid", "t").join(F.broadcast(first), "rid")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = make()
        for batch in batches:
            lo, held, x = 0, 0, []
            for k in range(batch.num_rows):
                x.append(indices(batch.column("t")[k].as_py(), features).tobytes())
                held += len(x[-1])
                if held > _HELD or k + 1 == batch.num_rows:  # the features of very long texts need not fit together
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, len(x)), batch.column("label").slice(lo, len(x)), pa.array(x, pa.binary())], ["doc_id", "label", "x"])
                    lo, held, x = k + 1, 0, []

    made = scratch(rows.select("doc_id", "label", "t").mapInArrow(work, "doc_id bigint, label int, x binary"), "features")
    sizes = made.select(F.xxhash64("doc_id").alias("h"), F.length("x").alias("n")).collect()  # one short row a sampled document
    room, last = sample_bytes, -(2**63)
    for h, n in sorted(map(tuple, sizes)):
        room -= n
        if room < 0:
            break
        last = h
    got = made.where(F.xxhash64("doc_id") <= F.lit(last)).collect()
    got.sort(key=lambda r: r["doc_id"])
    return np.array([r["label"] for r in got], np.int64), [np.frombuffer(r["x"], np.int32) for r in got]


def score_texts(df: DataFrame, weights: np.ndarray, bias: float, make: type, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text", norm: np.ndarray | None = None, sharpness: float = 1.0) -> DataFrame:
    """The columns of ``keep`` and ``score``, the logistic of bias plus the weights of a text's features.

    With ``norm``, the sum of the weights is divided by the length of the text's vector of these
    values. Both have 2 ** ``make.bits`` entries whatever the data; of ``weights`` only non-zero ones are
    sent. Null and empty texts get the bias alone. Rows stand alone: no shuffle.
    """
    at = np.flatnonzero(weights)
    squares = None if norm is None else (norm**2).astype(np.float32)
    shared = df.sparkSession.sparkContext.broadcast((at.astype(np.int32), weights[at].astype(np.float64), float(bias), squares))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, values, bias, squares = shared.value
        w = np.zeros(1 << make.bits)
        w[at] = values
        among = w != 0 if squares is None else None
        features = make()
        for batch in batches:
            margin = []
            for t in batch.column("t").to_pylist():
                i = indices(t, features, among)
                length = 1.0 if squares is None else np.sqrt(squares[i].sum(dtype=np.float64)) or 1.0
                margin.append(bias + w[i].sum() / length)
            score = 1 / (1 + np.exp(-np.clip(sharpness * np.array(margin, float), -500, 500)))
            yield pa.RecordBatch.from_arrays([batch.column("k"), pa.array(score)], ["k", "score"])

    rows = df.select(F.struct(*[F.col(c) for c in keep]).alias("k"), F.col(text_col).cast("string").alias("t"))
    out = rows.mapInArrow(work, f"k {rows.schema['k'].dataType.simpleString()}, score double")
    return out.select(*[F.col("k")[c].alias(c) for c in keep], "score")


def fold(modulus: int) -> Column:
    """The contract's fold: crc32 of doc_id as text, modulo ``modulus``; null ids count as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % modulus
