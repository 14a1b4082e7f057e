"""SimHash near-duplicates by anchor points of a covering code.

Fingerprints that differ in at most 3 of 64 bits differ in at most 1 bit of one 32-bit half. For each
half the anchors are the words of the perfect Hamming code of length 31, which covers every 31-bit
word within radius 1 (the half's last bit stays out of the key). A fingerprint goes to every anchor
within covering radius plus threshold, 1 + 1 = 2: its own anchor, and up to 15 at distance 2. The
own anchor of one end of a link is thus among the anchors of the other, so each link meets there.
Equal fingerprints are merged first, and each anchor emits a spanning forest of its links instead of
all pairs. An anchor of very many fingerprints is split further: its links differ in at most 3 bits of
the other half, and so agree in at least 3 of 6 parts of it; each choice of 3 parts makes a key.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import numbered, scratch
from tidewire.llm.components import connected_components

SHINGLE, SEED, MOST_BITS = 3, 42, 3
#: Groups above this size compare by 16-bit blocks within the anchor instead of all with all.
SMALL_GROUP = 2048
#: Anchors above this size are split.
HOT_ANCHOR = 1 << 16
#: The six parts of a 32-bit half, and the masks of all choices of three of them.
_PARTS = [0x1F, 0x3E0, 0x7C00, 0xF8000, 0x3F00000, 0xFC000000]
_CHOICES = np.array([sum(c) for c in combinations(_PARTS, 3)], np.uint64)


def fingerprint(text: str | None) -> int:
    """Majority bits of the XXH64 of all 3-word shingles; 0 without words."""
    from xxhash import xxh64_intdigest

    w = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z and ASCII white space
    if not w:
        return 0
    grams = map(b" ".join, zip(*(w[i:] for i in range(SHINGLE)))) if len(w) >= SHINGLE else iter([b" ".join(w)])
    h = np.fromiter(map(xxh64_intdigest, grams, repeat(SEED)), np.uint64)
    ones = np.zeros(64, np.int64)
    for k in range(0, len(h), 1 << 15):
        ones += np.unpackbits(h[k : k + (1 << 15)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(h)).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = np.fromiter(map(fingerprint, batch.column("t").to_pylist()), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("rid"), pa.array(fp.view(np.int64))], ["id", "rid", "fp"])


def _syndrome(x: np.ndarray) -> np.ndarray:
    """XOR of the places (1..31) of the set bits: 0 for code words, else the bit to flip."""
    s = np.zeros(len(x), np.uint32)
    for bit in range(5):
        mask = np.uint32(sum(1 << (p - 1) for p in range(1, 32) if p >> bit & 1))
        s |= (np.bitwise_count(x & mask).astype(np.uint32) & np.uint32(1)) << np.uint32(bit)
    return s


#: For each syndrome the pairs of bits whose flip gives a code word.
_PAIRS = np.array([[(1 << (i - 1)) | (1 << ((i ^ s) - 1)) for i in range(1, 32) if (i ^ s) > i] for s in range(1, 32)], np.uint32)


def anchors(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Anchor keys and the rows they belong to, for both halves."""
    keys, rows = [], []
    at = np.arange(len(fp))
    for half in (0, 1):
        x = ((fp >> np.uint64(32 * half)) & np.uint64(0x7FFFFFFF)).astype(np.uint32)
        s = _syndrome(x)
        own = np.where(s > 0, x ^ (np.uint32(1) << (np.maximum(s, 1) - np.uint32(1))), x)
        keys.append(own)
        rows.append(at)
        off = np.flatnonzero(s)
        near = x[off, None] ^ _PAIRS[s[off] - 1]
        keys.append(near.ravel())
        rows.append(np.repeat(off, near.shape[1]))
        for k in (-2, -1):
            keys[k] = keys[k].astype(np.int64) | (half << 31)
    return np.concatenate(keys), np.concatenate(rows)


def _to_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = batch.column("fp").to_numpy(zero_copy_only=False)
        for k in range(0, len(fp), 1 << 14):
            part = fp[k : k + (1 << 14)]
            keys, rows = anchors(part.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part[rows])], ["anchor", "fp"])


def _split_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys of an anchor and three parts of the half that it leaves open; keys that fall together by chance only compare more."""
    for batch in batches:
        anchor, fp = (batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("anchor", "fp"))
        for k in range(0, len(fp), 1 << 14):
            a, f = anchor[k : k + (1 << 14)], fp[k : k + (1 << 14)]
            other = np.where(a >> np.uint64(31) & np.uint64(1), f & np.uint64(0xFFFFFFFF), f >> np.uint64(32))
            h = (a[:, None] + np.arange(1, len(_CHOICES) + 1, dtype=np.uint64)[None, :] * np.uint64(1 << 32)) * np.uint64(0x9E3779B97F4A7C15)
            h = ((h ^ (h >> np.uint64(29))) + (other[:, None] & _CHOICES[None, :])) * np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(32)
            yield pa.RecordBatch.from_arrays([pa.array(h.ravel().view(np.int64)), pa.array(np.repeat(f, len(_CHOICES)).view(np.int64))], ["anchor", "fp"])


def _roots(parent: np.ndarray, x: np.ndarray) -> np.ndarray:
    x = parent[x]
    while not np.array_equal(y := parent[x], x):
        x = y
    return x


def _unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    while len(a):
        ra, rb = _roots(parent, a), _roots(parent, b)
        apart = ra != rb
        a, b = ra[apart], rb[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))


def _link_runs(parent: np.ndarray, key: np.ndarray, fp: np.ndarray, at: np.ndarray) -> None:
    """Unite rows of equal, sorted keys whose fingerprints link. ``at``: their places in ``parent``."""
    i = np.arange(len(key) - 1)
    step = 1
    while len(i):
        i = i[i + step < len(key)]
        i = i[key[i] == key[i + step]]
        near = np.bitwise_count(fp[i] ^ fp[i + step]) <= MOST_BITS
        _unite(parent, at[i[near]], at[i[near] + step])
        step += 1


def forest(key: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest for each anchor; rows sorted by anchor."""
    parent = np.arange(len(key))
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    sizes = np.diff(np.r_[starts, len(key)])
    large = np.repeat(sizes > SMALL_GROUP, sizes)
    small = np.flatnonzero(~large)
    _link_runs(parent, key[small], fp[small], small)
    for start, size in zip(starts[sizes > SMALL_GROUP], sizes[sizes > SMALL_GROUP]):
        # At most 3 differing bits leave one of four 16-bit blocks equal.
        rows = np.arange(start, start + size)
        for block in range(4):
            part = (fp[rows] >> np.uint64(16 * block)) & np.uint64(0xFFFF)
            order = np.argsort(part, kind="stable")
            _link_runs(parent, part[order], fp[rows][order], rows[order])
    root = _roots(parent, np.arange(len(key)))
    linked = np.flatnonzero(root != np.arange(len(key)))
    return fp[linked], fp[root[linked]]


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by anchor; an anchor that a batch may cut waits for the next one."""
    keys: list[np.ndarray] = []
    prints: list[np.ndarray] = []
    held = 0

    def out(k: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
        a, b = forest(k, f)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    for batch in batches:
        key, fp = batch.column("anchor").to_numpy(zero_copy_only=False), batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        if not len(key):
            continue
        if held > 1 << 16 and keys[0][0] != key[-1]:
            cut = int(np.searchsorted(key, key[-1], side="left"))
            yield out(np.concatenate([*keys, key[:cut]]), np.concatenate([*prints, fp[:cut]]))
            key, fp, keys, prints, held = key[cut:], fp[cut:], [], [], 0
        keys.append(key)
        prints.append(fp)
        held += len(key)
    if held:
        yield out(np.concatenate(keys), np.concatenate(prints))


def links_of(distinct: DataFrame) -> DataFrame:
    """A forest of the links between fingerprints (column ``fp``), by anchor, and by parts of hot anchors."""
    key = "anchor bigint, fp bigint"
    spread = distinct.select("fp").mapInArrow(_to_anchors, key)
    hot = scratch(spread.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > HOT_ANCHOR).select("anchor"), "hot")
    if not hot.isEmpty():
        spread = spread.join(hot, "anchor", "left_anti").unionByName(spread.join(hot, "anchor", "left_semi").mapInArrow(_split_anchors, key))
    return spread.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_forests, "a bigint, b bigint").distinct()


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] | None = None) -> DataFrame:
    """One row per input row: the columns of ``keep``, or else ``id_col``, and ``fingerprint``, ``component_id`` and ``kept``.

    ``component_id`` is the smallest id reachable over links of at most 3 differing bits; ``kept``
    marks one row of each component, one with that id. Null and empty texts have fingerprint
    zero, linked like any other; a null id never names a component, and a component of null ids has
    a null one. Repeated rows share a fingerprint. Texts of any length are read whole. Other columns
    are left out unless ``keep`` asks for them. An empty table gives an empty result.
    """
    if keep is None:
        docs = df.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("rid"), F.col(text_col).cast("string").alias("t"))
    else:
        docs = numbered(df.select(F.struct(*[F.col(c) for c in keep]).alias("k"), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t")), "numbered")
    kind, number = (docs.schema[c].dataType.simpleString() for c in ("id", "rid"))
    prints = scratch(docs.select("id", "rid", "t").mapInArrow(_fingerprints, f"id {kind}, rid {number}, fp bigint"), "prints")
    first = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "rid")))
    distinct = scratch(prints.groupBy("fp").agg(first.alias("first"), F.min("rid").alias("rid")), "distinct")
    roots = connected_components(links_of(distinct))
    member = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"), "first", "rid")
    best = scratch(member.groupBy("root").agg(F.min("first").alias("first"), F.min("rid").alias("rid")), "best")
    member = scratch(member.select("fp", "root"), "member")
    # Plain scans on both sides: one component may hold a third of all fingerprints, one fingerprint of all rows.
    named = scratch(member.join(best, "root").select("fp", F.col("first.id").alias("component_id"), F.coalesce("first.rid", "rid").alias("keeper")), "named")
    out = prints.join(named, "fp")
    out = out.select("id", "rid", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", (F.col("rid") == F.col("keeper")).alias("kept"))
    if keep is None:
        return out.select(F.col("id").alias(id_col), "fingerprint", "component_id", "kept")
    # The texts come last, by row number, and only for the rows that a filter on the marks leaves.
    return docs.select("k", "rid").join(out.drop("id"), "rid").select(*[F.col("k")[c].alias(c) for c in keep], "fingerprint", "component_id", "kept")
