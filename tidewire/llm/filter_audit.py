"""Which documents five quality filters remove, in every order in which they can be applied.

Texts are read as the byte buffers of Arrow batches: NumPy byte classes and their prefix sums count
words, capitals, symbols and code points of all documents of a chunk at once, and the sorted hashes of a
document's words, compared byte by byte where they are equal, give its distinct words. What a document
fails becomes one number of five bits; all counts follow from how many documents have which number.

Null texts count as empty, null sources as ''. Rows that repeat an id and a text are each counted. A row
without an id is never a copy, and nothing is a copy of it. An id with several labels has the largest.
Other columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import local_table, scratch

#: Fixed values of the contract: names of the filters, least words, least percent of distinct words, most percent of capitals, symbols.
FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 50, 65, 5
SYMBOLS = b"#$%&*|"

#: Bytes of texts that are scanned together.
CHUNK = 1 << 21

_BYTES = np.arange(256)
_SPACE = (_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13))
_CAPITAL = (_BYTES >= 65) & (_BYTES <= 90)
_SYMBOL = np.isin(_BYTES, list(SYMBOLS))
_FIRST = (_BYTES & 0xC0) != 0x80  # of a code point in UTF-8
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the base, and of its inverse, modulo 2**64."""
    up = np.full(n, _BASE, np.uint64)
    down = np.full(n, np.uint64(pow(int(_BASE), -1, 1 << 64)), np.uint64)
    up[:1] = down[:1] = 1
    return np.cumprod(up), np.cumprod(down)


class Scanner:
    """Counts of texts that lie one after another in ``data``; the powers grow with the longest chunk."""

    def __init__(self):
        self.up, self.down = _powers(0)

    def words(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First byte, end and hash of every word; no word reaches over the places ``at``, where texts begin."""
        if len(data) > len(self.up):
            self.up, self.down = _powers(len(data))
        inside = ~_SPACE[data]
        border = np.zeros(len(data) + 1, bool)
        border[at] = True
        before = np.r_[False, inside[:-1]] & ~border[:-1]
        after = np.r_[inside[1:], False] & ~border[1:]
        first, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
        sums = np.r_[np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: len(data)])]
        return first, end, (sums[end] - sums[first]) * self.down[first]

    def scan(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Words, distinct words, capitals, code points and symbols of each text, as columns; text k is data[at[k]:at[k + 1]]."""
        n = len(at) - 1
        inside = lambda mask: np.diff(np.r_[0, np.cumsum(mask[data], dtype=np.int64)][at])
        first, end, hashes = self.words(data, at)
        doc = np.searchsorted(at, first, side="right") - 1
        return np.column_stack([np.bincount(doc, minlength=n), distinct(data, first, end, hashes, doc, n), inside(_CAPITAL), inside(_FIRST), inside(_SYMBOL)])

    def scan_long(self, data: np.ndarray) -> np.ndarray:
        """The same of one long text, piece by piece; pieces end between words, and only the distinct words stay."""
        total, seen, start = np.zeros(5, np.int64), set(), 0
        while start < len(data):
            stop = start + CHUNK
            while stop < len(data) and not _SPACE[data[stop]]:
                stop += 1
            piece = data[start:stop]
            at = np.array([0, len(piece)])
            first, end, hashes = self.words(piece, at)
            total += self.scan(piece, at)[0]
            some = same_as_before(piece, first, end, hashes, np.zeros(len(first), np.int64))[2]
            seen.update(piece[a:b].tobytes() for a, b in zip(first[some], end[some]))
            start = stop
        total[1] = len(seen)
        return total


def same_as_before(data, first, end, hashes, doc) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """In the order of text and hash: the order, whether a word's hash is the one before it though the bytes differ, and the words that begin a run of equal hashes or differ so."""
    order = np.lexsort((hashes, doc))
    a, b = order[:-1], order[1:]
    alike = (doc[a] == doc[b]) & (hashes[a] == hashes[b])
    a, b = a[alike], b[alike]
    n = end[a] - first[a]
    differ = n != end[b] - first[b]
    pairs = np.flatnonzero(~differ)
    step = max(1, CHUNK // 8)
    if len(pairs):  # verified byte by byte, in blocks of pairs whose bytes fit
        upto = np.cumsum(n[pairs])
        for block in np.split(pairs, np.flatnonzero(np.diff(upto // step)) + 1):
            long_ = n[block]
            where = np.repeat(np.cumsum(long_) - long_, long_)
            inner = np.arange(len(where)) - where
            unlike = data[np.repeat(first[a[block]], long_) + inner] != data[np.repeat(first[b[block]], long_) + inner]
            differ[block] = np.add.reduceat(unlike, np.cumsum(long_) - long_) > 0
    wrong = np.zeros(len(order), bool)
    wrong[1:][np.flatnonzero(alike)[differ]] = True
    fresh = np.ones(len(order), bool)
    fresh[1:] = ~alike
    return order, wrong, order[fresh | wrong]


def distinct(data, first, end, hashes, doc, n: int) -> np.ndarray:
    """Distinct words of each of ``n`` texts; where two words share a hash, that text's words are compared as such."""
    order, wrong, some = same_as_before(data, first, end, hashes, doc)
    out = np.bincount(doc[some], minlength=n)
    for k in np.unique(doc[order[wrong]]):
        at = doc == k
        out[k] = len({data[a:b].tobytes() for a, b in zip(first[at], end[at])})
    return out


def text_counts(column: pa.Array, scanner: Scanner) -> np.ndarray:
    """A row of counts for each text of an Arrow column of bytes; null is empty."""
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    at = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    out, k = np.zeros((len(column), 5), np.int64), 0
    while k < len(column):
        stop = max(k + 1, int(np.searchsorted(at, at[k] + CHUNK, side="right")) - 1)
        part = data[at[k] : at[stop]]
        out[k:stop] = scanner.scan_long(part) if len(part) > CHUNK else scanner.scan(part, at[k : stop + 1] - at[k])
        k = stop
    return out


def failed(counts: np.ndarray) -> np.ndarray:
    """The bits of the filters A to D that a text fails."""
    words, kinds, capitals, points, symbols = counts.T
    fails = (words < LEAST_WORDS, 100 * kinds < LEAST_DISTINCT * words, 100 * capitals > MOST_CAPITALS * points, symbols > 0)
    return sum(f.astype(np.int32) << k for k, f in enumerate(fails))


def scan_documents(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``part``, a digest of the text, its five counts and ``fails``, the bits of A to D, of every row."""
    rows = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("text", 256)))
    names = ["n_words", "n_distinct", "n_capitals", "n_points", "n_symbols"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for batch in batches:
            counts = text_counts(batch.column("text"), scanner)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("doc_id", "part", "digest")] + [pa.array(c) for c in counts.T] + [pa.array(failed(counts), pa.int32())], ["doc_id", "part", "digest", *names, "fails"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "part", "digest", "text").mapInArrow(run, f"doc_id {kind}, part string, digest binary, {', '.join(f'{c} long' for c in names)}, fails int")


def with_copies(scanned: DataFrame) -> DataFrame:
    """Adds the bit of E: the text is that of a smaller id.

    The smallest id of each text is found by one aggregation that combines before its shuffle; it is
    joined by text and id together, so a text that very many documents share is no hot key.
    """
    first = scanned.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).where("doc_id IS NOT NULL").withColumn("first", F.lit(True))
    joined = scanned.join(first, ["digest", "doc_id"], "left")
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return joined.withColumn("fails", F.col("fails").bitwiseOR(F.when(copy, 16).otherwise(0))).drop("first")


def steps() -> list[tuple[int, str, int, int, int, int, int, int]]:
    """What one document that fails ``fails`` adds at each step of each order: kept, removed, redundant, only failure, and its share of all orders."""
    out = []
    for fails in range(32):
        for order in permutations(range(5)):
            earlier = 0
            for k, f in enumerate(order):
                bit, name = 1 << f, "".join(FILTERS[x] for x in order)
                hit, gone = bool(fails & bit), bool(fails & earlier)
                earlier |= bit
                # Of the filters that a document fails, each is the first one in equally many of the 120 orders.
                out.append((fails, name, k + 1, int(not fails & earlier), int(hit and not gone), int(hit and gone), int(fails == bit), 120 // fails.bit_count() if hit else 0))
    return out


def audit(marked: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, order of the filters and step, zeros included.

    Documents are counted by part and failed bits first: at most 32 rows a part are joined with the
    steps, a table of 32 x 600 rows whatever the input.
    """
    known = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("bad"))
    counted = marked.select("doc_id", "part", "fails").join(known, "doc_id", "left")
    counted = counted.groupBy("part", "fails").agg(F.count("*").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    table = local_table(marked.sparkSession, steps(), "fails int, filter_order string, step int, s_kept int, s_removed int, s_redundant int, s_only int, s_share int")
    total = lambda flag, n="n": F.sum(F.col(flag) * F.col(n)).cast("long")
    return counted.join(table, "fails").groupBy("part", "filter_order", "step").agg(
        total("s_kept").alias("kept"), total("s_removed").alias("removed"), total("s_redundant").alias("redundant"), total("s_only").alias("unique_fails"),
        total("s_removed", "good").alias("good_lost"), total("s_removed", "bad").alias("toxic_lost"), total("s_share").alias("shapley"),
    )


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``audit`` of ``docs``; the texts are scanned once, and short rows go on from a table in the shared folder."""
    scanned = scratch(scan_documents(docs).select("doc_id", "part", "digest", "fails"), "scanned")
    return audit(with_copies(scanned), labels)
