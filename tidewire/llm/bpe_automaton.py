"""BPE by a tokenization automaton.

``compile_automaton`` starts from the automaton of single bytes, in which every byte may follow every
other, and applies one merge gadget for each merge (a, b) in order of priority: a new state ab gets
the outgoing arcs of b and the incoming arcs of a, and the arc from a to b goes. A token sequence is
the BPE of its text exactly if the automaton has all its arcs. States with equal outgoing arcs and
labels with equal incoming arcs are merged, which leaves a table of about 20 MB of bits for 50,000
merges. A trie of the labels gives the arcs that match the bytes of a word.

Every prefix of a word has one tokenization, hence one state. ``Encoder`` therefore carries one
state for each byte position, over all new words of a batch at once: from each position it follows
the label trie and takes the arcs that the table has. Decoding emits the labels of the arcs.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Pre-splitting pattern of byte-level BPE: fixed value of the vocabulary's format.
PRE_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words longer than this are encoded one at a time; the cache and the text taken at once are bounded.
LONG_WORD, CACHE_BYTES, CHUNK_CHARS = 64, 64 << 20, 4_000_000
_PAGE = 16


def _byte_of_char() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: printable Latin-1 stays, the rest follows from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_vocabulary(path: str) -> dict:
    """Labels (bytes) by id, merges as id triples in order of priority, and the added tokens."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, to_byte = spec["model"], _byte_of_char()
    vocab = model["vocab"]
    size = max([*vocab.values(), *(t["id"] for t in spec.get("added_tokens", []))]) + 1
    labels = [b""] * size
    for token, i in vocab.items():
        labels[i] = bytes(to_byte[c] for c in token)
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    for text, i in added.items():
        labels[i] = text.encode()
    return {"labels": labels, "merges": [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs], "added": added, "in_model": sorted(vocab.values())}


def compile_automaton(vocab: dict) -> dict:
    """Arrays of the minimized automaton and of the label trie."""
    labels, n = vocab["labels"], len(vocab["labels"])
    # Numbers in order of creation, so that a gadget touches only what exists yet.
    made = {ab for _, _, ab in vocab["merges"]}
    order = [i for i in range(n) if i not in made] + list(dict.fromkeys(ab for _, _, ab in vocab["merges"]))
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    # Bit v & 7 of no_arc[v >> 3, u]: no arc from state u with label v. The last state is the start.
    no_arc = np.zeros(((n + 7) // 8, n + 1), np.uint8)
    for a, b, ab in place[np.array(vocab["merges"], np.int64).reshape(-1, 3)].tolist():
        upto = (ab >> 3) + 1
        out = no_arc[:upto, b].copy()
        no_arc[b >> 3, a] |= np.uint8(1 << (b & 7))
        no_arc[:upto, ab] = out
        into = (no_arc[a >> 3, : ab + 1] >> np.uint8(a & 7)) & np.uint8(1)
        no_arc[ab >> 3, : ab + 1] |= into << np.uint8(ab & 7)
    digest = lambda x: hashlib.blake2b(x, digest_size=16).digest()
    ids: dict[bytes, int] = {}
    state, rows = np.zeros(n + 1, np.int32), []
    for k in range(0, n + 1, 1024):
        for j, row in enumerate(np.ascontiguousarray(no_arc[:, k : k + 1024].T)):
            key = digest(row)
            if key not in ids:
                ids[key] = len(ids)
                rows.append(row.copy())
            state[k + j] = ids[key]
    del no_arc
    states = np.array(rows)
    kinds: dict[bytes, int] = {}
    kind, kept = np.zeros(n, np.int32), []
    for k in range(0, states.shape[1], 128):
        cols = np.unpackbits(states[:, k : k + 128], axis=1, bitorder="little")
        for j, packed in enumerate(np.ascontiguousarray(np.packbits(cols, axis=0).T)[: n - 8 * k]):
            key = digest(packed)
            if key not in kinds:
                kinds[key] = len(kinds)
                kept.append(packed.copy())
            kind[8 * k + j] = kinds[key]
    # By label kind, then state: one bit says that the arc is missing.
    table = np.array(kept)
    state, kind = np.append(state[place], state[n]), kind[place]

    nodes: dict[tuple[int, int], int] = {}
    token_at = [-1]
    for i in vocab["in_model"]:
        at = 0
        for byte in labels[i]:
            nxt = nodes.get((at, byte))
            if nxt is None:
                nxt = nodes[(at, byte)] = len(token_at)
                token_at.append(-1)
            at = nxt
        token_at[at] = i
    arcs = np.array([(at << 8) | byte for at, byte in nodes], np.int64)
    page, inverse = np.unique(arcs // _PAGE, return_inverse=True)
    pages = np.zeros((len(page) + 1, _PAGE), np.int32)
    pages[inverse + 1, arcs % _PAGE] = np.fromiter(nodes.values(), np.int32)
    page_of = np.zeros((len(token_at) << 8) // _PAGE, np.int32)
    page_of[page] = np.arange(1, len(page) + 1)
    return {"state": state, "kind": kind, "table": table, "page_of": page_of, "pages": pages, "token_at": np.array(token_at, np.int32), "length": np.array([len(x) for x in labels], np.int32)}


#: About what an entry of the cache takes beside its texts.
_ENTRY = 300


class Encoder:
    """Encodes texts with a compiled automaton; keeps words of up to LONG_WORD bytes, in CACHE_BYTES at most and one chunk's more."""

    def __init__(self, vocab: dict, arrays: dict):
        import regex

        self.a, self.labels = arrays, vocab["labels"]
        self.names = [str(i) for i in range(len(self.labels))]
        self.split = regex.compile(PRE_SPLIT).findall
        self.added = vocab["added"]
        longest_first = sorted(self.added, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.added else None
        self.cache: dict[str | tuple, tuple[str, bytes]] = {}
        self.cached = 0  # bytes

    def _states(self, words: list[bytes], width: int) -> np.ndarray:
        """For each word (sorted by length, longest first) and position the last token of the prefix."""
        a, m = self.a, len(words)
        lengths = np.fromiter(map(len, words), np.int64, m)
        text = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(m, width).T.astype(np.int64)
        start = len(self.labels)
        last = np.full((width + 1, m), start, np.int32)
        states, kinds, table, pages, page_of, token_at = a["state"], a["kind"], a["table"], a["pages"], a["page_of"], a["token_at"]
        longer = np.searchsorted(-lengths, -np.arange(width), side="left")  # words longer than each position
        for s in range(width):
            alive = np.arange(longer[s])
            node = np.zeros(len(alive), np.int64)
            state = states[last[s, : len(alive)]]
            for e in range(s, width):
                room = int(np.searchsorted(alive, longer[e]))
                alive, node, state = alive[:room], node[:room], state[:room]
                key = (node << 8) | text[e, alive]
                node = pages[page_of[key // _PAGE], key % _PAGE].astype(np.int64)
                on = np.flatnonzero(node)
                if not len(on):
                    break
                alive, node, state = alive[on], node[on], state[on]
                token = token_at[node]
                named = np.flatnonzero(token >= 0)
                token = token[named]
                arc = (table[kinds[token], state[named] >> 3] >> (7 - (state[named] & 7)).astype(np.uint8)) & 1 == 0
                last[e + 1, alive[named[arc]]] = token[arc]
        return last

    def encode_words(self, words: list[str]) -> dict[str, tuple[str, bytes]]:
        """Put new words into the cache; long ones are returned instead, as they hardly come again."""
        long_words: dict[str, tuple[str, bytes]] = {}
        raw = [(w.encode("utf-8"), w) for w in words]
        short = sorted((x for x in raw if len(x[0]) <= LONG_WORD), key=lambda x: -len(x[0]))
        groups = [short[k : k + 20_000] for k in range(0, len(short), 20_000)] + [[x] for x in raw if len(x[0]) > LONG_WORD]
        for group in groups:
            if len(group[0][0]) > LONG_WORD:
                long_words[group[0][1]] = self._named(self._encode_long(group[0][0]))
                continue
            width = len(group[0][0])
            last = self._states([b for b, _ in group], width)
            at = np.fromiter((len(b) for b, _ in group), np.int64, len(group))
            cols, found = np.arange(len(group)), []
            while at.any():
                token = np.where(at > 0, last[at, cols], -1)
                found.append(token)
                at = at - np.where(at > 0, self.a["length"][token], 0)
            for (_, w), ids in zip(group, np.array(found[::-1]).T.tolist()):
                found = self.cache[w] = self._named([i for i in ids if i >= 0])
                self.cached += len(w) + len(found[0]) + len(found[1]) + _ENTRY
        return long_words

    def _encode_long(self, word: bytes) -> list[int]:
        """The same walk for one word; only the positions within a label's length stay in use."""
        a = self.a
        last = [len(self.labels)] + [0] * len(word)
        for s in range(len(word)):
            node, state = 0, int(a["state"][last[s]])
            for e in range(s, len(word)):
                key = (node << 8) | word[e]
                node = int(a["pages"][a["page_of"][key // _PAGE], key % _PAGE])
                if not node:
                    break
                token = int(a["token_at"][node])
                if token >= 0 and not (int(a["table"][a["kind"][token], state >> 3]) >> (7 - (state & 7))) & 1:
                    last[e + 1] = token
        out, at = [], len(word)
        while at:
            out.append(last[at])
            at -= int(a["length"][last[at]])
        return out[::-1]

    def _named(self, ids: list[int]) -> tuple[str, bytes]:
        names, labels = self.names, self.labels
        return ",".join([names[i] for i in ids]), b"".join([labels[i] for i in ids])

    def encode(self, texts: list[str]) -> Iterator[tuple[int, str, bytes]]:
        """Number of tokens, ids joined by commas, and the emitted labels of each text."""
        pieces = []
        for text in texts:
            if self.cut is not None and any(x in text for x in self.added):
                parts = []
                for k, part in enumerate(self.cut.split(text)):
                    parts.extend([(part,)] if k % 2 else self.split(part))
                pieces.append(parts)
            else:
                pieces.append(self.split(text))
        if self.cached > CACHE_BYTES:
            self.cache.clear()
            self.cached = 0
        cache = self.cache
        new = {w for words in pieces for w in words if w not in cache}
        for special in [w for w in new if isinstance(w, tuple)]:
            new.discard(special)
            i = self.added[special[0]]
            cache[special] = (self.names[i], self.labels[i])
        long_words = self.encode_words(list(new))
        for words in pieces:
            got = [cache[w] if w in cache else long_words[w] for w in words] if long_words else [cache[w] for w in words]
            ids = ",".join([g[0] for g in got])
            yield (ids.count(",") + 1 if ids else 0), ids, b"".join([g[1] for g in got])


_compiled: dict[str, tuple[dict, dict]] = {}


def load_automaton(spark: SparkSession, path: str) -> tuple[str, dict, dict]:
    """The vocabulary's digest, the vocabulary and its automaton. Read the vocabulary on the driver and compile it in one task of an executor (about 0.5 GB for a minute at most)."""
    with open(path, "rb") as f:
        key = f"{path}:{hashlib.sha256(f.read()).hexdigest()}"
    if key not in _compiled:
        vocab = read_vocabulary(path)

        def build(_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for name, x in compile_automaton(vocab).items():
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([str(x.dtype)]), pa.array([list(x.shape)], pa.list_(pa.int64())), pa.array([x.tobytes()], pa.binary())], ["name", "type", "shape", "data"])

        rows = spark.range(1).coalesce(1).mapInArrow(build, "name string, type string, shape array<bigint>, data binary").collect()
        _compiled.clear()
        _compiled[key] = (vocab, {r["name"]: np.frombuffer(bytes(r["data"]), r["type"]).reshape(r["shape"]) for r in rows})
    return key, *_compiled[key]


_encoders: dict[str, Encoder] = {}


def encode_decode(df: DataFrame, path: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per input row: the columns of ``keep``, ``n_tokens``, ``ids`` (joined by commas) and ``decoded``.

    Null and empty texts have no tokens; texts of any length are encoded whole. Each row stands
    alone, repeated ones too: no shuffle, bounded caches. Other columns are left out, so clashing names
    do no harm; an empty table gives an empty result.
    """
    name, vocab, arrays = load_automaton(df.sparkSession, path)
    shared = df.sparkSession.sparkContext.broadcast((vocab, arrays))  # fixed by the vocabulary, not by the data

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoders.get(name)  # a reused worker keeps the encoder of a vocabulary
        if encoder is None:
            _encoders.clear()
            encoder = _encoders[name] = Encoder(*shared.value)
        for batch in batches:
            texts = batch.column("t").to_pylist()
            lo = 0
            while lo < len(texts):
                hi, chars = lo, 0
                while hi < len(texts) and (hi == lo or chars + len(texts[hi]) <= CHUNK_CHARS):
                    chars += len(texts[hi])
                    hi += 1
                out = list(encoder.encode(texts[lo:hi]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("k").slice(lo, hi - lo), pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.string()), pa.array([x[2].decode("utf-8", "replace") for x in out], pa.string())],
                    ["k", "n_tokens", "ids", "decoded"],
                )
                lo = hi

    rows = df.select(F.struct(*[F.col(c) for c in keep]).alias("k"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    out = rows.mapInArrow(work, f"k {rows.schema['k'].dataType.simpleString()}, n_tokens bigint, ids string, decoded string")
    return out.select(*[F.col("k")[c].alias(c) for c in keep], "n_tokens", "ids", "decoded")
