"""Repeated rows, and the shards that the splitting tree deals."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewire.llm import common, mixture

DOCS = "doc_id bigint, text string, source string"


def plain_mixture(rows, cap=3.0, block_docs=mixture.BLOCK_DOCS, seed=17):
    """Words taken of each (id, text, source), repeats counted one by one: the blocks walked row by row."""
    import hashlib

    size = lambda t: len((t or "").split())
    names = sorted({s for _, _, s in rows}, key=lambda s: (s is None, (s or "").encode()))
    sizes = [sum(size(t) for _, t, s in rows if s == name) for name in names]
    targets = mixture.water_fill(sizes, [1 + i % 3 for i in range(len(names))], cap)
    out = Counter()
    for name, total, target in zip(names, sizes, targets):
        own = [(hashlib.md5(f"{'' if i is None else i}|{seed}|{t or ''}".encode()).hexdigest(), size(t), (i, t, s)) for i, t, s in rows if s == name]
        n_blocks = max(1, -(-len(own) // block_docs))
        full = min(int(target // total), 3) if total else 0
        part = target / total - full if total else 0.0
        blocks = defaultdict(list)
        for h, n, row in own:
            blocks[int(h[:15], 16) % n_blocks].append((h[15:], h, n, row))
        for docs in blocks.values():
            docs.sort(key=lambda d: d[:3])
            words = sum(d[2] for d in docs)
            quota = round(words * part)
            left = words - quota if part > 0.5 else quota
            chosen = []
            for d in docs:
                chosen.append(0 < d[2] <= left)
                left -= d[2] if chosen[-1] else 0
            rest = min(((d[2], i) for i, d in enumerate(docs) if d[2] and not chosen[i]), default=None)
            if rest and rest[0] < 2 * left:
                chosen[rest[1]] = True
            for d, c in zip(docs, chosen):
                out[d[3]] += d[2] * (full + (c != (part > 0.5))) if d[2] else 0
    return out


@pytest.mark.parametrize("hot", [0, 700])
def test_mixture_of_repeats_against_plain_version(spark, hot):
    """A block may hold very many rows of one key and text; as many are taken as if each were walked."""
    rng = np.random.default_rng(hot)
    rows = [(int(i), " ".join(["w"] * int(rng.integers(0, 30))), f"s{int(rng.integers(0, 4))}") for i in range(900)]
    rows += [(5, "one text that repeats", "s1")] * hot + [(None, None, None)] * 3 + [(None, "a b", "s2")] * (hot // 2)
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    got = Counter()
    for r in mixture.mix_sources(df, keep=("doc_id", "text", "source")).collect():
        assert r.taken == r.size * len(r.shards) <= 3 * r.size
        got[(r.doc_id, r.text, r.source)] += r.taken
    want = plain_mixture(rows)
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}


def test_repeats_stay_one_entry_of_their_block(spark):
    plan = mixture.mix_sources(spark.createDataFrame([(1, "a b c", "s")] * 50 + [(2, "d e", "s")], DOCS))
    assert Counter((r.doc_id, r.taken) for r in plan.collect()) == Counter({(1, 3): 50, (2, 2): 1})


def test_each_source_comes_near_its_target(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = mixture.mix_sources(docs, keep=("source",)).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max("size").alias("longest")).collect()
    assert len(got) > 10 and all(abs(r.taken - r.target) <= 0.01 * r.target for r in got)


def test_shards_replay_the_tree(spark):
    """Every (block, pass) unit lies in the shard that the permutation and the tree's quotas give it, whole."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    seed, shards, block_docs = 17, 16, 16
    rows = mixture.mix_sources(docs, keep=("doc_id", "source"), block_docs=block_docs).collect()
    names = sorted({r.source for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    hashes = {r.doc_id: r.h for r in docs.select("doc_id", F.md5(F.concat(F.col("doc_id").cast("string"), F.lit(f"|{seed}|"), F.coalesce("text", F.lit(""))).cast("binary")).alias("h")).collect()}
    units, blocks = [], []
    for name in names:
        own = [r for r in rows if r.source == name]
        blocks.append(max(1, -(-len(own) // block_docs)))
        ratio = own[0].target / own[0].source_size
        units.append(blocks[-1] * (int(ratio) + (ratio - int(ratio) > 1e-12)))
    quotas = mixture.split_units(units, shards, seed)
    assert quotas.sum(axis=1).tolist() == units  # exact quotas of every source
    for i, name in enumerate(names):
        shard_of_number = np.repeat(np.arange(shards), quotas[i])
        step, shift = mixture._step(units[i], seed + i), (seed * 7919 + i) % units[i]
        numbers = [(u * step + shift) % units[i] for u in range(units[i])]
        assert sorted(numbers) == list(range(units[i]))  # disjoint: no unit is drawn twice
        for r in rows:
            if r.source == name:
                block = int(hashes[r.doc_id][:15], 16) % blocks[i]
                assert list(r.shards) == [shard_of_number[numbers[p * blocks[i] + block]] for p in range(len(r.shards))]


def test_units_stay_within_the_sampler(spark, monkeypatch):
    """Beyond the bound blocks grow, and every draw is still hypergeometric."""
    monkeypatch.setattr(mixture, "MOST_UNITS", 64)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    seen = []
    monkeypatch.setattr(mixture, "split_units", lambda units, shards, seed, f=mixture.split_units: seen.append(list(units)) or f(units, shards, seed))
    assert mixture.mix_sources(docs).count() == docs.count()
    assert max(seen[0]) <= 64


def test_row_numbers(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plain = common.numbered(docs.select("doc_id", "text"), "x")
    assert "_metadata" in plain._jdf.queryExecution().analyzed().toString()  # nothing is written
    a, b = (dict(df.select("rid", "doc_id").collect()) for df in (plain, common.numbered(docs.where("doc_id >= 0").select("doc_id"), "x")))
    assert len(a) == docs.count() and {bytes(k): v for k, v in a.items()} == {bytes(k): v for k, v in b.items()}
    for df in (docs.union(docs), docs.select(F.explode(F.split("text", " ")).alias("w")), docs.join(docs.select("doc_id"), "doc_id"), spark.createDataFrame([(1,), (1,)], "a int")):
        out = common.numbered(df, "x")
        assert out.select("rid").distinct().count() == out.count() == df.count()


@pytest.mark.parametrize("bound", [1 << 16, 6])
def test_hot_anchors_keep_all_links(spark, monkeypatch, bound):
    """Anchors that are split give the same components as whole ones, and as comparing all with all."""
    from test_llm_operators import plain_components

    from tidewire.llm import simhash_anchors
    from tidewire.llm.components import connected_components

    monkeypatch.setattr(simhash_anchors, "HOT_ANCHOR", bound)
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**62, 6, dtype=np.uint64)
    fp = np.concatenate([base[rng.integers(0, 6, 500)] ^ (np.uint64(1) << rng.integers(0, 64, 500).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 500).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(32, 64, 500).astype(np.uint64)), (base[0] & np.uint64(0xFFFFFFFF)) | (rng.integers(0, 2**32, 300, dtype=np.uint64) << np.uint64(32))])
    fp = np.unique(fp)
    df = spark.createDataFrame([(int(x),) for x in fp.view(np.int64)], "fp bigint")
    links = simhash_anchors.links_of(df)
    root = {int(x): int(x) for x in fp.view(np.int64)} | dict(connected_components(links).collect())
    want = plain_components([int(x) for x in fp])
    pairs = {(want[int(x)], root[int(np.uint64(x).view(np.int64))]) for x in fp}
    assert len(pairs) == len(set(want.values())) == len(set(root.values())) < len(fp)


def test_shards_query_holds_what_op8_takes(spark, sf_dir):
    """Each repeat of a document has one shard, and shards come near to equal shares of every source's words."""
    from tidewire.llm import queries

    shards = queries.mixture_shards(spark, sf_dir).collect()
    taken = {r.doc_id: r.taken // r.size for r in queries.op8_source_mixture(spark, sf_dir).collect() if r.taken}
    assert Counter(r.doc_id for r in shards) == Counter(taken)
    assert {r.shard for r in shards} <= set(range(16)) and all(r["pass"] < taken[r.doc_id] for r in shards)
    assert sorted((r.doc_id, r["pass"], r.shard, r.place) for r in shards) == sorted((r.doc_id, r["pass"], r.shard, r.place) for r in queries.mixture_shards(spark, sf_dir).collect())


def test_long_words_are_not_kept_and_the_cache_is_bounded(spark, monkeypatch):
    """Distinct long words leave nothing behind; many short ones stay within the bytes that are set."""
    from tidewire.llm import bpe_automaton, queries

    _, vocab, arrays = bpe_automaton.load_automaton(spark, queries.vocabulary_path())
    encoder = bpe_automaton.Encoder(vocab, arrays)
    plain = bpe_automaton.Encoder(vocab, arrays)
    for k in range(5):
        text = f"{'ab' * 2000}{k} short {k}"
        assert list(encoder.encode([text, text])) == [next(plain.encode([text]))] * 2
    assert max(len(w) for w in encoder.cache) <= bpe_automaton.LONG_WORD and encoder.cached < 10_000
    monkeypatch.setattr(bpe_automaton, "CACHE_BYTES", 50_000)
    for k in range(200):
        list(encoder.encode([" ".join(f"w{k}x{i}" for i in range(20))]))
        assert encoder.cached <= 50_000 + 60 * (bpe_automaton._ENTRY + 100)
