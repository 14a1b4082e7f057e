"""Mixing sources to target weights: exact quotas dealt to shards by a multivariate-hypergeometric tree.

1. Targets: each source's weight times one level, capped at ``cap`` times its size (water filling).
2. Documents hash into blocks of bounded size within their source; rows that repeat key and text are
   one entry of a block, with their number. The mix takes whole passes over all blocks, and a last
   pass that takes part of each block up to the block's exact quota.
3. A binary tree over the output shards splits every source's number of (block, pass) units: each
   node's left half gets a multivariate-hypergeometric draw of what the node holds, so that every
   shard has an exact quota of units of every source and shards differ as random draws do.
4. A source's units are permuted, consecutive ranges of the permuted units fill its shard quotas
   (disjoint by construction), and rows are put in random order within their shard.

Spark runs built-in functions only; the driver plans with one row of totals per source.
"""

from __future__ import annotations

import json
import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewire.llm.common import SPACES, scratch, words

#: Documents of a block, and most (block, pass) units, which keep to the arguments of the hypergeometric
#: sampler: beyond about a hundred billion documents blocks grow instead.
BLOCK_DOCS, MOST_UNITS = 256, 1 << 29


def water_fill(sizes: list[int], weights: list[float], cap: float = 3.0) -> list[float]:
    """Shares of ``sum(sizes)`` by weight, none above ``cap`` times its size; the excess is reshared."""
    left, open_ = float(sum(sizes)), [i for i, s in enumerate(sizes) if s > 0]
    out = [0.0] * len(sizes)
    while open_:
        level = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if weights[i] * level > cap * sizes[i]]
        if not full:
            for i in open_:
                out[i] = weights[i] * level
            break
        for i in full:
            out[i] = cap * sizes[i]
            left -= out[i]
        open_ = [i for i in open_ if i not in set(full)]
    return out


def split_units(units: list[int], shards: int, seed: int) -> np.ndarray:
    """Units of each source (rows) for each shard (columns); every split is one multivariate draw."""
    rng = np.random.default_rng(seed)
    out = np.zeros((len(units), shards), np.int64)

    def draw(have: np.ndarray, take: int) -> np.ndarray:
        got, rest = np.zeros_like(have), int(have.sum())
        for i, n in enumerate(have):
            n, rest = int(n), rest - int(n)
            if take and n:
                got[i] = rng.hypergeometric(n, rest, take)
                take -= int(got[i])
        return got

    def split(have: np.ndarray, lo: int, hi: int) -> None:
        if hi - lo == 1:
            out[:, lo] = have
            return
        mid = (lo + hi) // 2
        left = draw(have, int(have.sum()) * (mid - lo) // (hi - lo))
        split(left, lo, mid)
        split(have - left, mid, hi)

    split(np.array(units, np.int64), 0, shards)
    return out


def _step(units: int, seed: int) -> int:
    s = max(1, (seed * 2654435761 + 40503) % max(1, min(units, 2**31)))
    while math.gcd(s, max(1, units)) != 1:
        s += 1
    return s


def mix_sources(df: DataFrame, text_col: str = "text", source_col: str = "source", key_col: str = "doc_id", keep: tuple[str, ...] = ("doc_id",), weights: tuple[float, ...] = (1, 2, 3), cap: float = 3.0, shards: int = 16, seed: int = 17, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """One row per input row: ``size`` (words), ``source_size``, ``target``, ``taken`` and ``shards``,
    the output shard of every repeat, with ``place``, a random order within shards.

    Sources by code point, null last, get the weights in turn. A document is taken whole, at most
    ``ceil(cap)`` times. Empty and null texts have size 0 and are never taken; texts of any length
    count whole. Rows with equal keys are told apart by their text; of exact repeats as many are taken
    as the block's quota holds, one like the other. Reruns agree as all choices come from the MD5 of
    key and text. Other columns are left out unless ``keep`` asks for them. An empty table gives an
    empty result.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    n_words = F.when(F.btrim(text, F.lit(SPACES)) == "", F.lit(0)).otherwise(F.size(words(text))).cast("long")
    sized = scratch(
        df.select(
            F.struct(*[F.col(c) for c in keep]).alias("k"), F.col(source_col).cast("string").alias("src"), n_words.alias("size"),
            F.md5(F.concat(F.coalesce(F.col(key_col).cast("string"), F.lit("")), F.lit(f"|{seed}|"), text).cast("binary")).alias("hash"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "sized",
    )
    entries = scratch(sized.groupBy("src", "hash").agg(F.min("size").alias("size"), F.count("*").alias("m")), "entries")
    totals = entries.groupBy("src").agg(F.sum(F.col("size") * F.col("m")).alias("size"), F.sum("m").alias("n")).collect()  # one row a source
    totals.sort(key=lambda r: (r["src"] is None, (r["src"] or "").encode()))
    sizes = [int(r["size"]) for r in totals]
    targets = water_fill(sizes, [weights[i % len(weights)] for i in range(len(sizes))], cap)
    block_docs = max(block_docs, -(-sum(int(r["n"]) for r in totals) * math.ceil(cap) // MOST_UNITS))
    blocks = [max(1, -(-int(r["n"]) // block_docs)) for r in totals]
    full = [min(int(t // s), math.floor(cap)) if s else 0 for t, s in zip(targets, sizes)]
    part = [t / s - f if s else 0.0 for t, s, f in zip(targets, sizes, full)]
    passes = [f + (p > 1e-12) for f, p in zip(full, part)]
    units = [b * p for b, p in zip(blocks, passes)]
    dealt = split_units(units, shards, seed) if units else np.zeros((0, shards), np.int64)
    plan = [
        {"psrc": r["src"], "source_size": sizes[i], "target": targets[i], "blocks": blocks[i], "full": full[i], "part": part[i], "units": max(1, units[i]), "step": _step(units[i], seed + i), "shift": (seed * 7919 + i) % max(1, units[i]), "ends": np.cumsum(dealt[i]).tolist()}
        for i, r in enumerate(totals)
    ]
    schema = "array<struct<psrc:string,source_size:bigint,target:double,blocks:bigint,full:int,part:double,units:bigint,step:bigint,shift:bigint,ends:array<bigint>>>"
    plans = F.broadcast(df.sparkSession.range(1).select(F.inline(F.from_json(F.lit(json.dumps(plan)), schema))))
    # One row a source, as many as the driver has just gathered.
    same = F.col("src").eqNullSafe(F.col("psrc"))
    blocked = entries.join(plans.select("psrc", "blocks"), same).withColumn("block", F.conv(F.substring("hash", 1, 15), 16, 10).cast("long") % F.col("blocks"))
    grouped = blocked.groupBy("src", "block").agg(
        F.sum(F.col("size") * F.col("m")).alias("words"), F.collect_list(F.struct(F.substring("hash", 16, 17).alias("order"), "hash", "size", "m")).alias("docs")
    ).join(plans.select("psrc", "part"), same)
    # First fit in random order: a document is taken when what is left of the block's quota holds it.
    # Then the smallest one left over is taken too, if that comes nearer to the quota. Where the quota
    # is over half of the block, the same fit chooses what to leave out.
    words_in, inverse = F.round(F.col("words") * F.col("part")).cast("long"), F.col("part") > 0.5
    grouped = grouped.withColumn("docs", F.array_sort("docs")).withColumn("inverse", inverse).withColumn("quota", F.when(inverse, F.col("words") - words_in).otherwise(words_in))
    fits = lambda a, x: F.when(x["size"] > 0, F.least(x["m"], F.floor(a["left"] / F.greatest(x["size"], F.lit(1))).cast("long"))).otherwise(F.lit(0).cast("long"))
    picked = F.aggregate(
        "docs",
        F.struct(F.col("quota").alias("left"), F.array().cast("array<bigint>").alias("in")),
        lambda a, x: F.struct((a["left"] - x["size"] * fits(a, x)).alias("left"), F.array_append(a["in"], fits(a, x)).alias("in")),
    )
    fitted = grouped.withColumn("fit", picked)
    smallest = F.array_min(F.transform("docs", lambda x, i: F.when((x["size"] > 0) & (F.get("fit.in", i) < x["m"]), F.struct(x["size"].alias("size"), i.alias("i")))))
    fitted = fitted.withColumn("smallest", smallest).withColumn("more", F.when(F.col("smallest.size") < 2 * F.col("fit.left"), F.col("smallest.i")).otherwise(-1))
    chosen = lambda i: F.get("fit.in", i) + (i == F.col("more")).cast("long")
    placed = scratch(
        fitted.select(
            F.col("src").alias("esrc"), "block",
            F.inline(F.transform("docs", lambda x, i: F.struct(x["hash"].alias("ehash"), x["m"].alias("m"), F.when(F.col("inverse"), x["m"] - chosen(i)).otherwise(chosen(i)).alias("some")))),
        ),
        "placed",
    )
    # Plain scans on both sides: repeats of one row may fill a third of the table.
    rows = sized.join(placed, (sized["hash"] == placed["ehash"]) & sized["src"].eqNullSafe(placed["esrc"])).drop("ehash", "esrc")
    out_of = (F.col("some") > 0) & (F.col("some") < F.col("m"))
    split = rows.where(out_of).withColumn("task", F.shiftright("row", 33))
    counts = split.groupBy("src", "hash", "task").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("src", "hash").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select(F.col("src").alias("csrc"), F.col("hash").alias("chash"), F.col("task").alias("ctask"), before.alias("before"))
    # Repeats of which some are taken are numbered within the task that wrote them, after those of the tasks before.
    ranked = split.join(starts, (F.col("hash") == F.col("chash")) & (F.col("task") == F.col("ctask")) & F.col("src").eqNullSafe(F.col("csrc")))
    number = F.col("before") + F.row_number().over(Window.partitionBy("src", "hash", "task").orderBy("row"))
    columns = ["k", "src", "size", "hash", "block"]
    named = rows.where(~out_of).select(*columns, (F.col("some") > 0).alias("in")).unionByName(ranked.select(*columns, (number <= F.col("some")).alias("in")))
    times = F.when(F.col("size") > 0, F.col("full") + F.col("in").cast("int")).otherwise(0)
    # Pass p of block b is unit p * blocks + b; its permuted number lies in one shard's range.
    shard_of = lambda p: F.size(F.filter("ends", lambda e: e <= (((p.cast("long") * F.col("blocks") + F.col("block")) * F.col("step") + F.col("shift")) % F.col("units")))).cast("int")
    dealt_to = F.when(times > 0, F.transform(F.sequence(F.lit(0), times - 1), shard_of)).otherwise(F.array().cast("array<int>"))
    out = named.join(plans, same).select(
        F.struct(
            *[F.col("k")[c].alias(c) for c in keep], "size", "source_size", "target",
            (F.col("size") * times).cast("long").alias("taken"), dealt_to.alias("shards"), F.xxhash64("hash", F.lit(seed + 2)).alias("place"),
        ).alias("row")
    )
    return out.select(F.inline(F.array("row")))
