"""Approximate nearest neighbours by learned partitions.

Nearness is the inner product, which direction and length decide together. On a bounded sample the
neighbour graph of rows that are alike in both is cut into balanced parts. Two small neural networks
learn from it: one tells the part of a row, by which every row is indexed, the other tells the parts
that hold a query's nearest rows by inner product, from the query's direction. Each query goes to its
several most probable parts, and all rows there are ranked by exact inner products. The number of
parts a query visits is the least that reaches the wanted recall on the sample, and more where these
hold too few rows.
"""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewire.llm.common import hash_sample, scratch

#: Bounds: rows the driver fits on (one in a hundred, within these), fewest parts and rows of a part beyond these.
LEAST_SAMPLE, MOST_SAMPLE, LEAST_PARTS, PART_ROWS = 4096, 16384, 24, 2048
#: Rows of a block that a task compares with a chunk of an eighth as many queries. Blocks grow with the table, so
#: that copying a vector to each chunk stays cheap beside comparing it.
LEAST_BLOCK, MOST_BLOCK = 4096, 65536
GRAPH_NEIGHBOURS = 10


def lengths(x: np.ndarray) -> np.ndarray:
    """Lengths of vectors, also where squares would overflow."""
    most = np.maximum(np.abs(x).max(axis=1, initial=0), 1e-300)
    return most * np.linalg.norm(x / most[:, None], axis=1)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(lengths(x), 1e-300)[:, None]


def likeness(x: np.ndarray, middle: float) -> np.ndarray:
    """Direction and logarithmic length: rows near to each other here have like inner products with any query."""
    return np.column_stack([unit(x), np.log(np.maximum(lengths(x), 1e-300)) - middle])


def neighbour_graph(x: np.ndarray, k: int = GRAPH_NEIGHBOURS, less: np.ndarray | None = None) -> np.ndarray:
    """The ``k`` other rows of the largest inner products, less ``less`` of each (half its square gives the nearest by distance)."""
    near = np.empty((len(x), min(k, max(0, len(x) - 1))), np.int64)
    for lo in range(0, len(x), 512):
        g = x[lo : lo + 512] @ x.T
        if less is not None:
            g -= less
        g[np.arange(len(g)), lo + np.arange(len(g))] = -np.inf
        near[lo : lo + 512] = np.argsort(-g, axis=1, kind="stable")[:, : near.shape[1]]
    return near


def balanced_parts(x: np.ndarray, near: np.ndarray, parts: int, rounds: int = 8, slack: float = 1.1, seed: int = 5) -> np.ndarray:
    """Recursive bisection along principal directions, then moves to the part of most neighbours while it has room."""
    rng, part = np.random.default_rng(seed), np.zeros(len(x), np.int64)

    def halve(rows: np.ndarray, lo: int, hi: int) -> None:
        part[rows] = lo
        if hi - lo < 2 or len(rows) < 2:
            return
        mid = (lo + hi) // 2
        c = x[rows] - x[rows].mean(axis=0)
        v = np.linalg.eigh(c.T @ c)[1][:, -1]
        order = rows[np.argsort(c @ v, kind="stable")]
        cut = len(rows) * (mid - lo) // (hi - lo)
        halve(order[:cut], lo, mid)
        halve(order[cut:], mid, hi)

    halve(np.arange(len(x)), 0, parts)
    links: list[list[int]] = [list(row) for row in near]
    for i, row in enumerate(near):
        for j in row:
            links[j].append(i)
    room, least, load = slack * len(x) / parts + 1, len(x) / parts / slack - 1, np.bincount(part, minlength=parts)
    for _ in range(rounds):
        moved = 0
        for i in rng.permutation(len(x)):
            votes = np.bincount(part[links[i]], minlength=parts)
            best = int(np.argmax(np.where(load + 1 <= room, votes, -1)))
            if votes[best] > votes[part[i]] and load[part[i]] > least:
                load[part[i]] -= 1
                load[best] += 1
                part[i] = best
                moved += 1
        if not moved:
            break
    return part


def train_router(x: np.ndarray, soft: np.ndarray, hidden: int = 64, rounds: int = 40, rate: float = 3e-3, seed: int = 5) -> list[np.ndarray]:
    """One hidden layer, cross-entropy against the parts of a row and its neighbours, Adam."""
    rng = np.random.default_rng(seed)
    w = [rng.normal(0, (2 / x.shape[1]) ** 0.5, (x.shape[1], hidden)), np.zeros(hidden), rng.normal(0, (1 / hidden) ** 0.5, (hidden, soft.shape[1])), np.zeros(soft.shape[1])]
    m, v, t = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
    for _ in range(rounds):
        order = rng.permutation(len(x))
        for lo in range(0, len(x), 128):
            i = order[lo : lo + 128]
            h = np.maximum(x[i] @ w[0] + w[1], 0)
            z = h @ w[2] + w[3]
            p = np.exp(z - z.max(axis=1, keepdims=True))
            d = (p / p.sum(axis=1, keepdims=True) - soft[i]) / len(i)
            dh = (d @ w[2].T) * (h > 0)
            t += 1
            for k, g in enumerate((x[i].T @ dh, dh.sum(axis=0), h.T @ d, d.sum(axis=0))):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                w[k] = w[k] - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    return w


def route(w: list[np.ndarray], x: np.ndarray) -> np.ndarray:
    """Parts by falling probability."""
    return np.argsort(-(np.maximum(x @ w[0] + w[1], 0) @ w[2] + w[3]), axis=1, kind="stable")


def shares(parts: np.ndarray, of: int) -> np.ndarray:
    """For each row of part numbers the share of each part."""
    out = np.zeros((len(parts), of))
    for j in range(parts.shape[1]):
        np.add.at(out, (np.arange(len(parts)), parts[:, j]), 1 / parts.shape[1])
    return out


def least_probes(router: list[np.ndarray], x: np.ndarray, near: np.ndarray, placed: np.ndarray, recall: float) -> int:
    """The fewest parts in which the sample's own queries find ``recall`` of their true neighbours."""
    q = np.linspace(0, len(x) - 1, min(len(x), 1000)).astype(int)
    order = route(router, unit(x[q]))
    rank = np.take_along_axis(np.argsort(order, axis=1), placed[near[q]], axis=1)
    for probes in range(1, order.shape[1] + 1):
        if (rank < probes).mean() >= recall:
            return probes
    return order.shape[1]


def exact_scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products in double precision, summed in component order, so that equal vectors tie exactly."""
    out = np.zeros(len(c))
    with np.errstate(over="ignore", invalid="ignore"):
        for d in range(c.shape[1]):
            out += q[d] * c[:, d]
    return out


def usable(vector: Column, dims: int) -> Column:
    return vector.isNotNull() & (F.size(vector) == dims) & _sound(vector)


def _sound(vector: Column) -> Column:
    return F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vector, lambda x: x != 0)


def nearest_neighbours(df: DataFrame, queries: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20, parts: int | None = None, recall: float = 0.97, sample_rows: int | None = None) -> DataFrame:
    """query_id, rank, id and score of the ``k`` nearest rows found for each row that ``queries`` selects.

    Nearest first by inner product, ties to the smaller id; a query's own id is no candidate, and a
    query gets ``k`` rows wherever the table has as many. Vectors that are null, zero, of another
    length than most, or hold null or non-finite components take no part, nor do null ids. Repeated
    rows (equal ids) are one row, with the vector that sorts first. Other columns are not read, so
    clashing names do no harm. Every usable row is indexed. Unless given, parts grow with the rows, up
    to one for 64 rows of the sample. Parts of any size are compared in blocks of bounded size. An empty
    table gives an empty result.
    """
    spark = df.sparkSession
    vec = F.transform(F.col(vector_col).cast("array<double>"), lambda x: x)
    rows = df.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).groupBy(F.col(id_col).cast("bigint").alias("id")).agg(F.min(vec).alias("v"), F.max(queries.cast("boolean")).alias("asks"))
    rows = scratch(rows.where((F.size("v") > 0) & _sound(F.col("v"))), "vectors")
    sizes = rows.groupBy(F.size("v").alias("dims")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dims").limit(1).collect()
    out_schema = "query_id bigint, rank int, vec_id bigint, score double"
    if not sizes:
        return spark.createDataFrame([], out_schema)
    dims, total = sizes[0]["dims"], sizes[0]["n"]
    rows = rows.where(F.size("v") == dims)
    sample_rows = sample_rows or min(MOST_SAMPLE, max(LEAST_SAMPLE, total // 100))
    x = np.array([r["v"] for r in hash_sample(rows, "id", sample_rows, total).collect()], float).reshape(-1, dims)
    parts = max(1, min(parts or max(LEAST_PARTS, total // PART_ROWS), len(x) // 64))
    middle = float(np.median(np.log(np.maximum(lengths(x), 1e-300))))
    alike = likeness(x, middle)
    graph = neighbour_graph(alike, less=(alike**2).sum(axis=1) / 2)
    part = balanced_parts(alike, graph, parts)
    placer = train_router(alike, 0.5 * np.eye(parts)[part] + 0.5 * (shares(part[graph], parts) if graph.shape[1] else np.eye(parts)[part]))
    placed_in = route(placer, alike)[:, 0]
    scale = lengths(x).max()
    nearest = neighbour_graph(x / scale, k)
    router = train_router(unit(x), shares(placed_in[nearest], parts)) if nearest.shape[1] else train_router(unit(x), np.eye(parts)[part])
    probes = least_probes(router, x, nearest, placed_in, recall) if nearest.shape[1] else 1

    def place(batches):
        for b in batches:
            v = np.array(b.column("v").to_pylist(), float).reshape(b.num_rows, dims)
            own = route(placer, likeness(v, middle))[:, 0].astype(np.int32)
            visits = [r if asks else None for r, asks in zip(route(router, unit(v)).astype(np.int32), b.column("asks").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("asks"), pa.array([r.tobytes() for r in v], pa.binary()), pa.array(own), pa.array(visits, pa.list_(pa.int32()))], ["id", "asks", "v", "part", "visits"])

    placed = scratch(rows.mapInArrow(place, "id bigint, asks boolean, v binary, part int, visits array<int>"), "placed")
    by_part = lambda df: {r["part"]: r["n"] for r in df.groupBy("part").agg(F.count("*").alias("n")).collect()}  # noqa: E731  one row a part
    rows_in = by_part(placed)
    held = F.from_json(F.lit(json.dumps([rows_in.get(p, 0) for p in range(parts)])), "array<bigint>")
    # A query's own row may be among those held, so one more than k are looked for.
    enough = F.aggregate(
        "visits", F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("rows")),
        lambda a, p: F.when((a["n"] >= probes) & (a["rows"] > k), a).otherwise(F.struct((a["n"] + 1).alias("n"), (a["rows"] + F.get(held, p)).alias("rows"))),
        lambda a: a["n"],
    )
    asked = placed.where("asks").select("id", "v", F.explode(F.slice("visits", 1, enough)).alias("part"))
    asked_of = by_part(asked)
    block_rows = min(MOST_BLOCK, max(LEAST_BLOCK, total // LEAST_BLOCK))
    blocks = [max(1, -(-rows_in.get(p, 0) // block_rows)) for p in range(parts)]
    chunks = [max(1, -(-asked_of.get(p, 0) // (block_rows // 8))) for p in range(parts)]
    n_blocks, n_chunks = (F.from_json(F.lit(json.dumps(n)), "array<int>") for n in (blocks, chunks))
    cands = placed.select("id", "v", "part", F.pmod(F.xxhash64("id"), F.get(n_blocks, "part")).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.get(n_chunks, "part") - 1)).alias("chunk"))
    asked = asked.select("id", "v", "part", F.explode(F.sequence(F.lit(0), F.get(n_blocks, "part") - 1)).alias("block"), F.pmod(F.xxhash64("id", F.lit(1)), F.get(n_chunks, "part")).cast("int").alias("chunk"))
    keys = ["part", "block", "chunk"]

    def compare(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(c):
            return pd.DataFrame({"query_id": np.array([], np.int64), "vec_id": np.array([], np.int64), "score": np.array([], float)})
        c = c.sort_values("id")
        ids, cv = c["id"].to_numpy(), np.frombuffer(b"".join(c["v"]), float).reshape(-1, dims)
        qids, qv = q["id"].to_numpy(), np.frombuffer(b"".join(q["v"]), float).reshape(-1, dims)
        scaled, out = cv / lengths(cv).max(), []  # so that no product overflows before the exact one
        for lo in range(0, len(qids), 256):
            g = unit(qv[lo : lo + 256]) @ scaled.T
            for i, row in enumerate(g, lo):
                row[ids == qids[i]] = -np.inf
                at = np.flatnonzero(row >= np.partition(row, -k)[-k] - 1e-12) if len(row) > k else np.arange(len(row))
                at = at[row[at] > -np.inf]
                exact = exact_scores(qv[i], cv[at])
                best = np.lexsort((ids[at], -exact))[:k]
                out.append((np.full(len(best), qids[i]), ids[at][best], exact[best]))
        return pd.DataFrame({"query_id": np.concatenate([o[0] for o in out]), "vec_id": np.concatenate([o[1] for o in out]), "score": np.concatenate([o[2] for o in out])})

    found = asked.groupBy(*keys).cogroup(cands.groupBy(*keys)).applyInPandas(compare, "query_id bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
