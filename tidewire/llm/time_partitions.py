"""A table as files that follow its rows in time: dense hours are cut into parts, sparse years share a file.

``rewrite`` lays rows out in a folder, one Parquet file for each part of each leaf of a time tree, and
leaves alone the files that are there already with the same rows. No file has more than ``limit`` rows.

* Rows are counted by hour in one aggregation. The driver asks that table for years, for months of the
  years above the limit, then for days and hours: with ``limit`` = 1 + rows / ``PARTS`` fewer than ``PARTS``
  nodes of a level are above it, so what it sees has a bound that doesn't grow with the rows.
* Only single hours above the limit, and the rows without a time, have several parts. The sort key at every
  multiple of the limit is found by radix selection: the rows of these leaves are counted by the next digit
  of the key, the digit in which each wanted rank falls is chosen, and only the rows of that digit are
  counted further, till they are few enough to be sorted at once. Each round joins the rows with what is decided, so that
  plans don't grow with the rounds. Keys end with the content and then the place of a row, so that even repeated rows
  have an order of their own: ties are cut exactly, and nothing is ranked by a window.
* A row finds its file by binary search in the boundaries, at most about 5 x ``PARTS`` of them. One shuffle
  brings the rows of the changed files together, where they are sorted and written.

Null order columns come first in a file, a null time has its own leaf. Repeated rows are each kept.
Columns may have any names; those in ``order`` are whole numbers or timestamps. A folder without rows has
no files. An empty table gives no rows.
"""

from __future__ import annotations

import calendar
import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType, TimestampNTZType, TimestampType

from tidewire.llm.common import drop_scratch, local_table, placed, scratch, scratch_root

#: The limit is 1 + rows / PARTS: the fixed value of the contract.
PARTS = 500
SECOND = 1_000_000
HOUR, DAY = 3600 * SECOND, 86400 * SECOND
#: Bits of the key that one round of the selection decides.
DIGIT = 16
#: So many rows at most, as a node has digits, are sorted instead of counted further.
FEW = 2**DIGIT
_SIGN = -(2**63)


def micros(ts: Column) -> Column:
    """Microseconds since 1970 on the clock that the timestamp shows, whatever the session's zone."""
    seconds = F.hour(ts) * 3600 + F.minute(ts) * 60
    return F.unix_date(F.to_date(ts)).cast("long") * DAY + seconds.cast("long") * SECOND + (F.date_part(F.lit("SECOND"), ts) * SECOND).cast("long")


def _whole(at: Column, unit: int) -> Column:
    """How many whole units lie before a moment; exact, as only multiples are divided."""
    return ((at - F.pmod(at, F.lit(unit))) / unit).cast("long")


def click_moment(ts: Column, click_id: Column) -> Column:
    """The contract's time of a click: some go back by whole days, some to the beginning of their week."""
    k, at = F.crc32(click_id.cast("string").cast("binary")) % 128, micros(ts)
    day = _whole(at, DAY)
    monday = (day - F.pmod(day + 3, F.lit(7))) * DAY  # day 0 was a Thursday
    return F.when(k < 16, at - (k + 6) * (k + 6) * (k + 6) * DAY).when(k > 111, monday).otherwise(at)


# ---- the tree of time

@dataclass(frozen=True)
class Leaf:
    name: str
    first: int  # hours since 1970; the null leaf has none
    n: int


def _hour(year: int, month: int = 1, day: int = 1, hour: int = 0) -> int:
    return (date(year, month, day).toordinal() - date(1970, 1, 1).toordinal()) * 24 + hour


def runs(siblings: list[tuple[int, int]], limit: int) -> tuple[list[tuple[int, int, int]], list[int]]:
    """Runs (first, last, rows) of neighbouring siblings that stay within the limit, and the siblings above it."""
    out, above, open_ = [], [], False
    for member, n in siblings:
        if n > limit:
            above.append(member)
            open_ = False
        elif open_ and out[-1][2] + n <= limit:
            out[-1] = (out[-1][0], member, out[-1][2] + n)
        else:
            out.append((member, member, n))
            open_ = True
    return [r for r in out if r[2]], above


def time_leaves(hours: DataFrame, limit: int) -> list[Leaf]:
    """The leaves of ``hours`` (hour, n), in time order; the rows without a time last."""
    day = F.date_from_unix_date(F.floor(F.col("hour") / 24).cast("int"))
    units = hours.where("hour IS NOT NULL").select(F.year(day).alias("y"), F.month(day).alias("m"), F.day(day).alias("d"), F.pmod("hour", F.lit(24)).cast("int").alias("h"), "n")

    def below(parents: list[tuple[int, ...]], depth: int) -> dict[tuple[int, ...], dict[int, int]]:
        names = ["y", "m", "d", "h"][: depth + 1]
        chosen = units
        if depth:
            wanted = local_table(hours.sparkSession, parents, ", ".join(f"{c} int" for c in names[:-1]))
            chosen = units.join(wanted, names[:-1])
        found: dict[tuple[int, ...], dict[int, int]] = {p: {} for p in parents}
        for *parent, member, n in chosen.groupBy(*names).agg(F.sum("n")).collect():
            found[tuple(parent)][member] = n
        return found

    out, parents = [], [()]
    for depth in range(4):
        if not parents:
            break
        deeper = []
        for parent, counts in sorted(below(parents, depth).items()):
            if not counts:
                continue
            members = (range(min(counts), max(counts) + 1), range(1, 13), range(1, calendar.monthrange(*parent)[1] + 1 if depth == 2 else 1), range(24))[depth]
            joined, above = runs([(k, counts.get(k, 0)) for k in members], limit)
            if depth == 3:
                joined, above = joined + [(k, k, counts[k]) for k in above], []
            deeper += [(*parent, k) for k in above]
            width = 2 if depth else 4
            path = "".join(f"{p:0{2 if i else 4}d}/" for i, p in enumerate(parent))
            out += [Leaf(f"{path}{a:0{width}d}-{b:0{width}d}", _hour(*parent, a), n) for a, b, n in joined]
        parents = deeper
    out.sort(key=lambda leaf: leaf.first)
    unknown = hours.where("hour IS NULL").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return out + ([Leaf("null", 0, unknown)] if unknown else [])


# ---- exact boundaries by radix selection

def with_keys(rows: DataFrame, moment: Column, order: tuple[str, ...]) -> tuple[DataFrame, list[str]]:
    """``row``, ``hour`` and the parts of the sort key, none of them null: time in the hour, the order columns, content, place."""
    columns = [F.col(f"`{c}`") for c in rows.columns]
    stamps = {f.name: isinstance(f.dataType, (TimestampType, TimestampNTZType)) for f in rows.schema.fields}
    content = F.xxhash64(*[x for c in columns for x in (c, c.isNull())])
    parts = {"hour": _whole(moment, HOUR), "key0": F.coalesce(F.pmod(moment, F.lit(HOUR)), F.lit(0)).cast("long")}
    for c in order:
        value = micros(F.col(f"`{c}`")) if stamps[c] else F.col(f"`{c}`").cast("long")
        parts |= {f"key{len(parts) - 1}": value.isNotNull().cast("long")}
        parts |= {f"key{len(parts) - 1}": F.coalesce(value, F.lit(0)).cast("long")}
    parts |= {f"key{len(parts) - 1}": content}
    keyed = placed(rows.select(F.struct(*columns).alias("row"), *[v.alias(k) for k, v in parts.items()]), "laid")
    n = len(parts) - 1
    return keyed.withColumnsRenamed({"at_file": f"key{n}", "at_row": f"key{n + 1}"}), [f"key{k}" for k in range(n + 2)]


def _unsigned(x: int) -> int:
    return x - _SIGN


def boundaries(keyed: DataFrame, keys: list[str], leaves: list[Leaf], limit: int, few: int = FEW) -> dict[int, list[tuple[int, ...]]]:
    """For each leaf above the limit the largest key of every part but the last, as unsigned numbers.

    A boundary that falls on the end of a digit needs no further digits: its key is filled up with ones. Once at most
    ``few`` rows are left among which boundaries are looked for, they are sorted.
    """
    big = [(k, leaf) for k, leaf in enumerate(leaves) if leaf.n > limit]
    if not big:
        return {}
    spark = keyed.sparkSession
    nodes = local_table(spark, [(k, None if leaf.name == "null" else leaf.first) for k, leaf in big], "node int, at long")
    rows = keyed.join(nodes, F.col("hour").eqNullSafe(F.col("at"))).select("node", *keys)
    out: dict[int, list[tuple[int, ...]]] = {k: [] for k, _ in big}
    # Of each node: its leaf, the key as far as it is decided, and the ranks that are looked for among its rows.
    open_: dict[int, tuple[int, tuple[int, ...], int, list[int]]] = {k: (k, (), 0, list(range(limit, leaf.n, limit))) for k, leaf in big}

    def wanted() -> DataFrame:
        return local_table(spark, [(node, r) for node, (*_, ranks) in open_.items() for r in ranks], "node int, rank long")

    def sort(left: DataFrame) -> None:
        ranked = left.withColumn("rank", F.row_number().over(Window.partitionBy("node").orderBy(*keys)).cast("long"))  # of few rows
        for node, *key in ranked.join(wanted(), ["node", "rank"]).select("node", *keys).collect():
            out[open_[node][0]].append(tuple(map(_unsigned, key)))

    if sum(leaf.n for _, leaf in big) <= few:
        sort(rows)
        return {k: sorted(v) for k, v in out.items()}
    rows = scratch(rows, "keys")
    spread = [_unsigned(x) for x in rows.agg(*[f(c) for c in keys for f in (F.min, F.max)]).first()]
    varied = [i for i in range(len(keys)) if spread[2 * i] != spread[2 * i + 1]]

    def held(i: int, bits: int) -> DataFrame:
        """The rows of the open nodes, of whose keys the ``i`` first are decided and of the next all but ``bits`` bits: one join, however many digits were read."""
        before = [j for j in varied if j < i]
        found = [(leaf, node, *[done[j] + _SIGN for j in before], (x := stem >> bits) - (x >> 63 << 64)) for node, (leaf, done, stem, _) in open_.items()]
        table = local_table(spark, found, "node int, child int, " + "".join(f"{keys[j]} long, " for j in before) + "top long")
        top = F.shiftrightunsigned(F.col(keys[i]).bitwiseXOR(F.lit(_SIGN)), bits) if bits < 64 else F.lit(0).cast("long")
        return rows.withColumn("top", top).join(table, ["node", *[keys[j] for j in before], "top"]).select(F.col("child").alias("node"), *keys)

    for i, c in enumerate(keys):
        if not open_:
            break
        low, high = spread[2 * i], spread[2 * i + 1]
        bits = (low ^ high).bit_length()
        stem = low >> bits << bits
        open_ = {node: (leaf, done, stem, ranks) for node, (leaf, done, _, ranks) in open_.items()}
        while bits and open_:
            left = held(i, bits)
            step = min(DIGIT, bits)
            bits -= step
            digit = F.shiftrightunsigned(F.col(c).bitwiseXOR(F.lit(_SIGN)), bits).bitwiseAND(2**step - 1).cast("int")
            counts = left.groupBy("node", digit.alias("digit")).agg(F.count("*").alias("n"))
            upto = counts.withColumn("upto", F.sum("n").over(Window.partitionBy("node").orderBy("digit")))  # over digits, not rows
            hits = upto.join(wanted(), "node").where("rank <= upto AND rank > upto - n").collect()
            found: dict[tuple[int, int], list[int]] = {}
            among: dict[tuple[int, int], int] = {}
            for r in hits:
                leaf, done, stem_, _ = open_[r["node"]]
                inside = r["rank"] - (r["upto"] - r["n"])
                if inside == r["n"]:
                    out[leaf].append((*done, stem_ | r["digit"] << bits | (1 << bits) - 1, *[2**64 - 1] * (len(keys) - len(done) - 1)))
                else:
                    found.setdefault((r["node"], r["digit"]), []).append(inside)
                    among[r["node"], r["digit"]] = r["n"]
            open_ = {k: (open_[node][0], open_[node][1], open_[node][2] | digit << bits, sorted(ranks)) for k, ((node, digit), ranks) in enumerate(sorted(found.items()))}
            if open_ and sum(among.values()) <= few:
                sort(held(i, bits))
                open_ = {}
        open_ = {node: (leaf, (*done, stem), 0, ranks) for node, (leaf, done, stem, ranks) in open_.items()}
    if open_:
        raise ValueError("rows share content and place")
    drop_scratch(rows)
    return {k: sorted(v) for k, v in out.items()}


def _sortable(columns: list[np.ndarray]) -> np.ndarray:
    """Rows of unsigned numbers as byte strings that sort like them."""
    table = np.column_stack(columns).astype(">u8")
    return np.ascontiguousarray(table).view(f"S{8 * len(columns)}").ravel()


def file_numbers(keyed: DataFrame, keys: list[str], leaves: list[Leaf], bounds: dict[int, list[tuple[int, ...]]]) -> tuple[DataFrame, list[tuple[str, int]]]:
    """``keyed`` with ``file``, found by binary search, and the (leaf, part) of every file number."""
    files, base = [], []
    for k, leaf in enumerate(leaves):
        base.append(len(files))
        files += [(leaf.name, part + 1) for part in range(len(bounds.get(k, ())) + 1)]
    timed = [leaf.first for leaf in leaves if leaf.name != "null"]
    cut = {k: np.array([b"".join(x.to_bytes(8, "big") for x in key) for key in v], f"S{8 * len(keys)}") for k, v in bounds.items()}

    @F.pandas_udf("int")
    def number(hour: pd.Series, *key: pd.Series) -> pd.Series:
        known = hour.notna().to_numpy()
        leaf = np.full(len(hour), len(timed))
        leaf[known] = np.searchsorted(np.array(timed), hour[known].to_numpy(np.int64), side="right") - 1
        out = np.array(base, np.int64)[leaf]
        for k, ends in cut.items():
            at = np.flatnonzero(leaf == k)
            if len(at):
                unsigned = [x.to_numpy(np.int64)[at].astype(np.uint64) ^ np.uint64(1 << 63) for x in key]
                out[at] += np.searchsorted(ends, _sortable(unsigned), side="left")
        return pd.Series(out.astype(np.int32))

    return keyed.withColumn("file", number("hour", *keys)), files


# ---- files

def _digest(content: Column) -> list[Column]:
    """What tells whether a file's rows recur: their number, and sums of their contents' hashes."""
    return [F.count("*").alias("n"), F.bit_xor(content).alias("x"), F.sum(content.bitwiseAND(2**32 - 1)).alias("lo"), F.sum(F.shiftrightunsigned(content, 32)).alias("hi")]


def _path(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI.create(path))
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _column(rows: DataFrame) -> str:
    """A name for the folders of files that no column of the rows has."""
    taken, name = {c.lower() for c in rows.columns}, "file"
    while name in taken:
        name += "_"
    return name


def _folder_name(leaf: str, part: int) -> str:
    return f"{leaf.replace('/', '_')}.{part}"


def read_files(rows: DataFrame, folder: str) -> DataFrame | None:
    """The rows of ``folder`` as files of the columns of ``rows``, with the column of ``_column``; None if there are none."""
    spark = rows.sparkSession
    fs, at = _path(spark, folder)
    if not fs.exists(at) or not any(x.isDirectory() for x in fs.listStatus(at)):
        return None
    return spark.read.schema(StructType([*rows.schema.fields]).add(_column(rows), StringType())).parquet(folder)


def _paths(stored: DataFrame | None, name: str) -> dict[str, str]:
    return {} if stored is None else {r[1]: r[0] for r in stored.select(F.col("_metadata.file_path").alias("p"), name).distinct().collect()}


def rewrite(rows: DataFrame, folder: str, limit: int, moment: Column, order: tuple[str, ...]) -> list[tuple[str, int, str, bool]]:
    """Lay ``rows`` out in ``folder``; (leaf, part, path, rewritten) of every file.

    Files of the folder whose leaf, part and rows are the same stay. New files are there before old ones go.
    """
    spark, name = rows.sparkSession, _column(rows)
    keyed, keys = with_keys(rows, moment, order)
    content = keys[-3]
    hours = scratch(keyed.groupBy("hour").agg(F.count("*").alias("n")), "hours")
    leaves = time_leaves(hours, limit)
    drop_scratch(hours)
    bounds = boundaries(keyed, keys, leaves, limit)
    routed, files = file_numbers(keyed, keys, leaves, bounds)
    planned = {_folder_name(*files[r["file"]]): (files[r["file"]], tuple(r)[1:], r["file"]) for r in routed.groupBy("file").agg(*_digest(F.col(content))).collect()}
    if any(n > limit for _, (n, *_), _ in planned.values()):
        raise ValueError("a file is above the limit")
    stored = read_files(rows, folder)
    before, same = _paths(stored, name), set()
    if before:
        columns = [F.col(f"`{c}`") for c in rows.columns]
        was = stored.select(name, F.xxhash64(*[x for c in columns for x in (c, c.isNull())]).alias("content")).groupBy(name).agg(*_digest(F.col("content"))).collect()
        same = {r[0] for r in was if r[0] in planned and planned[r[0]][1] == tuple(r)[1:]}
    due = sorted((number, f) for f, (_, _, number) in planned.items() if f not in same)
    if due:
        tasks = min(len(due), max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism))
        table = local_table(spark, [(number, f, k * tasks // len(due)) for k, (number, f) in enumerate(due)], "file int, folder string, task int")
        moved = routed.join(table, "file").withColumn("folder", F.coalesce("folder", F.lit("")))  # not null, so that the writer keeps the order
        laid = moved.repartitionById(tasks, F.col("task")).sortWithinPartitions("folder", "hour", *keys)
        laid.select("row.*", F.col("folder").alias(name)).write.mode("append").partitionBy(name).parquet(folder)
    old = {f: path for f, path in before.items() if f not in same}
    for path in old.values():
        fs, at = _path(spark, path)
        fs.delete(at, False)
        if not any(x.getPath().getName()[0] not in "._" for x in fs.listStatus(at.getParent())):
            fs.delete(at.getParent(), True)
    after = _paths(read_files(rows, folder), name)
    return [(*planned[f][0], after[f], f not in same) for f in sorted(planned, key=lambda f: planned[f][2])]


def file_report(rows: DataFrame, folder: str, files: list[tuple[str, int, str, bool]], id_column: str, new: Column) -> DataFrame:
    """One row a file, from its rows as they are stored: its columns, a digest of its ids in order, rows and new rows.

    A file's rows are brought together in their order by one task and hashed as they stream through it.
    """
    spark, name = rows.sparkSession, _column(rows)
    schema = "leaf string, part long, path string, rewritten boolean, columns string, ids_sha256 string, n_rows long, n_new long"
    if not files:
        return spark.createDataFrame([], schema)
    tasks = min(len(files), max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism))
    known = local_table(spark, [(k, _folder_name(leaf, part), leaf, part, path, again, k * tasks // len(files)) for k, (leaf, part, path, again) in enumerate(files)], "slot int, folder string, leaf string, part long, path string, rewritten boolean, task int")
    stored = read_files(rows, folder).select(F.col(name).alias("folder"), F.col("_metadata.row_index").alias("at"), F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit("")).alias("id"), (~F.coalesce(~new, F.lit(False))).alias("new"))
    streams = stored.join(known.select("folder", "slot", "task"), "folder").repartitionById(tasks, F.col("task")).sortWithinPartitions("slot", "at").select("slot", "id", "new")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, sha, n, fresh = None, None, 0, 0
        done: list[tuple[int, str, int, int]] = []
        for batch in batches:
            at, ids, is_new = batch.column("slot").to_numpy(), batch.column("id").to_pylist(), batch.column("new").to_numpy(zero_copy_only=False)
            cuts = np.r_[0, np.flatnonzero(np.diff(at)) + 1, len(at)] if len(at) else [0]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if at[a] != slot:
                    if sha is not None:
                        done.append((slot, sha.hexdigest(), n, fresh))
                    slot, sha, n, fresh = int(at[a]), hashlib.sha256(), 0, 0
                sha.update((("," if n else "") + ",".join(ids[a:b])).encode())
                n, fresh = n + int(b - a), fresh + int(is_new[a:b].sum())
        if sha is not None:
            done.append((slot, sha.hexdigest(), n, fresh))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), (pa.int32(), pa.string(), pa.int64(), pa.int64()))], ["slot", "ids_sha256", "n_rows", "n_new"])

    read = streams.mapInArrow(digest, "slot int, ids_sha256 string, n_rows long, n_new long")
    names = F.lit(",".join(rows.columns))
    return read.join(known, "slot").select("leaf", names.alias("columns"), "ids_sha256", "path", "part", "n_rows", "n_new", "rewritten")


def new_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/time-{uuid.uuid4().hex}"
