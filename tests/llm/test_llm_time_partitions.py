"""Files of the time tree against a plain version of the same tree, twice over one folder."""

import hashlib
import random
import zlib
from collections import Counter
from datetime import datetime, timedelta
from urllib.parse import urlparse

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidewire.llm import queries, time_partitions

SCHEMA = "click_id bigint, ts timestamp_ntz, arrived_at timestamp_ntz, file string, row int"
MAY = datetime(2024, 5, 1)


def moment(ts, click_id):
    if ts is None or click_id is None:
        return ts
    k = zlib.crc32(str(click_id).encode()) % 128
    if k < 16:
        return ts - timedelta(days=(k + 6) ** 3)
    if k > 111:
        return datetime(ts.year, ts.month, ts.day) - timedelta(days=ts.weekday())
    return ts


def plain_leaves(moments, limit):
    """(name, rows) of all leaves: siblings are listed one by one and joined from the left."""
    out = {}

    def walk(path, rows, depth):
        unit = ("year", "month", "day", "hour")[depth]
        here = {}
        for r in rows:
            here.setdefault(getattr(r[0], unit), []).append(r)
        if depth == 0:
            members = range(min(here), max(here) + 1)
        elif depth == 1:
            members = range(1, 13)
        elif depth == 2:
            members = [d for d in range(1, 32) if _is_day(int(path[0]), int(path[1]), d)]
        else:
            members = range(24)
        group = None
        for m in members:
            mine = here.get(m, [])
            if len(mine) > limit:
                group = None
                if depth == 3:
                    out["/".join([*path, f"{m:02d}-{m:02d}"])] = mine
                else:
                    walk([*path, f"{m:0{2 if depth else 4}d}"], mine, depth + 1)
                continue
            if group is None or len(group[2]) + len(mine) > limit:
                group = [m, m, []]
                groups.append((path, depth, group))
            group[1] = m
            group[2].extend(mine)

    groups = []
    timed = [r for r in moments if r[0] is not None]
    if timed:
        walk([], timed, 0)
    for path, depth, (a, b, mine) in groups:
        if mine:
            out["/".join([*path, f"{a:0{2 if depth else 4}d}-{b:0{2 if depth else 4}d}"])] = mine
    if len(timed) < len(moments):
        out["null"] = [r for r in moments if r[0] is None]
    return out


def _is_day(y, m, d):
    try:
        datetime(y, m, d)
    except ValueError:
        return False
    return True


def plain_files(rows, limit):
    low = datetime.min
    key = lambda r: (r[0] or low, r[2] is not None, r[2] or low, r[1] is not None, r[1] or 0)
    out = {}
    for leaf, mine in plain_leaves([(moment(ts, i), i, a, x) for i, ts, a, *x in rows], limit).items():
        mine.sort(key=key)
        for k in range(0, len(mine), limit):
            out[leaf, k // limit + 1] = mine[k : k + limit]
    return out


def clicks(seed):
    rng, start, out = random.Random(seed), datetime(2024, 1, 1), []
    for i in range(1500):
        ts = start + timedelta(seconds=rng.choice([rng.randrange(130 * 86400), 40 * 86400 + rng.randrange(3600)]), microseconds=rng.randrange(10**6))
        late = ts + timedelta(seconds=rng.choice([1, 1, 5, 86400 * 9]))
        out.append((i, ts if rng.random() > 0.05 else None, late if rng.random() > 0.03 else None, rng.choice(["a", None]), None))
    out += rng.choices(out, k=60) + [(None, None, None, None, None)] * 40  # repeated rows; more of one than fit into a file
    tie = (7000, datetime(2024, 2, 3, 4, 5, 6), datetime(2024, 2, 3, 4, 6))
    return out + [(*tie, f"v{k % 3}", k % 2) for k in range(50)]


@pytest.mark.parametrize("limit", [7, 200])
def test_layouts_against_plain_version(spark, tmp_path, limit):
    rows = clicks(limit)
    random.Random(1).shuffle(rows)
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/in")
    df = spark.read.parquet(f"{tmp_path}/in")
    at = time_partitions.click_moment(F.col("ts"), F.col("click_id"))
    early = F.col("arrived_at") < F.lit(MAY)
    folder = f"file://{tmp_path}/out"
    first = time_partitions.rewrite(df.where(early), folder, limit, at, ("arrived_at", "click_id"))
    files = time_partitions.rewrite(df, folder, limit, at, ("arrived_at", "click_id"))
    got = {(r.leaf, r.part): r for r in time_partitions.file_report(df, folder, files, "click_id", ~early).collect()}
    old, want = plain_files([r for r in rows if r[2] and r[2] < MAY], limit), plain_files(rows, limit)
    assert {f[:2] for f in first} == set(old) and set(got) == set(want)
    whole = lambda mine: Counter((i, a, *x) for _, i, a, x in mine)
    total = Counter()
    for k, mine in want.items():
        r, stored = got[k], pq.ParquetFile(urlparse(got[k].path).path).read().to_pylist()
        ids = ["" if m[1] is None else str(m[1]) for m in mine]
        assert ["" if x["click_id"] is None else str(x["click_id"]) for x in stored] == ids
        assert (r.n_rows, r.ids_sha256) == (len(mine), hashlib.sha256(",".join(ids).encode()).hexdigest())
        assert r.n_new == sum(m[2] is None or m[2] >= MAY for m in mine)
        assert r.columns == "click_id,ts,arrived_at,file,row"
        if limit > 50:  # else rows that differ only in other columns may fall on either side of a cut
            assert r.rewritten == (k not in old or whole(old[k]) != whole(mine))
        elif len(mine) != len(old.get(k, ())) or r.n_new:
            assert r.rewritten
        total += Counter(tuple(x.values()) for x in stored)
    assert total == Counter(rows)
    on_disk = {str(p) for p in (tmp_path / "out").rglob("*.parquet")}
    assert on_disk == {urlparse(r.path).path for r in got.values()}
    stayed = {f[2] for f in first} & {r.path for r in got.values()}
    assert stayed == {r.path for r in got.values() if not r.rewritten}


def test_other_zone_and_query(spark, tmp_path):
    """The session's zone changes nothing; the query writes a new folder at each call."""
    rows = [(i, datetime(2024, 3, 31, 0, 30) + timedelta(minutes=7 * i), datetime(2024, 4, 29 if i % 9 else 30, i % 24), None, None) for i in range(700)] + [(5, None, datetime(2024, 5, 2), None, None)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/clicks.parquet")
    seen = []
    for zone in ("UTC", "Europe/Berlin"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            seen.append(sorted((r.leaf, r.part, r.ids_sha256, r.n_new, r.path) for r in queries.op11_time_partitions(spark, str(tmp_path)).collect()))
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    a, b = seen
    assert [x[:4] for x in a] == [x[:4] for x in b] and not {x[4] for x in a} & {x[4] for x in b}
    want = plain_files(rows, 1 + len(rows) // 500)
    assert {x[:2] for x in a} == set(want)


def test_no_rows(spark, tmp_path):
    df = spark.createDataFrame([], SCHEMA)
    files = time_partitions.rewrite(df, f"file://{tmp_path}/none", 5, time_partitions.click_moment(F.col("ts"), F.col("click_id")), ("arrived_at", "click_id"))
    assert files == [] and time_partitions.file_report(df, f"file://{tmp_path}/none", files, "click_id", F.lit(True)).count() == 0


def test_plans_do_not_grow_with_the_digits(spark, tmp_path, monkeypatch):
    """Digits, digits and then a sort, or a sort alone: the same files, and no plan that joins once for each digit before."""
    rng = random.Random(5)
    at = [datetime(2024, 3, 4) + timedelta(microseconds=rng.choice([0, 0, 7, rng.randrange(3_600_000_000)])) for _ in range(400)]
    rows = [(rng.choice([1, 2, 2**40 + i]), t if i % 9 else None, MAY if i % 3 else MAY - timedelta(seconds=i), "x" if i % 2 else None, 0) for i, t in enumerate(at)]
    spark.createDataFrame(rows + rows[:100], SCHEMA).repartition(3).write.parquet(f"{tmp_path}/in")
    keyed, keys = time_partitions.with_keys(spark.read.parquet(f"{tmp_path}/in"), time_partitions.micros(F.col("ts")), ("arrived_at", "click_id"))
    leaves = time_partitions.time_leaves(keyed.groupBy("hour").agg(F.count("*").alias("n")), 7)
    kind, joins = type(keyed), []
    collect = kind.collect

    def counting(df):
        joins.append(df._jdf.queryExecution().analyzed().toString().count("Join "))
        return collect(df)

    laid = []
    for few in (0, 20, 1000):
        monkeypatch.setattr(kind, "collect", counting)
        bounds = time_partitions.boundaries(keyed, keys, leaves, 7, few)
        monkeypatch.setattr(kind, "collect", collect)
        routed, files = time_partitions.file_numbers(keyed, keys, leaves, bounds)
        laid.append(sorted(tuple(r) for r in routed.select("file", *keys).collect()))
        assert max(Counter(r[0] for r in laid[-1]).values()) <= 7 and len(files) > 60
    assert laid[0] == laid[1] == laid[2] and len(joins) > 6 and max(joins) <= 3
