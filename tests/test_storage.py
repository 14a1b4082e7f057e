"""Merges of months, the search index, resumable runs and variants, against plain Python over the same rows."""

import json
import re
import unicodedata
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidewire import catalog
from tidewire.functions import variant
from tidewire.functions.dates import parse_date
from tidewire.plans import ledger
from tidewire.sources import merge, search_index
from tidewire.sources.folders import Folders

ROWS = [(f"a{i}", f"t{i}", i % 3, 2020 + i % 2, 1 + i % 5) for i in range(60)] + [("u1", "x", 0, None, None), ("u2", "y", 1, None, None)]
SCHEMA = "_id string, title string, n int, year int, month int"


@pytest.fixture
def table(spark, tmp_path):
    path = f"{tmp_path}/articles"
    spark.createDataFrame(ROWS, SCHEMA).repartition(2).write.partitionBy("year", "month").parquet(path)
    return path


def content(spark, path):
    return sorted(map(repr, map(tuple, spark.read.parquet(path).select("_id", "title", "n", "year", "month").collect())))


def plain(changes):
    new = dict(changes)
    return sorted(repr((i, new.get(i, t), n, y, m)) for i, t, n, y, m in ROWS)


CHANGES = [("a0", "new"), ("a1", None), ("a2", "t2"), ("u1", "undated"), ("zz", "nobody")]


def test_merge_reads_and_writes_touched_months_only(spark, table, tmp_path):
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "articles").rglob("*.parquet")}
    changes = spark.createDataFrame(CHANGES, "_id string, title string")
    got = merge.merge_changes(spark, table, changes, "first")
    assert got.modified == 3 and len(got.months) == 4 and content(spark, table) == plain(CHANGES)
    same = {p for p in (tmp_path / "articles").rglob("*.parquet") if files.get(p) == p.stat().st_mtime_ns}
    assert {str(p.parent).split("articles/")[1] for p in same} == {f"year={2020 + i % 2}/month={1 + i % 5}" for i in range(60)} - set(got.months)
    located = changes.join(spark.read.parquet(table).select("_id", "year", "month"), "_id")
    plan = merge.updated(spark.read.parquet(table).where(merge.of_months([(2020, 1), (2021, 2)])), located)[0]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "year#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert spark.read.parquet(table).where(merge.of_months([(2020, 1), (None, None)])).inputFiles().__len__() < len(files)


def test_a_merge_is_done_once(spark, table):
    changes = spark.createDataFrame(CHANGES, "_id string, title string")
    first = merge.merge_changes(spark, table, changes, "m")
    merge.merge_changes(spark, table, spark.createDataFrame([("a0", "later")], "_id string, title string"), "n")
    assert merge.merge_changes(spark, table, changes, "m") == first
    assert content(spark, table) == plain([*CHANGES, ("a0", "later")])


@pytest.mark.parametrize("stop", range(8))
def test_a_stopped_merge_is_finished_by_the_next(spark, table, monkeypatch, stop):
    """Stopped before any of its renames, it leaves either the old table, or one that the next merge completes."""
    changes = spark.createDataFrame(CHANGES, "_id string, title string")
    moved, move = [], Folders.move

    def broken(self, old, new):
        if len(moved) == stop:
            raise OSError("stopped")
        moved.append(old)
        move(self, old, new)

    monkeypatch.setattr(Folders, "move", broken)
    with pytest.raises(OSError):
        merge.merge_changes(spark, table, changes, "m")
    monkeypatch.setattr(Folders, "move", move)
    if stop == 0:  # before the intent
        assert merge.finish_merges(spark, table) == [] and content(spark, table) == plain([])
    else:
        assert merge.finish_merges(spark, table) == ["m"] and content(spark, table) == plain(CHANGES)
    assert merge.merge_changes(spark, table, changes, "m").modified == 3 and content(spark, table) == plain(CHANGES)


def test_merge_of_nothing(spark, table):
    none = spark.createDataFrame([], "_id string, title string")
    assert merge.merge_changes(spark, table, none, "none") == merge.Merged(0, []) and content(spark, table) == plain([])
    several = spark.createDataFrame([("a5", "b"), ("a5", "c"), ("a5", None)], "_id string, title string")
    assert merge.merge_changes(spark, table, several, "several").modified == 1 and content(spark, table) == plain([("a5", "c")])


def test_search_index(spark, tmp_path):
    rows = [("1", "Nairobi", ["Nairobi County", "Найроби"]), ("2", "New Nairobi", None), ("3", "São Tomé", ["Sao Tome", ""]), ("4", "Nairobi", [])]
    path = f"{tmp_path}/index"
    gazetteer = spark.createDataFrame(rows, "geonameid string, name string, alternativenames array<string>")
    for _ in range(2):  # again gives the same
        search_index.write_index(gazetteer, path, buckets=16)
    find = lambda names, **k: {(r.name, r.id, r.whole) for r in search_index.lookup(spark, path, names, buckets=16, **k).collect()}
    assert find(["NAIROBI!", "sao tome", "nowhere", "?"]) == {("NAIROBI!", "1", True), ("NAIROBI!", "4", True), ("sao tome", "3", True)}
    assert find(["nairobi"], words=True) == {("nairobi", "1", True), ("nairobi", "2", False), ("nairobi", "4", True)}
    assert find(["Найроби"]) == {("Найроби", "1", True)} and find(["county"], words=True) == {("county", "1", False)}
    plan = search_index.lookup(spark, path, ["sao tome"], buckets=16)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket#\d+ = \d+", plan) and re.search(r"DataFilters: \[[^\]]*term#", plan)
    asked = spark.createDataFrame([(7, "sao tome"), (8, "x")], "q int, key string")
    assert [tuple(r) for r in search_index.match_names(asked, path).select("q", "id").collect()] == [(7, "3")]


def test_runs_go_on_where_they_stopped(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([(i, f"2024-0{1 + i % 3}") for i in range(90)], "id int, of string").withColumn("chunk", ledger.chunk_of(F.col("id"), 3))
    path, calls = f"{tmp_path}/run", []

    def work(month, chunk):
        calls.append((month, chunk))
        return rows.where((F.col("of") == month) & (F.col("chunk") == chunk)).select("id")

    months, move = ["2024-01", "2024-02", "2024-03"], Folders.move
    clock = iter(range(100))
    left = ledger.run_chunks(spark, path, months, 3, work, stop=2, now=lambda: next(clock))
    assert len(left) == 7 and ledger.finished(spark, path) == [("2024-01", 0), ("2024-01", 1)]
    # Killed after the rows are written, before they are in their place.
    monkeypatch.setattr(Folders, "move", lambda *a: (_ for _ in ()).throw(OSError("killed")))
    with pytest.raises(OSError):
        ledger.run_chunks(spark, path, months, 3, work)
    monkeypatch.setattr(Folders, "move", move)
    assert len(ledger.finished(spark, path)) == 2
    assert ledger.run_chunks(spark, path, months, 3, work) == [] and ledger.run_chunks(spark, path, months, 3, work) == []
    assert sorted((r.id, r.of_month) for r in ledger.read_chunks(spark, path).collect()) == sorted((i, f"2024-0{1 + i % 3}") for i in range(90))
    assert calls.count(("2024-01", 2)) == 2 and calls.count(("2024-01", 0)) == 1


def test_variants(spark):
    texts = ['{"k": 1, "t": [1], "o": {"x": null}}', '{"k": "12 ", "t": "a", "o": {"x": true}}', '{"k": 1.5, "t": null}', '{"k": "x"}', "[1]", "no json", None, '"text"', "{}"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").withColumn("v", variant.parse(F.col("t")))
    v = F.col("v")
    got = [tuple(r) for r in df.orderBy("i").select(variant.kind_of(v, "$.k"), variant.kind_of(v, "$.t"), variant.kind_of(v, "$.o.x"), variant.kind_of(v), variant.as_long(v, "$.k"), variant.as_text(v, "$.t")).collect()]
    assert got == [
        ("number", "array", "null", "object", 1, "[1]"), ("string", "string", "bool", "object", 12, "a"), ("number", "null", "missing", "object", 1, None), ("string", "missing", "missing", "object", None, None),
        ("missing", "missing", "missing", "array", None, None), ("missing",) * 4 + (None, None), ("missing",) * 4 + (None, None), ("missing", "missing", "missing", "string", None, None), ("missing", "missing", "missing", "object", None, None),
    ]
    assert [r.i for r in df.where(variant.is_kind(v, "$.k", "string", "missing") & v.isNotNull()).orderBy("i").collect()] == [1, 3, 4, 7, 8]
    with pytest.raises(ValueError):
        variant.is_kind(v, "$.k", "integer")


def rows_of(spark, sf_dir, name):
    return [r.asDict() for r in spark.read.parquet(f"{sf_dir}/{name}.parquet").collect()]


def test_merged_sales_query(spark, sf_dir):
    sales, back = rows_of(spark, sf_dir, "sales"), {}
    for r in rows_of(spark, sf_dir, "sale_lines"):
        if r["shipped_at"] and datetime(2024, 2, 1) <= r["shipped_at"] <= datetime(2024, 3, 31) and r["flag"] == "R":
            back.setdefault(r["sale_id"], []).append(r["amount"])
    in_time = {r["sale_id"] for r in sales if r["sold_at"] and r["sold_at"].year == 2024 and r["sold_at"].month in (2, 3)}
    want = []
    for r in sales:
        at = r["sold_at"]
        # A repeated sale is changed where its month holds a sale of that id that was returned.
        hit = r["sale_id"] in back and r["sale_id"] in in_time and at and at.year == 2024 and at.month in (2, 3)
        amounts = [a for a in back.get(r["sale_id"], ()) if a is not None]
        want.append((r["sale_id"], "returned" if hit else r["status"], (round(sum(amounts), 2) if amounts else None) if hit else r["total"], at and at.year, at and at.month))
    got = [tuple(r) for r in catalog.QUERIES["merged_sales"](spark, sf_dir).select("sale_id", "status", "total", "year", "month").collect()]
    key = lambda r: repr((r[0], r[1], None if r[2] is None else f"{r[2]:.1f}", *r[3:]))
    assert sorted(map(key, got)) == sorted(map(key, want))


def test_indexed_names_query(spark, sf_dir):
    norm = {r.client_id: r.key for r in catalog.QUERIES["indexed_names"].__globals__["_t"](spark, sf_dir, "clients").select("client_id", catalog.text.normalize_for_match(F.col("name")).alias("key")).collect()}
    clients = rows_of(spark, sf_dir, "clients")
    masters = {}
    for r in clients:
        if r["name"] is not None and r["client_id"] == r["master_id"]:
            masters.setdefault(norm[r["client_id"]], set()).add(r["client_id"])
    want = sorted((r["client_id"], m) for r in clients if r["name"] is not None and r["client_id"] != r["master_id"] for m in masters.get(norm[r["client_id"]], ()))
    got = sorted({(r.client_id, r.master) for r in catalog.QUERIES["indexed_names"](spark, sf_dir).collect()})
    assert got == sorted(set(want)) and json.dumps(got)


def test_resumed_runs_query(spark, sf_dir):
    want = sorted(repr((r["sale_id"], None if r["total"] is None else r["total"] > 100, f"{r['sold_at']:%Y-%m}")) for r in rows_of(spark, sf_dir, "sales") if r["sold_at"])
    assert sorted(repr((r.sale_id, r.large, r.of_month)) for r in catalog.QUERIES["resumed_runs"](spark, sf_dir).collect()) == want


def test_months_read_query(spark, sf_dir):
    want = sorted((r["sale_id"], r["sold_at"].year, r["sold_at"].month) for r in rows_of(spark, sf_dir, "sales") if r["sold_at"] and (2024, 2) <= (r["sold_at"].year, r["sold_at"].month) <= (2031, 12))
    assert sorted(tuple(r) for r in catalog.QUERIES["months_read"](spark, sf_dir).select("sale_id", "year", "month").collect()) == want and want


def test_tweet_files_query(spark, sf_dir):
    found = spark.read.parquet(f"{sf_dir}/stamps.parquet").select("stamp_id", "zone", "raw", F.to_date(parse_date(F.col("raw"))).alias("day")).collect()
    want = sorted((r.stamp_id, r.day, r.day.year, r.day.month, len('a "quoted", text\n' + r.raw)) for r in found if r.day and (r.zone or "").startswith("Am"))
    got = sorted(tuple(r) for r in catalog.QUERIES["tweet_files"](spark, sf_dir).select("stamp_id", "date", "year", "month", "n_chars").collect())
    # White space at the ends of a CSV field is read as it was written only inside quotes, which these texts have.
    assert got == want and want


def test_gazetteer_files_query(spark, sf_dir):
    nation = {r["n_nationkey"]: r["n_name"] for r in rows_of(spark, sf_dir, "nation")}
    got = {r.vendor_id: r for r in catalog.QUERIES["gazetteer_files"](spark, sf_dir).collect()}
    vendors = {r["vendor_id"]: r for r in rows_of(spark, sf_dir, "vendors") if r["vendor_id"] is not None}
    assert set(got) == set(vendors)
    for i, r in got.items():
        v = vendors[i]
        assert (r.name, r.coordinates, r.country_code3, r.admin1_name) == (v["name"], "1.5,2.5", "KEN", nation.get(v["nation_id"], ""))
        names = {v["name"], v["name"].upper()}
        assert r.n_names == len(names | {"".join(c for c in unicodedata.normalize("NFKD", n) if not unicodedata.combining(c)) for n in names})
