"""Reconciliation, tables, pipelines, schedules and incremental runs."""

from datetime import datetime, time, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewire.operators import filters
from tidewire.plans import pipelines, schedule
from tidewire.schemas import ARTICLES, LOCATION, schema
from tidewire.session import RunConfig
from tidewire.sources import tables
from tidewire.streaming import incremental

def articles(spark, rows):
    columns = schema(ARTICLES)
    return spark.createDataFrame([tuple(r.get(f.name) for f in columns) for r in rows], columns)


def test_article_tables(spark, tmp_path):
    df = tables.route_by_date(articles(spark, [{"_id": "1", "url": "u1", "date_publish": datetime(2020, 12, 31)}, {"_id": "2", "url": "u2", "date_publish_raw": "2021-01-05"}, {"_id": "3", "url": "u3", "date_publish_raw": "soon"}]))
    tables.write_articles(df, f"{tmp_path}/a")
    read = lambda **k: {r._id for r in tables.read_articles(spark, f"{tmp_path}/a", **k).collect()}
    assert read(first=(2021, 1)) == {"2"} and read(last=(2020, 12)) == {"1"} and read(undated=True) == {"1", "2", "3"}
    old, new = (spark.createDataFrame(r, "_id string, url string, v int") for r in ([("1", "a", 1), ("2", "b", 1)], [("3", "b", 2), ("4", "c", 2), ("5", "c", 3)]))
    assert {(r._id, r.url) for r in tables.insert_new(old, new).collect()} == {("1", "a"), ("2", "b"), ("4", "c")}
    assert {(r._id, r.url) for r in tables.upsert(old, new).collect()} == {("1", "a"), ("3", "b"), ("5", "c")}
    assert {r._id: r.v for r in tables.update_field(old, spark.createDataFrame([("1", None)], "_id string, v int"), "v").collect()} == {"1": None, "2": 1}
    got = {r.url: r for r in tables.download_pages(old, lambda u: None if u == "a" else 1 / 0, lambda u, h: {}).collect()}
    assert got["a"].error is None and "ZeroDivision" in got["b"].error and tables.errors_of(spark.createDataFrame([("x", None)], "a string, error string")).count() == 0


def test_files(spark, tmp_path):
    (tmp_path / "kb.csv").write_text("Admin0,Admin1,Admin2,Admin0_ISO3\nKenya,Nairobi,,ken\n")
    assert [tuple(r) for r in tables.read_kb(spark, str(tmp_path / "kb.csv")).collect()] == [("Kenya", "Nairobi", "", "KEN")]
    (tmp_path / "bad.csv").write_text("Admin0\nKenya\n")
    with pytest.raises(ValueError):
        tables.read_kb(spark, str(tmp_path / "bad.csv"))
    line = lambda i, name, alt, iso, a1, a2: "\t".join([i, name, name, alt, "1.5", "2.5", "P", "PPL", iso, "", a1, a2, "", "", "9", "", "", "", ""])
    (tmp_path / "geo.txt").write_text("\n".join([line("1", "Aleppo", "Ḩalab,Halab,Ḩalab", "SY", "09", "1"), line("6252001", "United States", "USA", "US", "", ""), line("3", "Nowhere", "", "??", "00", "")]))
    (tmp_path / "a1.txt").write_text("SY.09\tAleppo Governorate\n")
    (tmp_path / "a2.txt").write_text("SY.09.1\tAleppo District\n")
    out = tables.enrich_geonames(tables.read_geonames(spark, str(tmp_path / "geo.txt")), tables.read_codes(spark, str(tmp_path / "a1.txt")), tables.read_codes(spark, str(tmp_path / "a2.txt")), {"SY": "SYR", "US": "USA"})
    tables.write_gazetteer(out, f"{tmp_path}/gaz")
    got = {r.geonameid: r for r in spark.read.parquet(f"{tmp_path}/gaz").collect()}
    assert set(got["1"].alternativenames) == {"Ḩalab", "Halab"} and got["1"].admin1_name == "Aleppo Governorate" and got["1"].admin2_name == "Aleppo District" and got["1"].coordinates == "1.5,2.5"
    assert set(got["6252001"].alternativenames) == {"USA", "US", "U.S."} and got["6252001"].alt_name_length == 3 and got["3"].country_code3 == "NA" and got["3"].admin1_name == ""
    tweets = spark.createDataFrame([("1", datetime(2020, 1, 2).date(), "en", "a"), ("2", datetime(2020, 2, 2).date(), "fr", "b")], "_id string, date date, language string, text string")
    tables.write_tweets(tweets, f"{tmp_path}/tweets")
    assert spark.read.csv(f"{tmp_path}/tweets", header=True).count() == 2 and (tmp_path / "tweets" / "language=en" / "year=2020" / "month=1").is_dir()


def test_pipelines(spark):
    sources = spark.createDataFrame([("a.com", True, ["KEN"], False, False, ["/bad"]), ("b.com", True, ["UGA"], True, False, None), ("c.com", False, ["KEN"], False, True, [])], "source_domain string, include boolean, primary_location array<string>, major_international boolean, major_regional boolean, blacklist_url_patterns array<string>")
    base = {"include": True, "language": "en", "language_translated": "en", "title_translated": "Juba title", "maintext_translated": "Green news. More. Rest.", "title": "T", "maintext": "x"}
    df = articles(spark, [base | {"_id": "1", "url": "http://a.com/1", "source_domain": "a.com"}, base | {"_id": "2", "url": "http://a.com/bad", "source_domain": "a.com"}, base | {"_id": "3", "url": "http://a.com/3", "source_domain": "a.com"}, base | {"_id": "4", "url": "u", "source_domain": "c.com", "title_translated": None}, base | {"_id": "5", "url": "v", "source_domain": "b.com", "maintext_translated": "Dull."}])
    got = pipelines.curate_articles(df, sources)
    assert [{r._id for r in got[k].collect()} for k in ("articles", "duplicates", "blacklisted")] == [{"1", "4", "5"}, {"3"}, {"2"}]
    assert {r.source_domain for r in filters.eligible_sources(sources, ["KEN"], international=True, regional=True).collect()} == {"a.com", "b.com"}
    models = spark.createDataFrame([("env_binary", {"Yes": 0, "No": 1}, None), ("env_classifier", {"fire": 0, "flood": 1, "other": 2}, None)], "model_name string, event_type_nums map<string,int>, event_type_cutoffs map<string,double>")
    domains = filters.eligible_sources(sources, ["KEN"], international=True)
    out = {r._id: r for r in pipelines.classify_environment(got["articles"], domains, models, lambda: lambda t: np.array([[9.0, 0] if "Green" in x else [0, 9.0] for x in t]), lambda: lambda t: np.array([[2.0, 1.9, 0]] * len(t))).collect()}
    assert set(out) == {"1", "5"} and out["1"].env_classifier.env_max == "fire" and out["1"].env_classifier.env_sec == "flood" and out["5"].environmental_binary.result == "No" and out["5"].env_classifier is None
    parser = lambda: lambda t: {"mentions": [{"name": "Khartoum", "countryCode": "SD"}], "focus": None}
    places = {r._id: r.cliff_locations for r in pipelines.geoparse_articles(df, domains, parser, {"SD": "SDN"}, domains).collect()}
    assert places["1"] == {"SDN": ["Khartoum"], "SSD": ["Juba"]}


def test_schedule():
    a, b = schedule.parse_hhmm("21:00"), schedule.parse_hhmm("06:00")
    assert schedule.in_window(time(23, 30), a, b) and not schedule.in_window(time(6, 0), a, b) and not schedule.in_window(time(12), a, b) and schedule.in_window(time(12), time(9), time(17))
    assert schedule.window_end(datetime(2020, 1, 1, 23), b) == datetime(2020, 1, 2, 6) and schedule.window_end(datetime(2020, 1, 1, 3), b) == datetime(2020, 1, 1, 6)
    clock = [datetime(2020, 1, 1, 12)]
    stops = []

    def work(stop):
        stops.append(stop)
        clock[0] = stop
        return len(stops) < 3

    assert schedule.run_in_windows(work, "21:00", "06:00", chunk=timedelta(hours=1), now=lambda: clock[0], sleep=lambda s: clock.__setitem__(0, clock[0] + timedelta(seconds=s))) == 3
    assert stops == [datetime(2020, 1, 1, 22), datetime(2020, 1, 1, 23), datetime(2020, 1, 2)]
    tries = []
    with pytest.raises(OSError):
        schedule.with_retries(lambda: tries.append(1) or (_ for _ in ()).throw(OSError()), tries=3, sleep=lambda s: None)
    assert len(tries) == 3 and RunConfig.from_env({"CHUNK": "5"}).chunk_minutes == 5 and RunConfig.from_env({}).window_end == "20:59"


def test_incremental_runs(spark, tmp_path):
    small = "_id string, title string"
    add = lambda rows, n: spark.createDataFrame(rows, small).write.parquet(f"{tmp_path}/in/{n}")
    run = lambda: incremental.process_new_articles(spark, f"{tmp_path}/in/*", f"{tmp_path}/out", f"{tmp_path}/cp", lambda b: b.select("_id", F.upper("title").alias("t")), small).awaitTermination()
    add([("1", "a")], 0)
    run()
    add([("2", "b")], 1)
    run()
    run()
    got = spark.read.parquet(f"{tmp_path}/out")
    assert {(r._id, r.t) for r in got.collect()} == {("1", "A"), ("2", "B")}
    assert incremental.unprocessed(spark.createDataFrame([("2", "b"), ("3", "c")], small), got).count() == 1
