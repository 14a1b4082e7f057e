"""Readers, writers, limits, batches and stops that no query covers."""

from datetime import date, datetime, timedelta

import numpy as np
from pyspark.sql import functions as F

from tidewire.functions import nested
from tidewire.operators import classify, filters, reports, translate
from tidewire.plans import schedule
from tidewire.sources import tables


def test_last_code_wins(spark, tmp_path):
    (tmp_path / "codes.txt").write_text("KE.1\tZulu\nKE.2\tOther\nKE.1\tAlpha\n")
    assert dict(tables.read_codes(spark, str(tmp_path / "codes.txt")).collect()) == {"KE.1": "Alpha", "KE.2": "Other"}


def test_tweets_of_days(spark, tmp_path):
    rows = [("1", date(2020, 1, 31), "en", "a"), ("2", date(2020, 2, 1), "en", "b"), ("3", date(2020, 2, 1), "fr", "c"), ("4", date(2020, 2, 2), "en", "d")]
    df = spark.createDataFrame(rows, "_id string, date date, language string, text string")
    assert {r._id for r in tables.tweets_between(df, "2020-01-31", "2020-02-01", "en").collect()} == {"1", "2"}
    assert {r._id for r in tables.tweets_between(df, "2020-02-01", "2020-02-01").collect()} == {"2", "3"}


def test_lookups_by_url_prune(spark, tmp_path):
    """Files are sorted by url, so their statistics tell which hold one; the filter reaches the scan."""
    df = spark.range(200).select(F.col("id").cast("string").alias("_id"), F.format_string("http://h/%05d", "id").alias("url"), F.lit(2020).alias("year"), F.lit(1).alias("month"))
    tables.write_articles(df, f"{tmp_path}/a")
    got = spark.read.parquet(f"{tmp_path}/a")
    one = got.where(F.col("url") == "http://h/00007")
    assert one.count() == 1 and "EqualTo(url,http://h/00007)" in one._jdf.queryExecution().executedPlan().toString()
    for path in {r.f for r in got.select(F.input_file_name().alias("f")).distinct().collect()}:
        urls = [r.url for r in spark.read.parquet(path).select("url").collect()]
        assert urls == sorted(urls)


def test_spot_limit(spark):
    df = spark.createDataFrame([(i, "a.com" if i % 2 else "b.com", "tr" if i % 5 == 0 else None if i % 3 == 0 else "en") for i in range(30)], "_id int, source_domain string, language string")
    assert filters.spot(df, ["a.com"], ["tr"], ("_id",), limit=4).count() == 4
    assert {r._id for r in filters.spot(df, ["a.com"], ["tr"], ("_id",)).collect()} == {i for i in range(30) if i % 2 and i % 5}
    assert filters.spot(df).count() == 30


def test_models_get_bounded_batches(spark):
    def load():
        def run(texts):
            assert 0 < len(texts) <= 7
            return np.array([[len(texts), len(t)] for t in texts], float)

        return run

    got = classify.score(spark.createDataFrame([("x" * i,) for i in range(20)], "t string").coalesce(1), F.col("t"), load, batch=7).collect()
    assert [r.logits[0] for r in got] == [7] * 14 + [6] * 6 and [r.logits[1] for r in got] == list(range(20))


def test_parts_of_a_list(spark):
    def plain(items, batch):
        n, p = len(items), len(items) // batch + 1
        return [items[i * n // p : (i + 1) * n // p] for i in range(p)]

    for n in (0, 1, 3, 7, 30, 31):
        items = list(range(n))
        got = spark.createDataFrame([(items,)], "l array<int>").select(nested.near_equal_parts(F.col("l"), 10)).first()[0]
        assert got == plain(items, 10)


def test_plucking_from_broken_replies(spark):
    df = spark.createDataFrame([('{"translated_text":{"en":"say \\"hi\\" now"}',), ('x {"translated_text":{"en":""}}',), ('{"translated_text":{"fr":"a"}}',), (None,)], "r string")
    assert [r[0] for r in df.select(translate.pluck_translation(F.col("r"))).collect()] == ['say "hi" now', "", None, None]


def test_stops_between_months():
    clock, done = [datetime(2020, 1, 1, 1)], []

    def work(month):
        done.append(month)
        clock[0] += timedelta(hours=1)

    assert schedule.run_months([1, 2, 3, 4], work, datetime(2020, 1, 1, 3), now=lambda: clock[0]) == [3, 4] and done == [1, 2]
    assert schedule.run_months([3, 4], work, None) == [] and done == [1, 2, 3, 4]


def test_months_ahead(spark):
    ends = lambda df: [str(r[0]) for r in df.collect()]
    assert ends(reports.months_until(spark, "2023-12-05", "2024-01-30")) == ["2023-12-31", "2024-01-31", "2024-02-29"]
    assert ends(reports.months_until(spark, "2023-12-05", "2024-01-30", ahead_days=31)) == ["2023-12-31", "2024-01-31", "2024-02-29"]
    assert ends(reports.months_until(spark, "2023-12-05", "2024-01-28", ahead_days=31)) == ["2023-12-31", "2024-01-31"]


def test_output_fields():
    assert classify.field_of("env_binary") == "environmental_binary" and classify.field_of("anti-us_narrative_class") == "US_narrative_class" and classify.field_of("civic1") == "civic1"


def test_models_get_texts_in_batches_of_bounded_bytes(spark):
    """Long texts come to a worker a few at a time, with the rows they belong to; a session's own setting stays."""
    key, own = classify.BATCH_BYTES[0], "1m"
    texts = [(i, None if i == 7 else chr(97 + i % 26) * 2**20 if i < 30 else "short") for i in range(40)]
    df = spark.createDataFrame(texts, "i int, t string").coalesce(1)
    load = lambda: lambda items: np.array([[len(t), len(items), np.nan] for t in items])
    spark.conf.unset(key)
    try:
        got = classify.score(df, F.col("t"), load).collect()
        assert [r.logits[0] for r in sorted(got)] == [len(t or "") for _, t in texts] and all(r.logits[2] != r.logits[2] for r in got)
        assert max(r.logits[1] for r in got if r.t and len(r.t) > 5) < 15
        assert classify.score(df.where("i < 0"), F.col("t"), load).collect() == []
        spark.conf.set(key, own)
        classify.score(df, F.col("t"), load)
        assert spark.conf.get(key) == own
    finally:
        spark.conf.unset(key)
