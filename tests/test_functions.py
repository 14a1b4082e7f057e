"""Scalar functions and patches on hand-built rows."""

import pytest
from pyspark.sql import functions as F

from tidewire.functions import nested, text
from tidewire.functions.similarity import common_length, partial_ratio, ratio, weighted
from tidewire.operators import classify, curate, filters, geo, translate


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("value, want", [
    ("PARIS — Hello", "Hello"), ("A: b", "b"), ("x" * 40 + " - tail", "x" * 40 + " - tail"), ("ROME (CNN) news", " news"), ("A--b: c", "b: c"), ("head\nbody", "body"), ("y" * 25 + ": z", "y" * 25 + ": z"), (None, None), ("", ""),
])
def test_cut_dateline(spark, value, want):
    assert one(spark, text.cut_dateline(F.lit(value).cast("string"))) == want


@pytest.mark.parametrize("url, want", [("http://www.a.com:80/x", "a.com:80"), ("https://ww2.b.org", "b.org"), ("no scheme", ""), ("//www.c.net/p", "c.net"), ("http://user@www.d.com/", "user@www.d.com"), (None, "")])
def test_source_domain(spark, url, want):
    assert one(spark, text.pull_source_domain(F.lit(url).cast("string"))) == want


@pytest.mark.parametrize("url, want", [("http://a.com/b;p?x=1#f", "http://a.com/b"), ("http://a.com?x=1", "http://a.com?x=1"), ("http://a.com/b/../c?d", "http://a.com/c"), ("http://a.com/b/./c/..", "http://a.com/b/"), ("http://a.com/", "http://a.com/")])
def test_cut_url_query(spark, url, want):
    assert one(spark, text.cut_url_query(F.lit(url))) == want


def test_texts(spark):
    assert one(spark, text.clean_text(F.lit("a\n“b”  ’c\\"))) == "a \"b\" 'c" and one(spark, text.clean_text(F.lit(None).cast("string"))) == ""
    assert one(spark, text.final_text(F.lit("T\n"), F.lit('b"c'))) == "T. bc" and one(spark, text.combine_text(F.lit(None).cast("string"), F.lit("b"))) == "b"
    assert one(spark, text.build_combined(F.lit("T"), F.lit("One. Two! Three?"))) == "T. One.Two!"
    assert one(spark, text.strip_blocks(F.lit("a<script x>b\nc</script>d -- Advertisement --"))) == "ad "
    assert one(spark, text.moderate_clean(F.lit("é\x01 ☃ ok"))) == "é ok"
    assert one(spark, text.normalize_for_match(F.lit("São-Tomé!"))) == "sao tome"
    assert str(one(spark, text.publish_date(F.lit("2020-02-03 04:05:06")))) == "2020-02-03 04:05:06" and one(spark, text.publish_date(F.lit("never"))) is None


def test_nested(spark):
    m = lambda **kv: F.create_map(*[F.lit(x) for p in kv.items() for x in p])
    assert one(spark, nested.map_argmax(m(a=1.0, b=2.0, c=2.0))) == "b"
    assert one(spark, nested.with_cutoff(m(a=1.0, b=0.4), m(a=0.9))) == "a" and one(spark, nested.with_cutoff(m(b=1.0), m(a=0.9))) == "-999"
    labels = F.array(*map(F.lit, "xyz"))
    assert tuple(one(spark, nested.top_two(F.array(F.lit(0.6), F.lit(0.3), F.lit(0.1)), labels))) == ("x", None)
    assert tuple(one(spark, nested.top_two(F.array(F.lit(0.31), F.lit(0.6), F.lit(0.09)), labels))) == ("y", "x")
    assert one(spark, nested.invert(m(a=1, b=2))) == {1: "a", 2: "b"}
    assert one(spark, nested.load_map(F.lit("oops"), "int")) == {} and one(spark, nested.load_map(F.lit('{"a": 1}'), "int")) == {"a": 1}
    assert one(spark, nested.first_filled(F.create_map().cast("map<string,int>"), m(a=1))) == {"a": 1}
    reply = '```json\n[{"a": 1}, {}]\n```'
    assert one(spark, nested.parse_batch_reply(F.lit(reply), F.lit(2), "int")) == [{"a": 1}, {}] and one(spark, nested.parse_batch_reply(F.lit(reply), F.lit(3), "int")) is None
    assert one(spark, nested.upsert_key(m(a=1), "b", F.lit(2))) == {"a": 1, "b": 2}


def test_predicates(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "a"), (4, "-999")], "id int, c string")
    ids = lambda cond: {r.id for r in df.where(cond).collect()}
    assert ids(filters.present(F.col("c"))) == {2, 3, 4} and ids(filters.filled(F.col("c"))) == {3, 4}
    assert ids(filters.not_among(F.col("c"), ["-999", None])) == {2, 3} and ids(filters.not_among(F.col("c"), ["-999"])) == {1, 2, 3}
    assert ids(filters.both_missing(F.col("c") == "a")) == {1, 2, 4} and ids(filters.mentions("A", F.col("c"), ignore_case=True)) == {3}


def test_patches(spark):
    m = F.create_map(F.lit("AGO"), F.array(F.lit("Republic of Angola")), F.lit("None"), F.array(F.lit("West Africa")))
    assert one(spark, curate.west_africa_patch(m, F.lit("in west africa."))) == {"None": ["West Africa"]}
    assert "AGO" in one(spark, curate.west_africa_patch(m, F.lit("West Africa and ANGOLA")))
    assert one(spark, curate.gaza_patch(m, F.lit("to Ghaza,")))["PSE"] == ["Gaza"] and "PSE" not in one(spark, curate.gaza_patch(m, F.lit("Ghazali")))
    s = F.create_map(F.lit("SDN"), F.array(F.lit("Khartoum")))
    assert one(spark, curate.south_sudan_patch(s, F.lit("Juba"), F.lit(True)))["SSD"] == ["Juba"] and "SSD" not in one(spark, curate.south_sudan_patch(m, F.lit("Juba"), F.lit(True)))


def test_deduplication_and_flags(spark):
    rows = [("1", "a.com", "T", None, "en", None, "t"), ("2", "a.com", "T", True, None, None, "t"), ("3", "a.com", "T", True, "en", None, None), ("4", "b.com", None, True, "en", None, "t"), ("5", "b.com", None, False, "en", "en", "t")]
    df = spark.createDataFrame(rows, "_id string, source_domain string, title string, include boolean, language string, language_translated string, maintext string").withColumns({"title_translated": F.lit(None).cast("string"), "maintext_translated": F.lit(None).cast("string")})
    kept, gone = curate.split_duplicates(df, ["source_domain", "title"])
    assert {r._id for r in kept.collect()} == {"1", "4", "5"} and {r._id for r in gone.collect()} == {"2", "3"}
    again = curate.split_duplicates(kept, ["source_domain", "title"])
    assert again[0].count() == 3 and again[1].count() == 0
    assert {r._id for r in curate.set_include(df, ["a.com"]).where("include").collect()} == {"1", "2", "3", "4"}
    assert {r._id: r.language for r in curate.fill_language(df, "a.com", "tr").collect()}["2"] == "tr"
    assert {r._id for r in curate.english_passthrough(curate.set_include(df, ["a.com"])).where("language_translated = 'en'").collect()} == {"1", "5"}


def test_geoparser_results(spark):
    codes = geo.iso_codes(spark)
    assert codes["KE"] == "KEN" and len(codes) > 200
    parser = lambda: (lambda t: {"mentions": [{"name": n, "countryCode": c, "lat": 1.0, "lon": 2.0, "featureCode": "PPL", "confidence": None, "stateGeoNameId": "7", "countryGeoNameId": "8"} for n, c in (("Nairobi", "KE"), ("Kisumu", "KE"), ("Nairobi", "KE"), ("Pristina", "XK"), ("Atlantis", "??"), ("Capitol", "MY"))], "focus": {"countries": [], "states": [{"id": "7", "name": "State", "featureCode": "ADM1", "countryCode": "KE"}], "cities": []}})
    df = geo.geoparse(spark.createDataFrame([("x",), (None,)], "t string"), F.col("t"), parser)
    got = df.select(geo.places_by_country(F.col("geoparsed.mentions"), codes).alias("p"), geo.admin_hierarchy(F.col("geoparsed.mentions"), F.col("geoparsed.focus"), {"KE": "Kenya"}).alias("h")).collect()
    assert got[0].p == {"KEN": ["Nairobi", "Kisumu"], "XKX": ["Pristina"], "None": ["Atlantis"]} and got[1].p is None
    assert [x.name for x in got[0].h[0].admin_hierarchy] == ["Nairobi", "State", "Kenya"]
    reply = F.create_map(F.lit("Unknown"), F.struct(F.lit("a").alias("location_level"), *[F.lit("b").alias(c) for c in ("admin0", "admin1", "admin2")]), F.lit("Lagos"), F.struct(F.lit(None).cast("string").alias("location_level"), *[F.lit("b").alias(c) for c in ("admin0", "admin1", "admin2")]))
    assert {k: v.location_level for k, v in one(spark, geo.clean_reply(reply)).items()} == {"Lagos": "Unknown"}


def test_batches_are_asked_again_in_smaller_ones(spark):
    def ask(prompt):
        import json

        n = prompt.count("Maintext:")
        if "bad" in prompt and n > 1:
            raise ValueError("no")
        return "```json\n" + json.dumps([{"Place": {"location_level": "city"}, "unknown": {}} for _ in range(n)]) + "\n```"

    df = spark.createDataFrame([(i, "t", "bad" if i == 3 else "ok") for i in range(12)], "_id int, title string, body string").coalesce(1)
    got = geo.geoparse_in_batches(df, ask, tries=1).collect()
    assert len(got) == 12 and all(r.gemini_locations["Place"].admin0 == "Unknown" and r.error is None for r in got)


def test_translation_fallbacks():
    calls = []

    def service(items):
        calls.append(len(items))
        if len(items) > 1 or items[0] == "c":
            raise OSError
        return [items[0].upper()]

    got = translate.translate_batch(["a", "b", "c"], service, lambda items: [x + "!" for x in items], sleep=lambda s: None)
    assert got == ["A", "B", "c!"] and calls == [3] * 4 + [1, 1, 1, 1]
    assert translate.translate_batch([], service) == [] and translate.translate_batch(["c"], service, sleep=lambda s: None) == [None]


def test_classifier_outputs(spark):
    import numpy as np

    df = classify.score(spark.createDataFrame([("aa",), (None,)], "t string"), F.col("t"), lambda: lambda texts: np.array([[len(t), 1.0] for t in texts]))
    got = df.select(classify.top_one(F.col("logits"), ["long", "short"]).alias("r"), classify.with_cutoffs(F.col("logits"), ["long", "short"], {"long": 1.5}).alias("c")).collect()
    assert [r.r.result for r in got] == ["long", "short"] and [r.c.event_type for r in got] == ["long", "-999"]
    assert abs(sum(got[0].r.model_outputs.values()) - 1) < 1e-9
    models = spark.createDataFrame([("m", {"b": 1, "a": 0}, {"a": 0.5})], "model_name string, event_type_nums map<string,int>, event_type_cutoffs map<string,double>")
    assert classify.model_labels(models, "m") == ["a", "b"] and classify.model_cutoffs(models, "m") == {"a": 0.5} and classify.field_of("env_binary") == "environmental_binary"
    with pytest.raises(RuntimeError):
        classify.model_labels(models, "other")


def test_similarity():
    def slow(a, b):
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        return t[-1][-1]

    for a, b in (("kitten", "sitting"), ("", "x"), ("abcabc", "cbacba"), ("nairobi city", "city of nairobi")):
        assert common_length(a, b) == slow(a, b) and ratio(a, b) == ratio(b, a)
    assert ratio("abc", "abc") == 100 and partial_ratio("nairobi", "in nairobi county") == 100 and weighted("city nairobi", "nairobi city") == 95 and weighted("", "a") == 0
