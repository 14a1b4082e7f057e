"""Reconciliation as a chain of tables: hand-built articles, each decision by its own rows."""

import pytest
from pyspark.sql import functions as F

from tidewire.functions import placecolumns as C
from tidewire.functions.similarity import weighted
from tidewire.functions.text import normalize_for_match
from tidewire.operators import grounding, kb, unit_search
from tidewire.plans.staging import staged
from tidewire.schemas import LOCATION

KB = [
    ("Kenya", "Nairobi", "Westlands", "KEN"), ("Kenya", "Nairobi", "Kasarani", "KEN"), ("Kenya", "Mombasa", "Nyali", "KEN"), ("Uganda", "Kampala", "Central Division", "UGA"), ("Ukraine", "Odesa Oblast", "Odesa", "UKR"),
    ("Ukraine", "Kyiv", "", "UKR"), ("Ecuador", "Loja", "Loja", "ECU"), ("Peru", "Loreto", "Maynas", "PER"), ("Ecuador", "Loreto", "", "ECU"), ("Côte d'Ivoire", "Bouaké", "", "CIV"), ("Burkina Faso", "Centre", "Ouagadougou", "BFA"),
]
SCHEMA = f"_id string, gemini_locations map<string,{LOCATION}>, gemini_locations_normalized map<string,{LOCATION}>, cliff_locations map<string,array<string>>"
KB_SCHEMA = "Admin0 string, Admin1 string, Admin2 string, Admin0_ISO3 string"


def place(level="Unknown", a0="Unknown", a1="Unknown", a2="Unknown"):
    return (level, a0, a1, a2)


ARTICLES = {
    "units": ({"Kenya": place("country"), "Nairobi County": place("county", "Kenya"), "Kyiv": place("city", "Ukraine"), "Cote d'Ivoire": place("country")}, {}),
    "skips": ({"Africa": place("region"), "Indian Ocean Bay": place("other", "Kenya"), "Zanzibar Region": place("region", "Kenya"), "Atlantis": place("city", "Nowhere")}, {}),
    "blank": ({"north east": place(), "unknown": place(), " ": place()}, {}),
    "by code": ({"Loreto": place("state")}, {"PER": ["Loreto"]}),
    "crimea": ({"Crimea": place()}, {"AUS": ["Crimea"]}),
    "additions": ({"Nairobi": place("state", "Kenya"), "Nairobi Province": place("province", "Kenya")}, {"KEN": ["Nyali", "Mombasa", "Nairobi", "Lake Sea", "Nowhere"], "XXX": ["Loja"]}),
    "none": (None, None),
    "empty": ({}, {}),
    "misspelled": ({"Kampalla": place("city", "Uganda"), "Ouagadougouu": place("city", "Burkina Faso"), "Odessa": place("city", "Ukraine", "Odesa Oblas")}, {}),
    "one code names": ({"Peru": place("country", "Ecuador")}, {"PER": ["Peru"], "ECU": ["Loja"]}),
    "similar country": ({"Ukrain": place("country")}, {}),
    "no country": ({"Atlantia": place("nation")}, {}),
    "only code": ({"Atlantis Town": place("city")}, {"KEN": ["Elsewhere"]}),
    "two codes": ({"Loja": place("city")}, {"PER": ["Lima"], "ECU": ["Quito"]}),
}


@pytest.fixture(scope="module")
def articles(spark):
    # One place at a time: maps of many entries would lose their order on the way.
    return spark.createDataFrame([(i, g, None, c) for i, (g, c) in ARTICLES.items()], SCHEMA)


@pytest.fixture(scope="module")
def units(spark):
    return spark.createDataFrame(KB, KB_SCHEMA)


@pytest.fixture(scope="module")
def reconciled(articles, units):
    return {r._id: r.asDict(recursive=True) for r in unit_search.reconcile_articles(articles, units).collect()}


@pytest.fixture(scope="module")
def prepared(articles, units):
    return grounding.prepare(articles, units)


def ladder(r, name):
    return tuple(r["reconciled_locations"][name].values())


def test_country_and_units(reconciled):
    r = reconciled["units"]
    assert ladder(r, "Kenya") == place("ADMIN0", "Kenya") and ladder(r, "Nairobi County") == place("ADMIN1", "Kenya", "Nairobi") and ladder(r, "Kyiv") == place("ADMIN1", "Ukraine", "Kyiv")
    assert ladder(r, "Cote d'Ivoire") == place("ADMIN0", "Côte d'Ivoire")
    assert r["reconciled_locations_meta"]["status"] == "OK" and r["reconciled_locations_meta"]["doc_context_isos"] == ["CIV", "KEN", "UKR"]
    evidence = r["reconciled_locations_evidence"]["Nairobi County"]
    assert (evidence["matched_value"], evidence["matched_level"], evidence["iso_set"], evidence["kind"]) == ("Nairobi", "ADMIN1", ["KEN"], "cleaned") and "Kenya" in r["reconciled_locations_match_terms"]


def test_skips_and_fallbacks(reconciled):
    r = reconciled["skips"]
    assert set(r["reconciled_locations"]) == {"Indian Ocean Bay", "Zanzibar Region", "Atlantis"}
    assert ladder(r, "Indian Ocean Bay") == place("UNKNOWN", "Kenya") and ladder(r, "Zanzibar Region") == place("ADMIN1", "Kenya")
    assert r["reconciled_locations_debug"] == {"Indian Ocean Bay": "feature_skip", "Zanzibar Region": "no_match_keep_gemini", "Atlantis": "no_match_keep_gemini"}
    assert {x["location"]: x["reason"].split()[0] for x in r["reconciled_locations_revisit"]} == {"Zanzibar Region": "admin1", "Atlantis": "admin0"}
    assert r["reconciled_locations_meta"]["status"] == "REVISIT"
    blank = reconciled["blank"]
    assert blank["reconciled_locations"] == {} and blank["reconciled_locations_meta"]["status"] == "OK" and blank["reconciled_locations_match_terms"] == []


def test_codes_restrict_matches(reconciled):
    assert ladder(reconciled["by code"], "Loreto") == place("ADMIN1", "Peru", "Loreto")
    assert ladder(reconciled["crimea"], "Crimea")[1] == "Unknown"
    assert ladder(reconciled["two codes"], "Loja") == place("ADMIN2", "Ecuador", "Loja", "Loja")  # hinted as a city, of the only code that has it


def test_country_branches(reconciled):
    assert ladder(reconciled["one code names"], "Peru") == place("ADMIN0", "Peru")  # the only code that names it, not the stated country
    for i, name, country, method in (("similar country", "Ukrain", "Ukraine", "country_resolve"), ("no country", "Atlantia", "Atlantia", "country_unresolved")):
        assert ladder(reconciled[i], name) == place("ADMIN0", country) and reconciled[i]["reconciled_locations_debug"] == {name: method}
    assert ladder(reconciled["only code"], "Atlantis Town") == place("ADMIN2", "Kenya")  # anchored, and left as it was said


def test_misspelled_units(reconciled):
    r = reconciled["misspelled"]
    assert ladder(r, "Ouagadougouu") == place("ADMIN2", "Burkina Faso", "Centre", "Ouagadougou")
    assert ladder(r, "Kampalla") == place("ADMIN2", "Uganda")  # no word in common, and less than 95 alike
    assert ladder(r, "Odessa") == place("ADMIN2", "Ukraine", "Odesa Oblast")  # its name is too unlike that of its exonym, its unit is respelled
    assert r["reconciled_locations_evidence"]["Ouagadougouu"]["score"] == pytest.approx(weighted("ouagadougouu", "ouagadougou"))
    assert r["reconciled_locations_debug"]["Ouagadougouu"] == "fuzzy_admin2"


def test_additions_and_duplicates(reconciled):
    r, meta = reconciled["additions"], reconciled["additions"]["reconciled_locations_meta"]
    assert set(r["reconciled_locations"]) == {"Nairobi", "Nyali", "Mombasa"} and ladder(r, "Nyali") == place("ADMIN2", "Kenya", "Mombasa", "Nyali")
    assert meta["n_reconciled"] == meta["n_reconciled_before_dedup"] - meta["n_dedup_dropped"] == 3 and meta["n_added_cliff_only"] == 2
    assert "Nairobi Province" in r["reconciled_locations_evidence"] and meta["timestamp_utc"]
    for i in ("none", "empty"):
        assert reconciled[i]["reconciled_locations_meta"]["status"] == "NO_LOCATIONS" and reconciled[i]["reconciled_locations"] == {}


def test_codes_and_their_sources(prepared):
    rows = {(r.doc, r.name): r for r in prepared.asked.collect()}
    got = {k: (r.iso_source, list(r.isos), r.strict, r.admin0) for k, r in rows.items()}
    assert got["crimea", "Crimea"] == ("cliff_name_dropped_for_crimea", [], False, "Unknown")
    assert got["units", "Nairobi County"] == ("gemini_admin0", ["KEN"], True, "Kenya")
    assert got["two codes", "Loja"] == ("doc_context", ["ECU", "PER"], True, "Unknown")
    assert got["by code", "Loreto"] == ("gemini_admin0", ["PER"], True, "Peru")  # the article's only code gave the country before


def test_a_code_that_names_the_place_anchors_it(spark, prepared):
    """Listed under one of several codes: that code counts, and gives the country."""
    rows = prepared.asked.where("doc = 'two codes'").withColumns({"country_isos": F.array().cast("array<string>"), "named": F.array(F.lit("ECU"))}).drop("isos", "iso_source", "strict", "strong")
    named = rows.select("doc", "position", "named")
    got = grounding.anchored(grounding.constraints(rows.drop("named"), named), prepared.units.keyed).collect()
    assert [(r.iso_source, list(r.isos), r.admin0, r.ckey, r.strong) for r in got] == [("cliff_name", ["ECU"], "Ecuador", "ecuador", True)]


def test_canonical_units(prepared):
    rows = prepared.asked.where("doc = 'misspelled'")
    got = {r.name: (r.admin1, r.canonical1) for r in unit_search.canonical_units(rows, prepared.units).collect()}
    assert got["Odessa"] == ("Odesa Oblast", True) and got["Kampalla"] == ("Unknown", False)


def test_query_variants(spark, units):
    keyed = kb.with_keys(units)
    rows = [("1", 0, "Republic of Odesa", "Odesa Oblast", "Unknown"), ("2", 0, "Kiev", "Unknown", "Unknown"), ("3", 0, "Lower Central Division Kampala Nairobi Westlands", "Unknown", "Unknown"), ("4", 0, "Loja", "Loja", "Loja City")]
    df = spark.createDataFrame(rows, "doc string, position int, name string, admin1 string, admin2 string")
    df = df.withColumn("key", normalize_for_match(F.col("name"))).withColumns({f"key{i}": F.when(F.col(f"admin{i}") != "Unknown", normalize_for_match(F.col(f"admin{i}"))) for i in (1, 2)})
    got = {}
    for r in sorted(unit_search.query_variants(df, keyed).collect(), key=lambda r: (r.doc, r.at)):
        got.setdefault(r.doc, []).append((r.text, r.kind))
    assert got["1"] == [("Republic of Odesa", "surface"), ("odesa", "cleaned"), ("Odesa Oblast", "alias_admin1")]
    assert got["2"] == [("kyiv", "surface")]
    # Three words of each text, those that fewest units hold first, longer ones before shorter ones.
    assert got["3"] == [("Lower Central Division Kampala Nairobi Westlands", "surface"), ("division kampala nairobi westlands", "cleaned"), ("westlands", "token"), ("division", "token"), ("kampala", "token")]
    assert got["4"] == [("Loja", "surface"), ("Loja City", "alias_admin2")]


def test_additions_stop_at_the_cap(spark):
    rows = [("Land", f"Unit {k}", f"Place {k:02d}", "LAN") for k in range(40)]
    known = grounding.index_units(kb.with_keys(spark.createDataFrame(rows, KB_SCHEMA)))
    articles = spark.createDataFrame([("1", None, None, {"LAN": [f"Place {k:02d}" for k in range(40)]})], SCHEMA)
    got = grounding.additions(grounding.geoparsed(articles), grounding.mentions_of(articles, known.keyed), known).orderBy("added_at").collect()
    assert [r.name for r in got] == [f"Place {k:02d}" for k in range(grounding.MOST_ADDED)]


def test_most_similar_against_all_values(spark, prepared):
    names = ["kampalla", "lojja", "nairobi county", "westland", "loreto region", "zzz", "central division x", "odesa oblast", "peruu"]
    asked = [(n, isos, strict) for n in names for isos in ([], ["KEN"], ["ECU", "PER"], ["ZZZ"]) for strict in (False, True)]
    got = {(r.level, r.key, tuple(r.isos), r.strict): (r.value, r.score) for r in grounding.most_similar(spark.createDataFrame(asked, "key string, isos array<string>, strict boolean"), prepared.units, (0, 1, 2), F.col("strict"), 80.0).collect()}
    keyed = prepared.units.keyed.collect()
    want = {}
    for level, name in enumerate(grounding.LEVELS):
        for key, isos, strict in asked:
            codes = {r.Admin0_ISO3 for r in keyed if r[name]} & set(isos)
            some = [(r[name], r[f"{name}_norm"]) for r in keyed if r[name] and (r.Admin0_ISO3 in codes if codes else not isos or not strict)]
            best = min(((-weighted(key, k), v) for v, k in some), default=(0, None))
            if -best[0] >= 80:
                want[level, key, tuple(isos), strict] = (best[1], pytest.approx(-best[0]))
    assert got == want and len(got) > 20


def test_texts_are_settled_by_high_scores_first(spark, prepared, monkeypatch):
    names = ["kampala", "kampalla", "lojja", "nairobi county", "westland", "loreto region", "central division", "central division x", "odesa", "odesa oblast", "peruu", "zzz"]
    asked = spark.createDataFrame([(n, isos) for n in names for isos in ([], ["KEN"], ["ECU", "PER"])], "key string, isos array<string>")
    cutoffs, similar_pairs = [], grounding.simjoin.similar_pairs
    monkeypatch.setattr(grounding.simjoin, "similar_pairs", lambda q, i, c: (cutoffs.append(c), similar_pairs(q, i, c))[1])
    found = lambda: sorted(map(repr, grounding.most_similar(asked, prepared.units, (1, 2), False, 80.0).collect()))
    once = found()
    monkeypatch.setattr(grounding, "MANY", 0)
    assert found() == once and len(once) >= 20 and cutoffs == [80.0, *grounding.SETTLING, 80.0]


def test_a_hinted_level_behind_the_other_is_found_below_the_threshold(spark):
    """It is chosen and fails, whatever the other level scores; of a text without such a hint the other level's unit counts."""
    one, two, key, level = "karamoja dalt", "karamoja sel", "karamoja delta", grounding.MATCH
    known = grounding.index_units(kb.with_keys(spark.createDataFrame([("Land", one, two, "LAN"), ("Land", "Other", "Qqqq", "LAN")], KB_SCHEMA)))
    assert weighted(key, one) - unit_search.HINT_POINTS <= weighted(key, two) < level <= weighted(key, one)
    texts = spark.createDataFrame(
        [(str(i), 0, 0, key, key, one, "surface", None, ["LAN"], True, False, None, None, False, i or None) for i in range(3)],
        "doc string, position int, at int, text string, key string, name_key string, kind string, held long, isos array<string>, strict boolean, strong boolean, ckey string, ukey string, tight boolean, likely int",
    )
    got = {r.doc: r.hit.value for r in unit_search.similar_hits(texts, known, grounding.unit_rows(known.keyed, (1, 2)), level).collect()}
    assert got == {"0": one, "1": one}


def test_an_index_holds_the_levels_that_are_looked_up(spark):
    """Texts are looked up among countries without any postings of their units."""
    known = grounding.index_units(kb.with_keys(spark.createDataFrame(KB, KB_SCHEMA)))
    assert not known.made
    found = grounding.resolve_countries(spark.createDataFrame([("Kenyaa",), ("Nyalii",)], "text string"), known).collect()
    assert {r.text: r.how for r in found} == {"Kenyaa": "fuzzy", "Nyalii": "no_match"} and list(known.made) == [(0,)]
    assert {r.key for r in known.made[0,].postings.select("key").collect()} == {normalize_for_match_of(r[0]) for r in KB}


def normalize_for_match_of(name):
    return name.lower().replace("ô", "o").replace("'", " ")


def test_staged_tables_are_as_large_as_their_rows(spark):
    """Spark broadcasts what seems small: equal and similar names must not pack a table to a tenth of its size."""
    df = spark.range(20_000).select("id", F.lit("Ouagadougou, Burkina Faso").alias("name"))
    table = staged(df, "equal")
    assert table.count() == 20_000 and int(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) > 20_000 * 25


def test_first_rows(spark, units):
    keyed = kb.with_keys(units)
    asked = [("Loreto", [], False, None, None), ("Loreto", ["PER"], False, None, None), ("loreto", ["ECU"], True, None, None), ("Loreto", ["KEN"], True, None, None), ("Loreto", ["KEN"], False, "Peru", None), ("Nairobi", [], False, None, "Nairobi")]
    wanted = spark.createDataFrame(asked, "value string, isos array<string>, strict boolean, country string, unit string")
    got = {(r.value, tuple(r.isos), r.strict, r.country): (r.Admin0, r.Admin2) for r in grounding.first_rows(wanted, keyed, 1).collect()}
    assert got == {("Loreto", (), False, None): ("Ecuador", ""), ("Loreto", ("PER",), False, None): ("Peru", "Maynas"), ("loreto", ("ECU",), True, None): ("Ecuador", ""), ("Loreto", ("KEN",), False, "Peru"): ("Peru", "Maynas"), ("Nairobi", (), False, None): ("Kenya", "Kasarani")}


def test_least_score(spark):
    df = spark.createDataFrame([(False, False, True, 30), (False, False, True, 20), (False, False, True, 5), (False, False, False, 30), (True, False, True, 30), (False, True, True, 30)], "c boolean, a boolean, s boolean, n int")
    assert [r[0] for r in df.select(grounding.least_score(F.col("c"), F.col("a"), F.col("s"), F.col("n"))).collect()] == [95.0, 92.0, 88.0, 88.0, 85.0, 85.0]


def test_best_of_the_texts(spark):
    """The first text stays unless a later one is clearly better, or equal and the subunit that is hinted at."""
    schema = "doc string, position int, at int, likely int, hit struct<score:double,level:int,value:string>"
    rows = [("a", 0, 1, None, (90.0, 1, "x")), ("a", 0, 2, None, (90.1, 2, "y")), ("b", 0, 1, None, (90.0, 1, "x")), ("b", 0, 2, None, (90.2, 1, "y")), ("c", 0, 1, 2, (90.0, 1, "x")), ("c", 0, 2, 2, (89.95, 2, "y")), ("d", 0, 5, 2, (90.0, 2, "x")), ("d", 0, 2, 2, (90.0, 2, "y"))]
    got = {r.doc: r.hit.value for r in unit_search.best_hits(spark.createDataFrame(rows, schema)).collect()}
    assert got == {"a": "x", "b": "y", "c": "y", "d": "y"}


def test_place_names(spark):
    pairs = [("tuva republic", "tuva", True), ("kazarman", "jalal abad province", False), ("odesa", "odesa", True), ("ab", "abc", False), ("", "x", False), ("north", "north", False), ("nairoby", "nairobi", False), ("kampalla", "kampala", True)]
    df = spark.createDataFrame(pairs, "a string, b string, want boolean")
    assert all(r.got == r.want for r in df.withColumn("got", C.alias(F.col("a"), F.col("b"))).collect())
    one = spark.createDataFrame([("odessa", "odessa oblast", True), ("odessa", "nova odessa", False), ("odessa", "odessa dki", True), ("two words", "anything at all", True)], "a string, b string, want boolean")
    assert all(r.got == r.want for r in one.withColumn("got", C.words_may_match(F.col("a"), F.col("b"))).collect())
