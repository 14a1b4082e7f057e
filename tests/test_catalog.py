"""Every query against its SQL on the same tables."""

import os

import duckdb
import pytest

import __spark_entry__
from tidewire import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations clicks sales sale_lines clients client_changes vendors items stamps".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        if os.path.exists(f"{sf_dir}/{name}.parquet"):
            con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def comparable(rows):
    plain = lambda v: round(float(v), 9) if isinstance(v, float) else str(v) if hasattr(v, "isoformat") else v
    return sorted(repr(tuple(plain(v) for v in r)) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_matches_sql(spark, duck, sf_dir, name):
    got = catalog.QUERIES[name](spark, sf_dir)
    cols = sorted(got.columns)
    want = duck.sql(catalog.ORACLE_SQL[name])
    assert sorted(want.columns) == cols
    assert comparable(got.select(cols).collect()) == comparable(want.select(*[f'"{c}"' for c in cols]).fetchall())


def test_match_keys_of_whole_texts(spark, tmp_path):
    texts = {0: "word, " * 100 + "Cafe\u0301 ÀÉÎ - Straße!", 1: "x" * 300 + " İÑ_1", 2: None, 3: "short"}
    spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = dict(catalog.QUERIES["match_keys_whole"](spark, str(tmp_path)).select("doc_id", "key").collect())
    assert got == {0: "word " * 100 + "cafe aei straße", 1: "x" * 300 + " in_1", 2: "", 3: "short"}


def test_translation_up_to_the_cap_of_the_reference(spark, tmp_path):
    texts = {0: "mot " * 150 + "fin", 1: "a" * 900, 2: "petit texte"}
    spark.createDataFrame([(i, t, "fr") for i, t in texts.items()] + [(3, "English text", "en")], "doc_id bigint, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = dict(catalog.QUERIES["translate_cascade_whole"](spark, str(tmp_path)).select("doc_id", "maintext_translated").collect())
    assert got == {i: t[:800].upper() for i, t in texts.items()} | {3: None}


def same_as_sql(spark, folder, name, **rows):
    """The query's rows, held against its SQL on tables of ``rows``."""
    con = duckdb.connect()
    for table, df in rows.items():
        df.write.parquet(f"{folder}/{table}.parquet")
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    got = catalog.QUERIES[name](spark, str(folder))
    cols = sorted(got.columns)
    found = got.select(cols).collect()
    assert comparable(found) == comparable(con.sql(catalog.ORACLE_SQL[name]).select(*[f'"{c}"' for c in cols]).fetchall())
    return found


def test_translation_of_letters_without_a_capital(spark, tmp_path):
    """SQL capitalizes letter by letter, so that lengths stay."""
    texts = ["Straße " * 150, "ŉ ǰ ΐ ﬁ ﬃ ᾳ ᾲ ῷ ǆ ǅ ß ẞ ı i̇ և ẖ àéî", "ßßßßß"]
    docs = spark.createDataFrame([(i, t, "fr", "s") for i, t in enumerate(texts)], "doc_id bigint, text string, lang string, source string")
    found = same_as_sql(spark, tmp_path / "a", "translate_cascade_whole", documents=docs)
    assert {len(r.maintext_translated) for r in found} == {800, len(texts[1]), 5}
    pages = spark.createDataFrame([(1, "http://ß.fr/a?b=1", "x"), (2, "https://ŉß/ab", "x")], "page_id bigint, url string, html string")
    assert same_as_sql(spark, tmp_path / "b", "downloaded_pages", pages=pages)[0] is not None


def test_final_texts_of_empty_parts(spark, tmp_path):
    """SQL joins whatever language and text there are."""
    rows = [("en", ""), ("en", None), ("en", '\n"\n“”'), ("en", "\n" * 1300 + "x"), (None, "x"), ("", "x"), ("", ""), ('e"n\n', "x"), ("fr", "😀é" * 700), ("de", "a\x00b\r\n"), ("es", "e\u0301" * 601)]
    docs = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id bigint, text string, lang string")
    found = {r.doc_id: r.combined for r in same_as_sql(spark, tmp_path, "final_text_en", documents=docs)}
    assert found[0] == found[2] == found[3] == "en. " and found[1] is found[4] is None and found[5] == ". x"


def test_alternative_names_of_customers_with_the_numbers_of_countries(spark, tmp_path):
    """Only customer 1 stands for the country with more names, whatever numbers others have."""
    keys = [1, 2, 3, 239880, 239881, 6252001]
    customer = spark.createDataFrame([(k, k % 2) for k in keys], "c_custkey bigint, c_nationkey int")
    nation = spark.createDataFrame([(0, "KENYA"), (1, "PERU")], "n_nationkey int, n_name string")
    found = same_as_sql(spark, tmp_path, "alternative_names", customer=customer, nation=nation)
    assert sorted(r.alt_name_length for r in found) == [2] * 5 + [4]


def test_entry_points(spark, sf_dir):
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).count() > 0
    assert catalog.QUERIES["reconciled_locations"](spark, sf_dir).count() > 0
