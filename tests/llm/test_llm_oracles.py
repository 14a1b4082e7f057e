"""Queries that SQL can express, against their SQL."""

import os

import duckdb
import pytest

from tidewire.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
@pytest.mark.parametrize("odd", [False, True])
def test_query_matches_sql(spark, sf_dir, odd_docs, labels, tmp_path, name, odd):
    if odd:
        sf_dir = str(tmp_path)
        odd_docs.where("doc_id IS NOT NULL").coalesce(1).write.parquet(f"{sf_dir}/documents.parquet")
        odd = [(1, 0, "system", "s" * 900), *((1, k, ("assistant", "user")[k % 2], "[INST] \\" * (k % 50)) for k in range(1, 80)), (2, None, None, None), (2, 1, "tool</s>", "x"), (2, 1, "user", "c"), (2, 1, "user", "c"), (None, 1, "assistant", "")]
        spark.createDataFrame(odd, "conv_id bigint, turn bigint, role string, text string").coalesce(1).write.parquet(f"{sf_dir}/conversations.parquet")
        labels.coalesce(1).write.parquet(f"{sf_dir}/labels.parquet")
    con = duckdb.connect()
    for source in ("documents", "labels", "conversations"):
        if os.path.exists(path := f"{sf_dir}/{source}.parquet"):
            con.sql(f"CREATE VIEW {source} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    got = queries.QUERIES[name](spark, sf_dir)
    cols = sorted(got.columns)
    want = con.sql(queries.ORACLE_SQL[name])
    assert sorted(want.columns) == cols
    assert sorted(map(repr, map(tuple, got.select(cols).collect()))) == sorted(map(repr, want.select(*cols).fetchall()))
