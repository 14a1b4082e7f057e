"""Texts of very many secrets, and verdicts by owners and repositories."""

import re
import time

import pytest
from pyspark.sql import functions as F
from test_llm_operators import plain_base

from tidewire.llm import secrets

DOCS = "doc_id bigint, text string, source string"


@pytest.mark.parametrize("n", [1, 511, 512, 513, 1600])
def test_many_matches_are_placed_and_masked(spark, n):
    parts = ["é token = 'abcdefgh%d' and " % k if k % 3 else "x%032x y " % k if k % 2 else "password=%040x " % k for k in range(n)]
    text = "start " + "".join(parts) + "end"
    df = spark.createDataFrame([(0, text, "s"), (1, None, "s"), (2, "", "s")], DOCS)
    out = secrets.scan_secrets(df, keep=("doc_id", "text"))
    got = {r.doc_id: r for r in out.select("doc_id", secrets.joined(F.col("base")).alias("base"), secrets.redact(F.col("text"), F.col("spans")).alias("masked"), "spans").collect()}
    assert got[0].base.split(",") == plain_base(text) and got[1].masked is None and got[2].masked == ""
    at, want = 0, []
    for s in got[0].spans:
        if s.start >= at:
            want += [text[at : s.start], "[SECRET]"]
        at = max(at, s.end)
    assert got[0].masked == "".join([*want, text[at:]])


def test_work_grows_with_the_matches(spark):
    took = []
    for n in (10_000, 40_000):
        df = spark.createDataFrame([(0, "token=abcdefgh%d " * n % tuple(range(n)), "s")], DOCS)
        began = time.time()
        out = df.select(secrets._found(F.col("text"), "token", "assign", secrets.ASSIGN, 2).alias("s"), "text")
        masked = out.select(secrets.redact(F.col("text"), F.col("s")).alias("m"), F.size("s").alias("n")).collect()[0]
        took.append(time.time() - began)
        assert masked.n == n and masked.m == "[SECRET] " * n
    assert took[1] < 12 * took[0] + 5


def test_verdicts_by_owners_and_repositories(spark):
    live, copied, example = "Zx9fQ2Lm7Rt4Kp1Vb8Nw6Yc3", "Aa1Bb2Cc3Dd4Ee5Ff6Gg7Hh8", "Qq1Ww2Ee3Rr4Tt5Yy6Uu7Ii8"
    rows = [(0, f"see {live} here", "a"), (1, f"also {live}", "b"), (1, f"again {live}", "b")]
    rows += [(100 + k, f"made with {copied} by us", "a") for k in range(60)] + [(500 + k, f"sample {example} text", f"o{k}") for k in range(4)] + [(None, f"token={'k' * 9}", None)]
    df = spark.createDataFrame(rows, DOCS)
    names = {r.h: r.v for r in spark.createDataFrame([(v,) for v in (live, copied, example, "k" * 9)], "v string").select("v", F.sha2("v", 256).alias("h")).collect()}
    got = {names[r.hash]: (r.n_owners, r.n_repos, r.verdict) for r in secrets.secret_values(df).collect()}
    assert got == {live: (2, 2, "live"), copied: (1, 60, "copied"), example: (4, 4, "example"), "k" * 9: (1, 1, "live")}
    spans = {r.doc_id: r.spans for r in secrets.scan_secrets(df).collect()}
    assert [s.copied for s in spans[0]] == [False] and [s.copied for s in spans[100]] == [True] and spans[500] == []
    assert secrets.secret_values(df.limit(0)).count() == 0


def test_pipeline_leaves_copied_boilerplate(spark):
    import corpus_pipeline

    token = "Aa1Bb2Cc3Dd4Ee5Ff6Gg7Hh8"
    docs = spark.createDataFrame([(k, f"page {k} made with {token}", "en", "a", 5) for k in range(60)] + [(90, f"my key Zx9fQ2Lm7Rt4Kp1Vb8Nw6Yc3, token = {token}", "en", "b", 5)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = {r.doc_id: r for r in corpus_pipeline.secret_scans(spark, docs, None).collect()}
    assert all(got[k].text == f"page {k} made with {token}" and got[k].n_chars == 5 for k in range(60))
    assert got[90].text == "my key [SECRET], [SECRET]" and got[90].n_chars == len(got[90].text)
    assert not re.search("[0-9]", got[90].text)


def test_many_matches_in_one_text(spark):
    """Thousands of matches of both sorts: tokens are compared with the spans near them, with the same result as with all."""
    words = [w for i in range(1500) for w in (f"password={'p' * (i % 5)}assw0rd{i:06d}", f"A{'b1' * 11}{i:04d}", f"token: x1y2{i:030d}z", "plain")]
    text = " ".join(words)
    got = secrets.candidates(spark.createDataFrame([(1, text, "s")], "doc_id bigint, text string, source string"), keep=("doc_id",)).first()
    base = [(x.start, x.end) for x in got.base]
    tokens = [(m.start(), m.end()) for m in re.finditer(r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9+/_-]*[A-Za-z])[A-Za-z0-9_-]{20,}(?![A-Za-z0-9+/_-])", text)]
    assert [(x.start, x.end) for x in got.more] == [(a, b) for a, b in tokens if not any(a < d and c < b for c, d in base)] and len(got.more) == 1500
