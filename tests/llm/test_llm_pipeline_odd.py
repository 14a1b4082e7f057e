"""The stages on odd rows, exactly: nulls, repeats, ties, very long texts and clashing names."""

from collections import Counter

import corpus_pipeline
from test_llm_operators import plain_components, plain_fingerprint
from test_llm_repeats import plain_mixture
from tidewire.llm import decision_list, secrets

COLUMNS = list(corpus_pipeline.COLUMNS)


def rows_of(df):
    return [tuple(r) for r in df.select(*COLUMNS).collect()]


def test_quality_stage_keeps_all_that_pass(spark, odd_docs, labels, sf_dir, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for docs, folder in ((odd_docs, str(tmp_path)), (spark.read.parquet(f"{sf_dir}/documents.parquet"), sf_dir)):
        got = Counter(rows_of(corpus_pipeline.quality_rules(spark, docs, folder)))
        rules = decision_list.fit_quality_rules(docs, spark.read.parquet(f"{folder}/labels.parquet"))
        passes = {r.text: r.kept for r in decision_list.apply_quality_rules(docs, rules, keep=("text",)).collect()}
        assert got == Counter(r for r in rows_of(docs) if passes[r[1]])
    assert len(got) > 100


def test_dedup_stage_keeps_one_row_of_every_group(spark, odd_docs):
    rows, got = rows_of(odd_docs), rows_of(corpus_pipeline.near_dedup(spark, odd_docs, None))
    assert not Counter(got) - Counter(rows)  # rows as they were, none of them twice
    roots = plain_components([plain_fingerprint(r[1]) for r in rows])
    groups = {}
    for r in rows:
        groups.setdefault(roots[plain_fingerprint(r[1])], []).append(r)
    assert Counter(roots[plain_fingerprint(r[1])] for r in got) == Counter(dict.fromkeys(groups, 1))
    for r in got:
        ids = [x[0] for x in groups[roots[plain_fingerprint(r[1])]] if x[0] is not None]
        assert r[0] == (min(ids) if ids else None)


def test_secret_stage_keeps_every_row(spark, odd_docs):
    spans = {}
    for r in secrets.scan_secrets(odd_docs, keep=("doc_id", "text", "source")).collect():
        spans[r.doc_id, r.text, r.source] = [s for s in r.spans if s.kind != "owned" or not s.copied]
    want = Counter()
    for i, text, lang, source, n_chars in rows_of(odd_docs):
        at, out, found = 0, [], spans[i, text, source]
        for s in found:
            out += [text[at : s.start], "[SECRET]"] if s.start >= at else []
            at = max(at, s.end)
        masked = "".join([*out, text[at:]]) if found else text
        want[i, masked, lang, source, len(masked) if found else n_chars] += 1
    assert Counter(rows_of(corpus_pipeline.secret_scans(spark, odd_docs, None))) == want


def test_mixing_stage_takes_rows_by_their_plan(spark, odd_docs):
    plan = plain_mixture([(r[0], r[1], r[3]) for r in rows_of(odd_docs)])
    got = Counter()
    for i, text, _, source, _ in rows_of(corpus_pipeline.source_mixture(spark, odd_docs, None)):
        got[i, text, source] += len((text or "").split())
    assert got == Counter({k: v for k, v in plan.items() if v})


def test_token_stage_has_a_row_for_each(spark, odd_docs):
    got = corpus_pipeline.bpe_tokens(spark, odd_docs, None).collect()
    assert Counter((r.doc_id, r.source) for r in got) == Counter((r[0], r[3]) for r in rows_of(odd_docs))
    assert all((r.n_tokens == 0) == (r.ids_sha256 == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855") for r in got)
