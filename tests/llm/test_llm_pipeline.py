"""The pipeline's rows against a plain version of its stages."""

import hashlib
from collections import Counter

import corpus_pipeline
from test_llm_operators import WORD, plain_components, plain_fingerprint
from tidewire.llm import decision_list, mixture, queries, secrets


def test_stages_against_plain_version(spark, sf_dir):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    kept = decision_list.apply_quality_rules(docs, decision_list.fit_quality_rules(docs, labels), keep=("doc_id", "text")).where("kept").collect()
    roots = plain_components([plain_fingerprint(r.text) for r in kept])
    first = {}
    for r in kept:
        root = roots[plain_fingerprint(r.text)]
        first[root] = min(r.doc_id, first.get(root, r.doc_id))
    ids = sorted(first.values())

    stage = docs
    for name, f in corpus_pipeline.STAGES[:3]:
        stage = f(spark, stage, sf_dir)
        assert stage.columns == list(corpus_pipeline.COLUMNS)
    got = {r.doc_id: r for r in stage.collect()}
    assert sorted(got) == ids
    plain = docs.where(docs.doc_id.isin(ids))
    spans = {r.doc_id: r for r in secrets.scan_secrets(plain, keep=("doc_id", "text")).collect()}
    for i, r in got.items():
        text, at, out = spans[i].text, 0, []
        for s in spans[i].spans:
            if s.start >= at:
                out += [text[at : s.start], "[SECRET]"]
            at = max(at, s.end)
        assert r.text == "".join([*out, text[at:]]) and r.n_chars == len(r.text)

    mixed = Counter({r.doc_id: r.taken // r.size for r in mixture.mix_sources(spark.createDataFrame(list(got.values()), docs.schema)).collect() if r.taken})
    library = Tokenizer.from_file(queries.vocabulary_path())
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert Counter(r.doc_id for r in rows) == mixed
    for r in rows:
        ids = library.encode(got[r.doc_id].text, add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(got[r.doc_id].text.encode()).hexdigest()


def test_near_dedup_keeps_the_marked_rows(spark):
    """Null and repeated ids with different texts are documents of their own; near copies go, whatever their id."""
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(60))
    rows = [(None, text(0)), (None, text(1)), (7, text(2)), (7, text(3)), (8, text(3)), (2, text(4)), (9, text(4)), (9, text(5))]
    docs = spark.createDataFrame([(i, t, "en", f"s{k}", len(t)) for k, (i, t) in enumerate(rows)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = Counter((r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, docs, None).collect())
    assert got == Counter([(None, text(0)), (None, text(1)), (7, text(2)), (7, text(3)), (2, text(4)), (9, text(5))])


def test_mixture_of_null_and_repeated_ids(spark):
    """Each row stands as often as its own plan says, also where its id is another's."""
    rows = [(None if k < 20 else 7, f"text {k} " + "word " * 30, "en", f"s{k % 2}", 5) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    want = Counter({r.text: r.taken // r.size for r in mixture.mix_sources(docs, keep=("doc_id", "text")).collect() if r.taken})
    assert Counter(r.text for r in corpus_pipeline.source_mixture(spark, docs, None).collect()) == want


def test_pipeline_odd_rows(spark, odd_docs, labels, tmp_path):
    for name, df in (("documents", odd_docs), ("labels", labels)):
        df.write.parquet(f"{tmp_path}/odd/{name}.parquet")
        df.limit(0).write.parquet(f"{tmp_path}/none/{name}.parquet")
    rows = corpus_pipeline.run(spark, f"{tmp_path}/odd").collect()
    assert {r.doc_id for r in rows} <= {r.doc_id for r in odd_docs.select("doc_id").collect()}
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
