"""The queries ``opN_<name>`` and their SQL; each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm import ann_partitions, bpe_automaton, chat_windows, decision_list, filter_audit, mixture, oracles, quality_nbsvm, secrets, sentence_spans, simhash_anchors, time_partitions, toxicity_ftrl, wrapper_induction
from tidewire.llm.common import table


def op1_quality_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_nbsvm.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_toxicity_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_ftrl.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")
    return out.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(secrets.joined(F.col("base")), 256).alias("base_sha256"), secrets.joined(F.col("spans")).alias("spans"), "n_live", "n_example",
    )


def secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts and verdicts behind op2, by value."""
    return secrets.secret_values(table(spark, sf_dir, "documents"))


def op4_wrapper_induction(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = wrapper_induction.extract_main_text(table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op5_ann_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_partitions.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op6_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_spans.remove_repeated_spans(table(spark, sf_dir, "documents"))


def op7_simhash_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_anchors.near_duplicates(table(spark, sf_dir, "documents"))


def op8_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixture.mix_sources(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


def mixture_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where op8's tree deals every repeat of a document: its output shard and its random place there."""
    out = mixture.mix_sources(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.posexplode("shards").alias("pass", "shard"), "place")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rules = decision_list.fit_quality_rules(docs, table(spark, sf_dir, "labels"))
    out = decision_list.apply_quality_rules(docs, rules)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op10_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe_automaton.encode_decode(table(spark, sf_dir, "documents"), vocabulary_path())
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_time_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clicks up to May in a new folder, then all of them in the same; what stands there in the end."""
    clicks = table(spark, sf_dir, "clicks")
    limit = 1 + clicks.count() // time_partitions.PARTS
    moment = time_partitions.click_moment(F.col("ts"), F.col("click_id"))
    folder, early = time_partitions.new_folder(spark), F.col("arrived_at") < F.lit("2024-05-01 00:00:00").cast("timestamp_ntz")
    time_partitions.rewrite(clicks.where(early), folder, limit, moment, ("arrived_at", "click_id"))
    files = time_partitions.rewrite(clicks, folder, limit, moment, ("arrived_at", "click_id"))
    return time_partitions.file_report(clicks, folder, files, "click_id", ~early)


def op12_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts are made of the template's own marks."""
    text = "</s>[INST] ok [/INST]"
    marks = spark.createDataFrame([(-1, 0, "user", text), (-1, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(marks)
    return chat_windows.conversation_digests(chat_windows.format_conversations(turns))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_quality_nbsvm": op1_quality_nbsvm,
    "op2_secret_scans": op2_secret_scans,
    "op3_toxicity_ftrl": op3_toxicity_ftrl,
    "op4_wrapper_induction": op4_wrapper_induction,
    "op5_ann_partitions": op5_ann_partitions,
    "op6_sentence_spans": op6_sentence_spans,
    "op7_simhash_anchors": op7_simhash_anchors,
    "op8_source_mixture": op8_source_mixture,
    "op9_quality_rules": op9_quality_rules,
    "op10_bpe_automaton": op10_bpe_automaton,
    "op11_time_partitions": op11_time_partitions,
    "op12_chat_windows": op12_chat_windows,
    "op13_filter_audit": op13_filter_audit,
    "secret_ownership": secret_ownership,
    "mixture_shards": mixture_shards,
}

#: The others rest on learned models, XXH64 or a vocabulary; tests/llm holds them against brute force.
ORACLE_SQL: dict[str, str] = {"op2_secret_scans": oracles.SECRET_SCANS, "secret_ownership": oracles.SECRET_OWNERSHIP, "op6_sentence_spans": oracles.SENTENCE_SPANS, "op8_source_mixture": oracles.SOURCE_MIXTURE, "op12_chat_windows": oracles.CHAT_WINDOWS, "op13_filter_audit": oracles.FILTER_AUDIT}
