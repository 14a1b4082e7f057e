"""A training corpus from ``documents``: filter, deduplicate, redact, mix, tokenize.

Each stage takes (spark, docs, sf_dir); all but the last return the columns of ``documents``. Other
columns are left out, so clashing names do no harm; texts of any length are taken whole; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm import bpe_automaton, decision_list, mixture, secrets, simhash_anchors
from tidewire.llm.common import numbered, scratch, table
from tidewire.llm.queries import vocabulary_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go; so do null and empty texts. Repeated rows stay or go alike."""
    rules = decision_list.fit_quality_rules(docs, table(spark, sf_dir, "labels"))
    return decision_list.apply_quality_rules(docs, rules, keep=COLUMNS).where("kept").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays, one of its smallest doc_id.

    Rows are told apart by their place, so null and repeated ids of different texts stay. Null and
    empty texts are one group.
    """
    return simhash_anchors.near_duplicates(docs, keep=COLUMNS).where("kept").select(*COLUMNS)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked, and n_chars follows the text; a token that an owner repeats everywhere is left alone.

    Every row stays; null texts stay null.
    """
    spans = secrets.scan_secrets(docs, keep=COLUMNS).withColumn("spans", F.filter("spans", lambda x: (x["kind"] != "owned") | ~x["copied"]))
    found = F.size("spans") > 0
    # A name of its own: inside a lambda, "text" would mean a column made here under that name.
    masked = spans.withColumn("masked", F.when(found, secrets.redact(F.col("text"), F.col("spans"))).otherwise(F.col("text")))
    n_chars = F.when(found, F.length("masked").cast("long")).otherwise(F.col("n_chars"))
    return masked.select("doc_id", F.col("masked").alias("text"), "lang", "source", n_chars.alias("n_chars"))


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document stands as often as the mix takes it, in random order within its output shard.

    Null and empty texts have no words and are never taken; repeated rows are each taken by their own plan.
    """
    rows = numbered(docs.select(*COLUMNS), "mixed")  # ids may be null or repeat
    plan = mixture.mix_sources(rows, keep=("rid",)).where(F.size("shards") > 0).select("rid", "shards", "place")
    repeats = rows.join(plan, "rid").select(*COLUMNS, F.posexplode("shards").alias("pass", "shard"), "place")
    return repeats.repartition("shard", F.pmod("place", F.lit(64))).sortWithinPartitions("shard", F.xxhash64("place", "pass")).select(*COLUMNS)


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text, one row per document of the mix; none for an empty mix."""
    out = bpe_automaton.encode_decode(docs, vocabulary_path(), keep=("doc_id", "source"))
    return out.select("doc_id", "source", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_dedup),
    ("secret scans", secret_scans),
    ("mixing sources to target weights", source_mixture),
    ("BPE encoding and decoding", bpe_tokens),
]
#: SQL can't express learned rules, XXH64 fingerprints or tokens; tests/llm holds the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each one's rows written as Parquet and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = scratch(docs, f"stage-{k}")
    return docs
