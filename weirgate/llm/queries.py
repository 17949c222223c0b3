"""The thin queries over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, jaccard, language, mixing, ngram_lm, packing, pii, quality, sharding, vectors
from .common import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents by 4-word shingles with a Jaccard similarity of at least 0.85."""
    return jaccard.link_components(table(spark, sf_dir, "documents"), k=4, threshold="0.85").select("doc_id", "n_shingles", "component_id")


def op2_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of near equal bytes."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or shared_dir(spark)
    maps = f"{shared}/slot-maps/{hashlib.sha256(sf_dir.encode()).hexdigest()[:16]}"  # a map table for each data set
    placed = sharding.place(table(spark, sf_dir, "documents"), 16, maps=maps)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings with a cosine of at least 0.95."""
    return vectors.dedup(table(spark, sf_dir, "embeddings"), 0.95)


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to their sources' target weights."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs, keep_text=False).select("doc_id", "size", "source_size", "target", "taken")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures and the line-first verdict for all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.measures(docs).drop("text", "clean_text")


def tokenizer_path() -> str:
    """The contract's tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), 1024)


def op7_ngram_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a bigram trie of those whose id's checksum is no multiple of 10."""
    docs = table(spark, sf_dir, "documents")
    return ngram_lm.score(docs.select("doc_id", "text", (language.remainder(docs["doc_id"], 10) == 0).alias("held_out")))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests read back from the examples of all conversations and of one full of control strings."""
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    return chat.digests(chat.examples(rows))


def op9_pii_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base spans and all spans of personal data in all documents."""
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(k: int) -> Column:
        return F.size(F.filter("base_spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{pii.KINDS[k]}")

    return found.select("doc_id", *map(count, range(len(pii.BASE))), F.sha2(pii.joined(F.col("base_spans")), 256).alias("base_sha256"), pii.joined(F.col("spans")).alias("spans"))


def op10_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, learned from those whose id's checksum is no multiple of 5."""
    docs = table(spark, sf_dir, "documents")
    held_out = language.remainder(docs["doc_id"], 5) == 0
    model = language.learn(docs.where(~held_out).select("lang", "text"))
    out = language.predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", (language.remainder(out["doc_id"], 5) == 0).alias("held_out"), "lang_pred", "score")


QUERIES = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard,
        op2_virtual_slots,
        op3_vector_dedup,
        op4_mix_sources,
        op5_quality_rules,
        op6_best_fit_packing,
        op7_ngram_trie,
        op8_chat_format,
        op9_pii_boosting,
        op10_language_mixture,
    )
}
ORACLE_SQL: dict[str, str] = {"op5_quality_rules": quality.ORACLE, "op8_chat_format": chat.ORACLE}
