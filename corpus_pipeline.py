"""The corpus pipeline: five of the training-data operators, one after another, over documents.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
stage's docs; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirgate.llm import jaccard, mixing, packing, pii, quality
from weirgate.llm.common import materialize
from weirgate.llm.queries import tokenizer_path

#: The columns that stages hand on.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Pipeline near duplicates: words in a shingle, least similarity.
SHINGLE, SIMILARITY = 5, "0.8"


def _documents(df: DataFrame) -> DataFrame:
    """The columns of documents, with n_chars made anew from the text."""
    out = df.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long"))
    return out.select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line-first rules keep, without the lines that fail."""
    judged = quality.measures(docs.select(*COLUMNS)).where("kept")
    return _documents(judged.withColumn("text", F.col("clean_text")))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the least id."""
    docs = docs.select(*COLUMNS)
    others, repeated = jaccard.others_of_groups(jaccard.link_components(docs, k=SHINGLE, threshold=SIMILARITY))
    named = docs.withColumn("text_hash", F.xxhash64("text"))

    def those(names: DataFrame, how: str) -> DataFrame:
        names = names.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"))
        return named.join(names, (F.col("text_hash") == F.col("h")) & F.col("doc_id").eqNullSafe(F.col("d")), how)

    if repeated.isEmpty():
        return those(others, "left_anti").select(*COLUMNS)
    single = those(repeated, "left_semi").dropDuplicates(["doc_id", "text_hash"])
    return those(others.union(repeated), "left_anti").union(single).select(*COLUMNS)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every span of personal data replaced by its kind."""
    found = pii.find(docs.select(*COLUMNS))
    return _documents(found.withColumn("text", pii.redact(F.col("text"), F.col("spans"))))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight takes them."""
    mixed = mixing.mix(docs.select(*COLUMNS)).where("copies > 0")
    return mixed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of documents and their places in sequences of at most 1024 tokens."""
    return packing.pack(docs, tokenizer_path(), 1024)


STAGES = [
    ("quality", quality_rules),
    ("near_duplicates", one_of_each_group),
    ("personal_data", redact_personal_data),
    ("mixture", mix_sources),
    ("packing", pack_sequences),
]

#: Tokens, trees and components are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
