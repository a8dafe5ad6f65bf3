"""From raw documents to token ids: five stages, each over all that the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame with the columns of
``documents``; the last returns tokens. Between two stages the rows are written as Parquet.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import boilerplate, bpe, jaccard, langid, mixing
from strata.session import scratch_dir

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
# A document that shares less of its n-grams with the training sample is in none of its languages.
LEAST_COVERAGE = 0.85


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the classifier has learned; other scripts, noise and texts without a letter go."""
    model = langid.fit(docs.filter(~langid.held_out(F.col("doc_id"))))
    found = langid.identify(docs, model, coverage=True)
    return found.filter((F.col("lang_pred") != "und") & (F.col("coverage") >= LEAST_COVERAGE)).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that are boilerplate of their source; ``n_chars`` follows the text."""
    kept = boilerplate.drop_boilerplate(docs)
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    changed = F.when(F.col("n_dropped") > 0, length).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", changed).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id. Texts without words all stay.

    A document without an id is named by its text's digest, above all ordinary ids, so it
    stands for its group only where no other document does.
    """
    digest = F.xxhash64("text").bitwiseAND(F.lit(2**62 - 1)) + F.lit(2**62)
    rows = docs.withColumn("__key", F.coalesce(F.col("doc_id").cast("long"), digest))
    found = jaccard.join_similar(rows.select(F.col("__key").alias("doc_id"), "text"))
    stay = found.filter(F.col("doc_id") == F.col("class_id")).select(F.col("doc_id").alias("__key")).distinct()
    # Repeated rows are copies too. They go first: dealt by the key, texts are shuffled and sorted once for both steps.
    different = rows.withColumn("__mark", F.xxhash64("text")).repartition("__key").dropDuplicates(["__key", "__mark"])
    return different.join(stay, "__key", "left_semi").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the wanted mix of sources, each as often as it is taken."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source, n_tokens, tokens`` and whether decoding gives the text back."""
    coded = bpe.encode(docs, VOCABULARY, public_tokenizers.PATTERN, keep=("doc_id", "lang", "source"), round_trip=True)
    return coded.select(
        "doc_id", "lang", "source", (F.octet_length("tokens") / 4).cast("long").alias("n_tokens"), "tokens", "round_trip",
    )


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_copies", near_copies),
    ("mix", mix),
    ("tokens", tokens),
]

# A trained classifier, MinHash and byte pair merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = scratch_dir(spark, f"pipeline-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
