"""A corpus from raw documents: each stage is one operator, written as Parquet and read again by the next.

Every stage works on all that its predecessor kept and returns the columns of documents;
the last returns the encoded documents. Missing values and empty texts have the results
that the operators state: documents without 50 words go in the first stage, so that later
ones see none of them. A document that the mix uses twice is two rows from there on.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tablesync.llm import bpe_codec, jaccard_join, mixing, quality_rules, surrogates
from tablesync.llm.common import col, materialize, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Key of the surrogates; a real run sets one of its own.
PII_SECRET = "change me"


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.apply_rules(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones: that of the smallest id."""
    return jaccard_join.representatives(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data and secrets."""
    out = surrogates.pseudonymize(docs, PII_SECRET)
    return out.select(*(F.length("text").cast(kind).alias(name) if name == "n_chars" else col(name) for name, kind in docs.dtypes))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source in the words of its target."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document, and digests of them and of the text decoded from them."""
    coded = bpe_codec.corpus_codec(docs, public_tokenizers.path("word_bpe_49k.json"))
    out = docs.select("doc_id", "lang", "source", coded.alias("coded"))
    return out.select(
        "doc_id",
        "lang",
        "source",
        (F.octet_length("coded.ids") / 4).cast("long").alias("n_tokens"),
        F.col("coded.ids").alias("ids"),
        F.sha2("coded.ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("coded.decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixing", mix),
    ("bpe_codec", encode),
]

#: The join, the surrogates and the encoding can't be stated in SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{name}")
    return docs
