"""A training corpus from ``documents``: five stages, each on all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.llm import bpe, decontamination, near_duplicates, surrogates, toxicity
from windrow.llm.components import written
from windrow.llm.queries import QUERY_KEY, TOXIC_FROM


def _kept(docs: DataFrame, verdict: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is not in ``verdict`` (``doc_id``); rows without an id stay."""
    gone = written(verdict.select("doc_id").distinct(), "gone")
    return docs.join(gone, docs["doc_id"] == gone["doc_id"], "left_anti")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a toxicity score of TOXIC_FROM or more."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.trained(docs, labels)
    score = "score"
    while score in {c.lower() for c in docs.columns}:
        score = f"_{score}"
    return toxicity.score(docs, model, score_col=score).where(F.col(score) < TOXIC_FROM).drop(score)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8."""
    return _kept(docs, near_duplicates.near_duplicates(docs, size=5, percent=80).where("not kept"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which under a twentieth stands in benchmark passages."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _kept(docs, decontamination.contamination(docs, items).where("contaminated"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their personal data replaced and ``n_chars`` counted anew."""
    return surrogates.replace(docs, QUERY_KEY).withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source, ids, n_tokens, round_trip``: token ids, and whether they decode to the text."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = bpe.round_trip(docs, ranks, public_tokenizers.PATTERN)
    same = F.col("decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return coded.select("doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"), same.alias("round_trip"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("minhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("pii", replace_personal_data),
    ("byte-level bpe", encode_texts),
]

# Classifiers, keyed surrogates and token ids have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again for the next.

    Null and empty texts are never toxic, near duplicates or contaminated and have no tokens. Of rows
    that share an id all go or stay together; of equal texts the one with the least id stays. Texts of
    any length are read whole. Other columns are carried to the last stage, whatever their names. An
    empty table gives no rows.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        docs = written(docs, "stage") if i + 1 < len(STAGES) else docs
    return docs
