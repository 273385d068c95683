"""A corpus from raw documents to packed sequences, each stage by one operator.

Stages read what the one before has written: language ID (texts in no language go), exact and near
deduplication (one document of each group stays), mixing (rows stored in the order of the target
weights), packing (sequences numbered along that order). Language ID, whose last step is Python on
all texts, writes its rows itself, in small batches, which bounds a worker's memory.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup, language_id, mixing, near_dedup, packing
from tidemark.llm.common import table, written

#: Texts whose profile is further than this from every language's are in none (1: the same profile).
#: Of all 51,282 documents of check_s the least score is 0.398 and one in a hundred is below 0.52;
#: random letters, base64 and other languages in Latin script are at 0.08 to 0.27 from 64 letters on.
LEAST_SCORE = 0.3
#: Texts with fewer letters have too few n-grams to tell: less is asked of them, in proportion.
FEW_LETTERS = 32

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_a_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter and texts that resemble no language's profile."""
    tagged = language_id.identify(docs, language_id.learn_profiles(docs))
    letters = F.length(F.regexp_replace("text", r"\P{L}+", ""))
    alike = F.when(F.col("score") >= LEAST_SCORE, True).otherwise((letters < FEW_LETTERS) & (F.col("score") >= LEAST_SCORE / FEW_LETTERS * letters))
    return written(tagged.where((F.col("lang_pred") != "und") & alike).select(*docs.columns))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(docs)


def to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(mixing.stored_order(docs, "mixed_place"), place="mixed_place")


STAGES: list[tuple[str, Stage]] = [
    ("language_id", in_a_language),
    ("exact_dedup", exact_copies),
    ("ngram_jaccard", near_copies),
    ("mix_sources", to_weights),
    ("best_fit_packing", packed),
]

#: SQL can't tokenise, so it can't express the last stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each one's rows written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    last = len(STAGES) - 1
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        docs = written(docs) if k < last else docs
    return docs
