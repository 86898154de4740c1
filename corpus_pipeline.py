"""Corpus pipeline: documents -> clean, deduplicated, tokenised documents.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and reread as the next stage's docs.  All but the last return the
columns that they were given.  Stages fit what they need (toxicity and
language models, word table) on the documents that reach them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citystream.llm import decontam, langid, neardup, toxicity, wordbpe
from citystream.llm.common import read, small_batches, stored

#: A document is rejected as of no known language below this score: the share
#: of its letters in its main language times that language's certainty.
LANGUAGE_SCORE = 0.3
#: Near-duplicates share this percentage of their word shingles or more.
NEAR_PERCENT = 80


def _base(docs: DataFrame) -> list[str]:
    return list(docs.columns)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score reaches the operator's threshold go."""
    model = toxicity.train(docs, read(spark, sf_dir, "labels"))
    return (toxicity.score_documents(docs, model, out="__toxicity")
            .where(F.col("__toxicity") < toxicity.THRESHOLD).select(*_base(docs)))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or of no language the model knows, go."""
    model = langid.train(docs)
    return (langid.identify(docs, model, out="__lang")
            .where((F.col("__lang_pred") != langid.UNKNOWN)
                   & (F.col("__lang_score") >= LANGUAGE_SCORE)).select(*_base(docs)))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each near-duplicate group stays."""
    small_batches(spark)
    return neardup.deduplicate(docs, percent=NEAR_PERCENT)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, re-parameterised or not, go."""
    return decontam.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded text of each document."""
    import public_tokenizers
    return wordbpe.digests(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("language_id", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("bpe", bpe_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table; doc_id, n_tokens, ids_sha256,
    decoded_sha256 of every document that stays."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: Trained models, template windows and BPE are not SQL; tests/llm holds each
#: stage against a brute-force version.
ORACLE_SQL = None
