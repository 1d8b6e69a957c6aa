"""The corpus pipeline: quality, near duplicates, benchmark leaks, secrets, tokens.

Every stage is a function of (spark, docs, sf_dir). It works on all that the stage before kept, its
result is written as Parquet, and the next stage reads that. All but the last return the columns
of documents. Awkward rows are treated as the stages' operators define.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.llm.bpe import tokenize
from wardlake.llm.decontaminate import without_leaks
from wardlake.llm.jaccard import Join, one_of_each
from wardlake.llm.quality import good
from wardlake.llm.queries import VOCABULARY, table
from wardlake.llm.secrets import redact
from wardlake.llm.stored import stored
from wardlake.sources.storage import new_path

#: Near copies share four fifths of their runs of five words.
NEAR = Join(5, 80)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    return good(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return one_of_each(docs, NEAR)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a mark in place of each secret."""
    return redact(docs, new_path(spark, "ledger")).withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return tokenize(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN, outputs=("n_tokens", "ids"))


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("secret scans", secret_stage),
    ("byte-level BPE", token_stage),
]
#: A trained classifier decides in the first stage, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
