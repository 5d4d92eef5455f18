"""From raw documents to token files, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame: the documents it
keeps, with the columns of ``documents``; the last one what the token files
hold. A stage's result is written to the shared folder before the next one
reads it, in files of about ``DOCS_PER_FILE`` documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from overflight.llm import decontam, mixing, neardup, quality, tokens
from overflight.llm.common import in_files, stored, table

TOKENIZER = "byte_bpe_50k.json"
CHUNKS_KEPT = 50_000  # by a Python worker during a task; other stages use it afterwards
ROWS_PER_BATCH = 500  # sent to Python workers at once: texts may be long


def _light_batches(spark: SparkSession) -> None:
    """Rows go to Python in small batches, or a batch of long texts fills buffers on both sides."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor the certified rules reject."""
    return in_files(quality.accepted(docs, table(spark, sf_dir, "labels")), docs.count())


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies (five-word shingles, similarity 0.8)."""
    _light_batches(spark)
    return in_files(neardup.deduplicated(docs), docs.count())


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return in_files(decontam.cleaned(docs, table(spark, sf_dir, "benchmark")), docs.count())


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document, once for each round that takes any of it."""
    return in_files(mixing.mixed(docs), docs.count())


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files, read back by document."""
    _light_batches(spark)
    return tokens.encoded(docs, public_tokenizers.path(TOKENIZER), kept=CHUNKS_KEPT, forget=True)


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicate removal", near_dedup),
    ("benchmark decontamination", decontamination),
    ("source mix", source_mix),
    ("token files", token_files),
]

# Near duplicates, drawn slots and token ids have no SQL; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = stored(docs, f"stage-{number}")
    return docs
