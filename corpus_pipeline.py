"""The training-data pipeline: five stages, each a table written as Parquet and read again as the next one's documents.

Quality ranking drops rejected documents; the Jaccard join keeps one document of each group of near copies (five words, 0.8);
decontamination drops documents that hold a benchmark window; personal data is replaced by marks; what is left is encoded and
decoded by byte-level BPE. All but the last stage return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostrum.llm import bytebpe, decontam, jaccard, pii, ranker
from rostrum.llm.common import table, written


#: Pieces that a worker of the last stage remembers: fewer than alone, as the stages before it leave an executor's heap grown.
CODER_MEMORY = 300_000
#: Characters of texts that it works on at once, for the same reason.
CODER_CHARS = 1 << 19


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ranker, trained on the labels that are not held out, accepts."""
    labels = table(spark, sf_dir, "labels")
    trained = ranker.train(docs, labels.where(~ranker.held_out_rows(F.col("doc_id"))))
    return ranker.keep_good(docs, trained)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group that links of five-word shingles at 0.8 connect."""
    return jaccard.deduplicate(docs, k=5, percent=80)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten-word window of the benchmark."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"), remove="documents")


def redact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with marks in place of personal data."""
    return pii.redact(docs)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left, encoded and decoded again."""
    return bytebpe.digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), memory=CODER_MEMORY, chars=CODER_CHARS)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicates_stage),
    ("decontamination", decontaminate_stage),
    ("personal_data", redact_stage),
    ("byte_bpe", encode_stage),
]

#: The trained stages and the tokenizer are beyond SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the whole of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
