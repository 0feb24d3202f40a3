"""One query for each operator of this subpackage, over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bytebpe, decontam, jaccard, nra, pii, ranker, repair, tokencount, urlfilter, warc
from .common import table


def op1_warc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.records(warc.read_chunks(warc.write_archives(table(spark, sf_dir, "pages")), payload=False))


def op2_repair_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = repair.write_shards(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return repair.read_shards(manifest)


def op3_nra_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nra.top_k(table(spark, sf_dir, "embeddings"), k=20, query_every=20, scale=64)


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)


def op5_jaccard_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"), k=4, percent=85)


#: The rules of op6: host, path, verdict.
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(("host", "path", "verdict"), r)]) for r in RULES])
    rules = spark.range(1).select(F.inline(listed))
    return urlfilter.judge(table(spark, sf_dir, "pages"), rules)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytebpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op8_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.spans(table(spark, sf_dir, "documents"))


def op9_quality_ranker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranker.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.7)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES = {f.__name__: f for f in (op1_warc_records, op2_repair_tokens, op3_nra_topk, op4_decontaminate, op5_jaccard_components, op6_url_filter, op7_byte_bpe, op8_pii_spans, op9_quality_ranker, op10_token_counts)}
