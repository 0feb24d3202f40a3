"""Every stage works on what its predecessor kept, and its decisions take effect."""

import base64

import public_tokenizers as P
import pytest
import tiktoken

import corpus_pipeline
from rostrum.llm import decontam, jaccard, pii

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, f in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(f(spark, docs, SF), name)
        out.append(docs)
    return out


def test_columns_stay(stages):
    assert all(s.schema.fieldNames() == stages[0].schema.fieldNames() for s in stages[:5])


def test_quality_drops_rejected(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = stages[1].join(labels, "doc_id")
    assert kept.where("quality = 1").count() >= 0.97 * labels.where("quality = 1").count()
    assert kept.where("quality = 0").count() <= 0.1 * labels.where("quality = 0").count()


def test_one_of_each_group_stays(stages):
    found = jaccard.jaccard_components(stages[1], k=5, percent=80).collect()
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted({r.component_id for r in found})
    assert stages[2].count() < stages[1].count()


def test_no_benchmark_window_is_left(spark, stages):
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert decontam.hits(stages[3], benchmark).where("contaminated").count() == 0
    assert stages[2].count() - stages[3].count() == decontam.hits(stages[2], benchmark).where("contaminated").count() > 0


def test_no_personal_data_is_left(stages):
    assert stages[4].count() == stages[3].count()
    assert pii.spans(stages[4]).where("n_email + n_ip + n_card + n_phone > 0").count() == 0
    assert stages[4].where("length(text) <> n_chars").count() == 0


def test_ids_are_the_library_s(spark, stages):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {r.doc_id: len(enc.encode_ordinary(r.text)) for r in stages[4].collect()}
    assert {r.doc_id: r.n_tokens for r in stages[5].collect()} == want


def test_run_gives_the_last_stage(spark, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, stages[5].collect()))


def test_odd_rows_go_through_all_stages(spark, tmp_path):
    """Null and empty texts, repeated rows, a long line, columns whose names the operators use, then no rows at all."""
    good = spark.read.parquet(f"{SF}/documents.parquet").limit(0).schema
    rows = [(1, "plain words of a document that is written well enough. " * 4, "en", "s", 0), (1, "plain words of a document that is written well enough. " * 4, "en", "s", 0), (2, None, "en", "s", 0), (3, "", None, None, None), (None, "text without an id, which is still a text.", "en", "s", 1), (4, "abc " * 40_000, "en", "s", 160_000)]
    odd = spark.createDataFrame(rows, good).selectExpr("*", "'x' AS label", "1 AS row", "'y' AS spans", "2.0D AS score", "'z' AS _text")
    spark.createDataFrame([(1, 1, 0), (4, 0, 0)], "doc_id long, quality long, toxic long").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "some ten words of a benchmark that no document here has")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, docs in (("rows", odd), ("none", odd.where("false"))):
        for stage, f in corpus_pipeline.STAGES:
            before = docs
            docs = corpus_pipeline.written(f(spark, docs, str(tmp_path)), f"{name}-{stage}")
            if stage != "byte_bpe":
                assert docs.columns == before.columns
            assert docs.count() <= before.count() and (name == "rows" or docs.count() == 0)
