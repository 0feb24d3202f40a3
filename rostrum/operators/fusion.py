"""One row a speech from four sources, by the precedence of each field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Agreement with the corpus from which a scanned record is the same speech.
SCAN_MATCH = 0.5


def kept_scan(scan_text: Column, corpus_text: Column, agreement: Column, least: float = SCAN_MATCH) -> Column:
    """Whether a scan is kept: the corpus has no text, or agrees with it well enough; no agreement counts as none."""
    return scan_text.isNotNull() & (corpus_text.isNull() | (F.coalesce(agreement, F.lit(0.0)) >= least))


def first_of(*ways: tuple[str, Column, Column]) -> tuple[Column, Column]:
    """The value of the first (source, present, value) that is present, and the source's name."""
    value, source = None, None
    for name, present, v in ways:
        value = F.when(present, v) if value is None else value.when(present, v)
        source = F.when(present, name) if source is None else source.when(present, name)
    return value, source


def speeches(df: DataFrame, key: str) -> DataFrame:
    """key, speaker, spoken, english, original, each with its source, and in_corpus, of rows that hold what four sources have of a speech.

    Columns: site_speaker, corpus_speaker, record_speaker, scan_speaker; record_spoken, site_spoken, scan_spoken; record_text,
    corpus_text, scan_text, site_statement, site_transcript (English); site_original; has_site, has_record; agreement of scan and corpus.
    Speaker: site, corpus, record, scan. Spoken language: record, site, scan. English: record, corpus, scan, site with a statement before a
    transcript. Original: the site's text in the spoken language, else the English text where English was spoken.
    """
    c = F.col
    d = df.withColumn("_scan", F.coalesce(kept_scan(c("scan_text"), c("corpus_text"), c("agreement")), F.lit(False)))
    has = lambda x: c(x).isNotNull()
    speaker = first_of(("site", c("has_site"), c("site_speaker")), ("corpus", has("corpus_speaker"), c("corpus_speaker")), ("record", c("has_record"), c("record_speaker")), ("scan", c("_scan"), c("scan_speaker")))
    spoken = first_of(("record", c("has_record"), c("record_spoken")), ("site", c("has_site") & has("site_spoken"), c("site_spoken")), ("scan", c("_scan") & has("scan_spoken"), c("scan_spoken")))
    english = first_of(
        ("record", c("has_record"), c("record_text")), ("corpus", has("corpus_text"), c("corpus_text")), ("scan", c("_scan"), c("scan_text")),
        ("site_statement", c("has_site") & has("site_statement"), c("site_statement")), ("site_transcript", c("has_site") & has("site_transcript"), c("site_transcript")),
    )
    named = {"speaker": speaker, "spoken": spoken, "english": english}
    d = d.select("*", *[v.alias(n) for n, (v, _) in named.items()], *[s.alias(f"{n}_source") for n, (_, s) in named.items()])
    original = first_of(("site", c("has_site") & has("site_original"), c("site_original")), ("english", (c("spoken") == "en") & has("english"), c("english")))
    return d.select(key, "speaker", "speaker_source", "spoken", "spoken_source", "english", "english_source", original[0].alias("original"), original[1].alias("original_source"), has("corpus_text").alias("in_corpus"))
