"""Candidates in speeches: who mentions whom, English texts first, and the standing of each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What speeches ask of the selection.
ASKS = {
    "a woman": r"(?iu)woman secretary-general|female secretary-general|first woman",
    "the region's turn": r"(?iu)regional rotation|turn of (?:latin america|eastern europe)",
    "openness": r"(?iu)transparen\w+ (?:and inclusive )?(?:selection|process)|open selection",
}


def asks(speeches: DataFrame, key: str, text: str, patterns: dict[str, str] = ASKS) -> DataFrame:
    """key, ask of each thing that a speech asks for."""
    hits = F.array(*[F.when(F.col(text).rlike(p), F.lit(n)) for n, p in patterns.items()])
    return speeches.select(key, F.explode(F.filter(hits, lambda x: x.isNotNull())).alias("ask"))


def mentions(english: DataFrame, originals: DataFrame, candidates: Sequence) -> DataFrame:
    """slug, name, from_original: speeches (slug, text) that name a candidate (name, pattern); a speech's English text counts before its original."""
    both = english.withColumn("from_original", F.lit(False)).unionByName(originals.withColumn("from_original", F.lit(True)))
    hits = F.array(*[F.when(F.col("text").rlike(c.pattern), F.lit(c.name)) for c in candidates])
    m = both.select("slug", "from_original", F.explode(F.filter(hits, lambda x: x.isNotNull())).alias("name"))
    return m.groupBy("slug", "name").agg(F.min("from_original").alias("from_original"))


def summary(found: DataFrame, candidates: DataFrame) -> DataFrame:
    """name, encourage, withdrew, speeches, leads, place: candidates still standing first, the more encouraged before; the first standing leads."""
    n = found.groupBy("name").agg(F.count_distinct("slug").alias("speeches"))
    c = candidates.join(n, "name", "left").withColumn("speeches", F.coalesce("speeches", F.lit(0).cast("long")))
    best = candidates.where("NOT withdrew").agg(F.max_by("name", F.struct("encourage", "name")).alias("best"))
    return c.join(F.broadcast(best), F.lit(True), "left").select("name", "encourage", "withdrew", "speeches", (F.col("name") == F.col("best")).alias("leads")).orderBy("withdrew", F.desc("encourage"))
