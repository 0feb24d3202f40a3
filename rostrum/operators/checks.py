"""Checks that a build must pass; each gives the rows that break it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.strings import collapse, straight_quotes


def missing_quotes(quotes: DataFrame, sources: DataFrame, on: str, quote: str, text: str) -> DataFrame:
    """Quotes that are no exact part of their source."""
    return quotes.join(sources, on).where(~F.contains(F.col(text), F.col(quote)))


def excerpts_missing(excerpts: DataFrame, sources: DataFrame, on: str, excerpt: str, text: str) -> DataFrame:
    """Excerpts that are in no text of their source, quotes and white space made alike on both sides."""
    alike = lambda c: collapse(straight_quotes(c))
    s = sources.select(F.col(on).alias("_on"), alike(F.col(text)).alias("_text"))
    found = (F.col(on) == F.col("_on")) & F.contains("_text", alike(F.col(excerpt)))
    return excerpts.join(s, found, "left_anti")


def placeholders(df: DataFrame, text: str) -> DataFrame:
    """Rows whose text still has a placeholder (__NAME__), with those."""
    left = F.array_distinct(F.regexp_extract_all(F.col(text), F.lit("__[A-Z][A-Z_]*__"), F.lit(0)))
    return df.withColumn("left_over", left).where(F.size("left_over") > 0)


def unlabelled(df: DataFrame, label: str, fallback: Column | None = None) -> DataFrame:
    """Rows without a label, or with no more than a fallback label."""
    bad = F.col(label).isNull() | (F.btrim(label) == "")
    return df.where(bad if fallback is None else bad | fallback)


def assert_empty(df: DataFrame, what: str) -> None:
    """Raise with a few of the rows if there are any."""
    rows = df.limit(5).collect()
    if rows:
        raise AssertionError(f"{what}: {[r.asDict() for r in rows]}")
