"""Candidates, glyph layout, cached tables and aliased headers."""

import uuid

import pytest
from pyspark.sql import functions as F

from rostrum.operators import candidates, turns
from rostrum.sources import layout, readers
from rostrum.sources.tables import cached, stored


def test_candidates(spark):
    who = spark.createDataFrame([("A", r"(?i)\bana\b", 3, False), ("B", r"(?i)\bben\b", 9, True), ("C", r"(?i)\bcid\b", 5, False)], "name string, pattern string, encourage int, withdrew boolean")
    en = spark.createDataFrame([("x", "We thank Ana."), ("y", "Nothing.")], "slug string, text string")
    orig = spark.createDataFrame([("x", "Merci Ana."), ("y", "Ben et Ana")], "slug string, text string")
    m = candidates.mentions(en, orig, who.collect())
    assert sorted(map(tuple, m.collect())) == [("x", "A", False), ("y", "A", True), ("y", "B", True)]
    assert [(r.name, r.speeches, r.leads) for r in candidates.summary(m, who).collect()] == [("C", 0, True), ("A", 2, False), ("B", 1, False)]
    asked = candidates.asks(spark.createDataFrame([(1, "A woman Secretary-General now, by a transparent selection"), (2, None)], "k int, t string"), "k", "t")
    assert sorted(r.ask for r in asked.collect()) == ["a woman", "openness"]


def test_blocks_from_glyphs(spark):
    def line(y, text, bold=0, size=10.0, page=1):
        return [(page, float(y), 5.0 * i, 5.0 * i + 5, size, i < bold, False, c) for i, c in enumerate(text) if c != " "]

    rows = line(100, "Mr. A: Hello there", 6) + line(112, "all of you", 0) + line(124, "Mr. B: Yes", 6) + line(160, "Far below", 0) + line(700, "12") + line(720, "small note", 0, 7.0) + line(50, "Page two", 8, page=2)
    d = spark.createDataFrame(rows, "page int, y double, x0 double, x1 double, size double, bold boolean, italic boolean, char string")
    got = [(r.page, r.text, r.bold, r.all_bold) for r in layout.blocks(d, "page").orderBy("page", "seq").collect()]
    assert got == [(1, "Mr. A: Hello there all of you", "Mr. A:", False), (1, "Mr. B: Yes", "Mr. B:", False), (1, "Far below", "", False), (2, "Page two", "Page two", True)]


def test_cached_and_stored(spark):
    calls = []

    def work(df):
        calls.append(1)
        return df.groupBy("g").count()

    d = spark.createDataFrame([("a",), ("a",), ("b",)], "g string")
    name = uuid.uuid4().hex  # the shared folder may outlive a test run
    a, b = cached(d, name, work), cached(d.repartition(3), name, work)
    assert len(calls) == 1 and sorted(a.collect()) == sorted(b.collect())
    cached(d.limit(2), name, work)
    assert len(calls) == 2 and stored(d).count() == 3


def test_aliased_headers(spark):
    d = spark.createDataFrame([("x", 1)], " Country string, `Year ` int")
    assert readers.aliased(d, {"country": "delegation"}, ["delegation", "year"]).first() == ("x", 1)
    with pytest.raises(ValueError):
        readers.aliased(d, {}, ["delegation"])


def test_original_language(spark):
    rows = [(None, ["en"], ["en"]), (None, ["en"], ["fr"]), (None, ["en", "fr"], ["fr"]), (None, ["fr", "es"], ["fr"]), ("ar", ["en"], ["en"]), (None, [], ["pt"]), (None, [], ["en", "fr"])]
    d = spark.createDataFrame(list(enumerate(rows)), "i int, r struct<floor:string,langs:array<string>,official:array<string>>").select("i", "r.*")
    got = d.select("i", turns.original_language(d, F.col("langs"), F.col("floor"), F.col("official")).alias("l")).orderBy("i").collect()
    assert [r.l for r in got] == ["en", None, "fr", None, "ar", "pt", "en"]
