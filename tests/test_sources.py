"""Readers, writers, pages and streaming on small files."""

import gzip  # noqa: F401
import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rostrum.operators import history as H
from rostrum.sources import html, readers, writers
from rostrum.streaming import history as streaming

LONG = "This paragraph tells the story of the day in more than sixty characters, "


def story_of(spark, page):
    r = html.articles(spark.createDataFrame([(page,)], "h string"), F.col("h")).first()
    return r.title, r.paragraphs


def test_article_in_a_wrapping_nav(spark):
    story = "".join(f"<p>{LONG} part {i}.</p>" for i in range(20))
    title, ps = story_of(spark, f"<html><head><meta property='og:title' content='The  title'></head><body><nav><article>{story}</article></nav><footer><p>{LONG} foot.</p></footer></body></html>")
    assert title == "The title" and len(ps) == 20 and ps[3].endswith("part 3.")


def test_article_prefers_the_story_to_a_teaser(spark):
    t = f"<body><article><p>{LONG} teaser.</p></article><article>" + "".join(f"<p>{LONG} {i}.</p>" for i in range(9)) + f"<p>Sign up to read {LONG}</p><li><a href=x>{LONG} link.</a></li><p>{LONG} 1.</p></article></body>"
    assert len(story_of(spark, t)[1]) == 9


def test_article_falls_back_to_structured_data(spark):
    data = {"@graph": [{"articleBody": " ".join(f"Sentence number {i} of the structured story is long enough." for i in range(9))}]}
    _, ps = story_of(spark, f"<script type='application/ld+json'>{json.dumps(data)}</script><body><p>short</p></body>")
    assert len(ps) == 3 and ps[0].startswith("Sentence number 0")


def test_article_leaves_furniture_menus_and_bare_links_out(spark):
    page = (
        f"<body><main><p>{LONG} one.</p><aside><p>{LONG} beside.</p></aside><ul><li><a href=x>{LONG} a related story.</a></li><li>{LONG} <a href=x>in part</a> a link.</li></ul>"
        "<p>World Politics Business Opinion Science Health Sports Arts Books Style Food Travel Magazine</p></main></body>"
    )
    assert [p.split()[-1] for p in story_of(spark, page)[1]] == ["one.", "link."]


def test_json_ld_values_in_order(spark):
    a = {"@graph": [{"headline": "a", "mainEntity": {"headline": "b"}}, [{"headline": "c"}], {"headline": 4}], "headline": "top", "other": {"headline": "hidden"}}
    page = f"<script type='application/ld+json'>{json.dumps(a)}</script><script type='application/ld+json'>{{broken</script><script>{json.dumps(a)}</script>"
    d = spark.createDataFrame([(page,), (None,)], "h string")
    assert [r["values"] for r in html.json_ld(d, F.col("h"), "headline").collect()] == [["top", "a", "b", "c"], []]


def test_odd_pages(spark):
    d = spark.createDataFrame([(1, None), (2, ""), (3, "<p><b>open"), (4, "<" * 3000), (5, "<div>" * 3000 + "x")], "i int, h string")
    assert html.articles(d, F.col("h")).count() == 5


def test_speaker_page_and_coverage():
    p = html.speaker_page("""<title>Brazil | General Debate</title><div class="field--name-field-speaker-name">Ana Silva</div><div class="field field--name-field-portuguese-statement"><a href="/f/br_fl.pdf">x</a></div>
      <div class="field--name-field-english-statement"><span class="custom-statement-file-label">English</span><a href="/f/br_en.pdf">y</a></div><time datetime="2026-09-22T10:00">d</time>""")
    assert (p["delegation"], p["speaker_name"], p["date"]) == ("Brazil", "Ana Silva", "2026-09-22")
    assert [(s["language"], s["floor_version"]) for s in p["statements"]] == [(None, True), ("en", False)]
    c = html.coverage(f"<h4>Headline</h4><p>{LONG}</p><a href='https://news.un.org/fr/x'>n</a><a href='https://press.un.org/en/1'>p</a>")
    assert (c["headline"], c["un_news"][0]["language"], c["press_release_url"]) == ("Headline", "fr", "https://press.un.org/en/1")


def test_block_text():
    assert html.block_text("<div class='a b'><p>One <b>two</b></p><ul><li><p>in</p></li></ul></div>", "b") == "One two\n\nin"
    with pytest.raises(ValueError):
        html.block_text("<p>x</p>", "none")


def test_sitemap(spark):
    x = "<urlset><url><loc>https://s.org/en/81/brazil</loc><lastmod>1</lastmod></url><url><loc>https://s.org/en/81/brazil</loc><lastmod>2</lastmod></url><url><loc>https://s.org/fr/81/bresil</loc></url><url><loc>https://s.org/en/80/chad</loc></url></urlset>"
    d = spark.createDataFrame([(x,)], "x string")
    assert sorted(map(tuple, readers.sitemap(d, "x", "https://s.org").collect())) == [(80, "chad", ""), (81, "brazil", "2")]
    assert readers.sitemap(d, "x", "https://s.org", [80]).count() == 1


def test_dimension_and_corpus(spark, tmp_path):
    (tmp_path / "d.csv").write_text("a,b\n1,\n2,x\n")
    assert [tuple(r) for r in readers.dimension(spark, f"file://{tmp_path}/d.csv", ["a", "b"]).collect()] == [("1", None), ("2", "x")]
    assert readers.dimension(spark, f"file://{tmp_path}/none.csv", ["a"]).count() == 0
    (tmp_path / "c").mkdir()
    for n in ("USA_1_1946.txt", "notes.txt"):
        (tmp_path / "c" / n).write_text("hello\nworld")
    assert [tuple(r) for r in readers.corpus_texts(spark, f"file://{tmp_path}/c").collect()] == [("USA", 1, 1946, "hello\nworld")]
    f = readers.files(spark, f"file://{tmp_path}/d.csv").first()
    assert f.sha256 == hashlib.sha256((tmp_path / "d.csv").read_bytes()).hexdigest()


def test_votes(spark):
    r = spark.createDataFrame([(1, "{|\n! State !! Vote\n|-\n| [[Brazil]] || Yes\n|-\n| {{flag|Chad}} || Abstained\n|-\n| [[Brazil]] || No\n|}")], "i int, t string")
    assert sorted(map(tuple, readers.votes_by_rows(r, "i", "t").collect())) == [(1, "Brazil", "yes"), (1, "Chad", "abstained")]
    c = spark.createDataFrame([(1, "{|\n! For (2)\n! Against (1)\n|-\n| {{flag|Brazil}}, [[Peru]]\n| {{flag|Chad}}\n|}")], "i int, t string")
    assert sorted(map(tuple, readers.votes_by_columns(c, "i", "t").collect())) == [(1, "Brazil", "for"), (1, "Chad", "against"), (1, "Peru", "for")]


def test_writers(spark, tmp_path):
    d = spark.createDataFrame([(81, "b", "2026-01-02", ["g1", "g2"], [("en", "t1")]), (81, "a", None, [], [("fr", "t2"), ("es", "t3")])], "session int, slug string, date string, gaps array<string>, texts array<struct<language:string,text:string>>")
    writers.parents_and_children(d, f"file://{tmp_path}/p", keys=["session", "slug"], children="texts", joined={"gaps": " | "}, order=["date", "slug"])
    assert [r.slug for r in spark.read.csv(f"file://{tmp_path}/p/parents", header=True).collect()] == ["a", "b"]
    assert spark.read.json(f"file://{tmp_path}/p/children").count() == 3
    assert writers.csv_without_text(d.select("slug", F.lit("x").alias("clean_text")), f"file://{tmp_path}/c").columns == ["slug"]
    names = writers.checksums(spark, f"file://{tmp_path}/c").collect()
    assert names and all(len(r.sha256) == 64 for r in names)
    m = d.select(writers.markdown(d, {"slug": "slug"}, "slug", "date").alias("m")).first().m
    assert m.startswith('---\nslug: "b"\n---\n\n# b\n\n2026')


def test_streaming_history_equals_batch(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.StringType()), T.StructField("day", T.StringType())])
    days = [[("a", "1", "d1"), ("b", "1", "d1")], [("a", "2", "d2")], [("a", "2", "d3"), ("b", "3", "d3")]]
    os.makedirs(tmp_path / "in")
    for i, d in enumerate(days):
        spark.createDataFrame(d, schema).coalesce(1).write.parquet(f"file://{tmp_path}/w{i}")
        part = next(f for f in os.listdir(tmp_path / f"w{i}") if f.endswith(".parquet"))
        os.rename(tmp_path / f"w{i}" / part, tmp_path / "in" / f"{i}.parquet")
        os.utime(tmp_path / "in" / f"{i}.parquet", (i + 1, i + 1))
    q = streaming.keep_history(spark, f"file://{tmp_path}/in", schema, f"file://{tmp_path}/out", f"file://{tmp_path}/cp", "k", ["v"], "day")
    q.awaitTermination(120)
    got = sorted(map(str, spark.read.parquet(f"file://{tmp_path}/out/v=2").select("k", "v", "valid_from", "valid_to", "is_current", "last_checked").collect()))
    h = spark.createDataFrame([], "k string, v string, valid_from string, valid_to string, is_current boolean, last_checked string")
    for d in days:
        h = H.apply_batch(h, spark.createDataFrame(d, schema), "k", ["v"], F.lit(d[0][2]))
    assert got == sorted(map(str, h.select("k", "v", "valid_from", "valid_to", "is_current", "last_checked").collect()))


def test_windows_of_a_stream(spark, tmp_path):
    e = spark.createDataFrame([(1, "2024-01-01 10:00:00", "a", 1.0), (2, "2024-01-01 11:00:00", "a", 2.0), (3, "2024-01-02 10:00:00", "a", 4.0)], "id int, t string, kind string, value double").withColumn("ts", F.col("t").cast("timestamp_ntz"))
    e.write.parquet(f"file://{tmp_path}/e")
    q = streaming.windowed_counts(spark.readStream.schema(e.schema).parquet(f"file://{tmp_path}/e"), "ts", "kind").writeStream.format("memory").queryName("wins").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert sorted((r.n, r.total) for r in spark.sql("SELECT * FROM wins").collect()) == sorted((r.n, r.total) for r in streaming.windowed_counts(e, "ts", "kind").collect()) == [(1, 4.0), (2, 3.0)]
    assert streaming.sessions(e, "ts", "kind").count() == 2


def test_tar_texts(spark, tmp_path):
    import io
    import tarfile

    with tarfile.open(tmp_path / "c.tar.gz", "w:gz") as t:
        for n, raw in (("x/USA_1_1946.txt", b"hello \xff"), ("x/._USA_1_1946.txt", b"no"), ("x/notes.txt", b"no"), ("FRA_2_1947.txt", "été".encode())):
            i = tarfile.TarInfo(n)
            i.size = len(raw)
            t.addfile(i, io.BytesIO(raw))
    got = sorted(map(tuple, readers.tar_texts(spark, f"file://{tmp_path}/c.tar.gz").collect()))
    assert got == [("FRA", 2, 1947, "été"), ("USA", 1, 1946, "hello �")]


def test_only_named_references_are_resolved(spark):
    d = spark.createDataFrame([("a &amp;lt; &lt; &quot;b &amp &#39;", ), (None,)], "t string")
    assert [r[0] for r in d.select(html.unescaped(F.col("t"), ("lt", "amp"))).collect()] == ["a &lt; < &quot;b &amp &#39;", None]
    assert d.select(html.unescaped(F.col("t"))).first()[0] == "a &lt; < \"b & '"


def test_pages_reach_python_in_small_batches(spark):
    """A worker holds some hundred rows at a time, not ten thousand; what the session sets itself stays."""
    import pandas as pd

    from rostrum import session

    new = spark.newSession()
    html.articles(new.createDataFrame([(1, "<p>x</p>")], "i int, h string"), F.col("h"))
    seen = F.pandas_udf(lambda x: pd.Series([len(x)] * len(x)), "int")
    assert new.range(0, 3000, 1, 1).select(seen("id").alias("n")).agg(F.max("n")).first()[0] <= int(session.BATCH_ROWS)
    own = spark.newSession()
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "77")
    session.ship(own)
    assert own.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "77"
