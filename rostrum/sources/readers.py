"""Readers: provenance, dimensions, delimited charts, sitemaps, corpora of text files, vote tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.strings import site


def files(spark: SparkSession, path: str) -> DataFrame:
    """path, sha256, modified, size of every file: what a download's record would say. Contents are hashed where they are read."""
    return spark.read.format("binaryFile").load(path).select("path", F.sha2("content", 256).alias("sha256"), F.col("modificationTime").alias("modified"), F.col("length").alias("size"))


def dimension(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A header CSV of strings, blank values as null; a missing file is an empty table."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], schema)
    df = spark.read.csv(path, header=True, schema=schema, multiLine=True, escape='"')
    return df.select(*[F.nullif(F.btrim(c), F.lit("")).alias(c) for c in columns])


def sniffed_rows(df: DataFrame, text: str, key: str) -> DataFrame:
    """key, n, cells of the rows of a text that is separated by tabs or commas, whichever the first line has more of; blank rows go."""
    first = F.substring_index(text, "\n", 1)
    d = df.select(key, F.when(F.regexp_count(first, F.lit("\t")) > F.regexp_count(first, F.lit(",")), "\t").otherwise(",").alias("_sep"), F.posexplode(F.split(F.col(text), r"\r?\n")).alias("n", "line"))
    csv = F.from_csv(F.col("line"), "a string, b string, c string, d string, e string, f string, g string, h string")
    cells = F.when(F.col("_sep") == "\t", F.split("line", "\t")).otherwise(F.filter(F.array(*[csv[c] for c in "abcdefgh"]), lambda x: x.isNotNull()))
    return d.where(F.btrim("line") != "").select(key, "n", cells.alias("cells"))


def chart_brands(rows: DataFrame, key: str, name: int = 0, reach: int = 1) -> DataFrame:
    """key, brand, reach of the rows with a name and a number, with or without a percent sign."""
    r = F.regexp_extract(F.coalesce(F.get("cells", reach), F.lit("")), r"^\s*(\d+(?:\.\d+)?)%?\s*$", 1)
    return rows.select(key, F.btrim(F.get("cells", name)).alias("brand"), F.nullif(r, F.lit("")).cast("double").alias("reach")).where("brand <> '' AND reach IS NOT NULL")


def chart_links(html: Column) -> Column:
    """Addresses of the charts that a page embeds."""
    return F.array_distinct(F.regexp_extract_all(html, F.lit(r"(?i)<iframe[^>]*\ssrc=[\"']([^\"']+)[\"']"), F.lit(1)))


def sitemap(xml: DataFrame, text: str, base: str, sessions: list[int] | None = None) -> DataFrame:
    """session, slug, lastmod of a sitemap's speaker pages; of a page listed twice the later entry."""
    entries = xml.select(F.posexplode(F.regexp_extract_all(F.col(text), F.lit(r"(?s)<url>(.*?)</url>"), F.lit(1))).alias("n", "u"))
    loc = F.regexp_extract("u", r"(?s)<loc>\s*(.*?)\s*</loc>", 1)
    d = entries.select("n", F.regexp_extract(loc, rf"^{base}/en/(\d+)/([a-z0-9-]+)$", 1).alias("session"), F.regexp_extract(loc, rf"^{base}/en/(\d+)/([a-z0-9-]+)$", 2).alias("slug"), F.regexp_extract("u", r"(?s)<lastmod>\s*(.*?)\s*</lastmod>", 1).alias("lastmod"))
    d = d.where("slug <> ''").withColumn("session", F.col("session").cast("int"))
    if sessions is not None:
        d = d.where(F.col("session").isin(*sessions))
    return d.groupBy("session", "slug").agg(F.max_by("lastmod", "n").alias("lastmod"))


def corpus_texts(spark: SparkSession, path: str) -> DataFrame:
    """iso3, session, year, text of files named ISO_session_year.txt, dotfiles left out."""
    d = spark.read.text(path, wholetext=True).select(F.col("value").alias("text"), F.col("_metadata.file_name").alias("file"))
    part = lambda i: F.regexp_extract("file", r"^([A-Z]{2,4})_(\d+)_(\d{4})\.txt$", i)
    return d.where(part(1) != "").select(part(1).alias("iso3"), part(2).cast("int").alias("session"), part(3).cast("int").alias("year"), "text")


def votes_by_rows(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, name, vote of a wikitext table with a row a state: its first cell the name, its second the vote; the first vote of a name counts."""
    rows = F.filter(F.split(F.col(text), r"\n\|-[^\n]*\n"), lambda r: r.rlike(r"^\s*\|"))
    d = df.select(key, F.posexplode(rows).alias("n", "row"))
    name = F.btrim(F.regexp_extract("row", r"^\s*\|\s*(?:\{\{[^|}]*\|)?\[{0,2}([^\]|}{\n]+?)[\]}|\n]", 1))
    vote = F.lower(F.regexp_extract("row", r"(?i)\b(yes|no|for|against|abstain(?:ed)?|absent|in favour|not voting)\b", 1))
    d = d.select(key, "n", name.alias("name"), vote.alias("vote")).where("name <> '' AND vote <> ''")
    return d.groupBy(key, "name").agg(F.min_by("vote", "n").alias("vote"))


def votes_by_columns(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, name, vote of a wikitext table with a column a vote: cells in the order of the headings, names as templates or links; the first vote of a name counts."""
    heads = F.transform(F.regexp_extract_all(F.col(text), F.lit(r"(?m)^!\s*([A-Za-z ]+?)\s*(?:\(\d+\))?\s*$"), F.lit(1)), lambda x: F.lower(F.btrim(x)))
    body = F.regexp_extract(F.col(text), r"(?s)\n\|-\s*\n(.*)", 1)
    cells = F.filter(F.split(body, r"(?m)^\|(?![-}])"), lambda c: F.btrim(c) != "")
    d = df.select(key, F.posexplode(F.arrays_zip(heads.alias("vote"), cells.alias("cell"))).alias("n", "x")).where("x.vote IS NOT NULL AND x.cell IS NOT NULL")
    names = F.regexp_extract_all(F.col("x.cell"), F.lit(r"\{\{flag(?:country)?\|([^}|]+)|\[\[([^\]|]+)"), F.lit(0))
    d = d.select(key, "n", F.col("x.vote").alias("vote"), F.explode(names).alias("raw"))
    name = F.btrim(F.regexp_replace("raw", r"\{\{flag(?:country)?\||\[\[", ""))
    return d.select(key, "n", name.alias("name"), "vote").groupBy(key, "name").agg(F.min_by("vote", "n").alias("vote"))


def rating(df: DataFrame, html: str, fields: dict[str, str]) -> DataFrame:
    """df with the fields of a rating page: the first match of each pattern's group, tags and entities off."""
    plain = F.replace(F.replace(F.regexp_replace(F.regexp_replace(F.col(html), r"<[^>]+>", " "), r"\s+", " "), F.lit("&amp;"), F.lit("&")), F.lit("&#8217;"), F.lit("’"))
    return df.withColumn("_p", plain).select(*df.columns, *[F.nullif(F.btrim(F.regexp_extract("_p", p, 1)), F.lit("")).alias(n) for n, p in fields.items()])


# --- Fixed values: where a rating page has its values, and the sites that all such pages link to. ---
RATING = {"bias": r'"name":"Bias Rating","value":"([^"]+)"', "factual": r'"name":"Factual Reporting","value":"([^"]+)"', "updated": r'"dateModified":"(\d{4}-\d{2}-\d{2})'}
RATED = r'(?i)Source:\s*<a[^>]+href="https?://([^"/]+)'
LINKED = r'<a[^>]+href="https?://([^"/:]+)'
NOT_RATED = ("mediabiasfactcheck.com", "facebook.com", "twitter.com", "x.com", "youtube.com", "instagram.com", "linkedin.com", "pinterest.com", "reddit.com", "google.com", "wikipedia.org", "archive.org", "archive.ph", "patreon.com", "wordpress.org", "gravatar.com", "w.org", "ko-fi.com", "tumblr.com", "tiktok.com", "threads.net", "bsky.app", "paypal.com")
# --- End of fixed values. ---


def rated_site(pages: DataFrame, keys: list[str], html: str) -> DataFrame:
    """keys and site: the site that a page names as its source, else the one it links to most, of equally frequent ones the first by name."""
    links = F.filter(F.transform(F.regexp_extract_all(F.col(html), F.lit(LINKED), F.lit(1)), lambda x: site(x)), lambda s: ~s.isin(*NOT_RATED))
    p = pages.select(*keys, F.nullif(F.regexp_extract(html, RATED, 1), F.lit("")).alias("_named"), links.alias("_links"))
    counted = p.where("_named IS NULL").select(*keys, F.explode("_links").alias("_link")).groupBy(*keys, "_link").agg(F.count(F.lit(1)).alias("n"))
    most = counted.groupBy(*keys).agg(F.min_by("_link", F.struct(-F.col("n"), F.col("_link"))).alias("_most"))
    return p.join(most, keys, "left").select(*keys, F.coalesce(site(F.col("_named")), F.col("_most")).alias("site"))


def own_rating(pages: DataFrame, outlets: DataFrame, fields: dict[str, str] = RATING) -> DataFrame:
    """outlet, the fields of its rating, and site: of the candidate pages (outlet, place, html) the first that rates the outlet's own site (outlet, domain)."""
    values = pages.select("outlet", "place", *[F.regexp_extract("html", p, 1).alias(n) for n, p in fields.items()])
    own = outlets.select("outlet", site(F.col("domain")).alias("site"))
    hit = values.join(rated_site(pages, ["outlet", "place"], "html"), ["outlet", "place"]).join(own, ["outlet", "site"])
    return hit.groupBy("outlet").agg(F.min_by(F.struct(*fields, "site"), "place").alias("r")).select("outlet", "r.*")


def aliased(df: DataFrame, aliases: dict[str, str], required: list[str]) -> DataFrame:
    """df with its headers made alike (trimmed, lower case) and renamed by an alias table; an error if a required column is missing."""
    names = {c: aliases.get(c.strip().lower(), c.strip().lower()) for c in df.columns}
    missing = [r for r in required if r not in names.values()]
    if missing:
        raise ValueError(f"columns are missing: {missing}")
    return df.withColumnsRenamed(names).select(*required)


def tar_texts(spark: SparkSession, path: str) -> DataFrame:
    """iso3, session, year, text of the members ISO_session_year.txt of tar or tar.gz archives, read as streams; bad UTF-8 is replaced.

    An archive is a row of its own, so it may have up to 2 GB; larger corpora are better unpacked and read by corpus_texts.
    """
    import io
    import re
    import tarfile
    from collections.abc import Iterator

    import pandas as pd

    from ..session import ship

    ship(spark)
    name = re.compile(r"(?:^|/)([A-Z]{2,4})_(\d+)_(\d{4})\.txt$")

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for content in b["content"]:
                rows = []
                with tarfile.open(fileobj=io.BytesIO(content), mode="r|*") as t:
                    for m in t:
                        hit = name.search(m.name)
                        if hit and m.isfile() and not m.name.rpartition("/")[2].startswith("."):
                            rows.append((hit[1], int(hit[2]), int(hit[3]), t.extractfile(m).read().decode("utf-8", "replace")))
                        if len(rows) == 256:
                            yield pd.DataFrame(rows, columns=["iso3", "session", "year", "text"])
                            rows = []
                yield pd.DataFrame(rows, columns=["iso3", "session", "year", "text"])

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(members, "iso3 string, session int, year int, text string")
