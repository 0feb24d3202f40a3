"""Sources, sinks, report operators and validations on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import lexicon
from ..functions import strings as S
from ..operators import aggregates, attention, candidates, checks, fusion, history, network, relational, sequences, textmining, topics, turns
from ..sources import html, layers, layout, readers, writers
from ..sources.fetch import fetch
from ..sources.tables import below, own_folder, stored
from .aggregates import _MENTIONS, _PANEL, _panel
from .common import SENTENCES, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


#: Agreement of two sources in SQL, and the report's lines.
_WORDS = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}_]+')"
_RUNS = "list_distinct(list_transform(generate_series(1, greatest(len({0}) - 4, 0)), lambda i: array_to_string({0}[i : i + 4], ' ')))"
_AGREEMENT = f"""WITH p AS (SELECT item_id, text AS a, CASE item_id % 3 WHEN 0 THEN text || ' and a few more words at its end' WHEN 1 THEN text END AS b FROM benchmark), w AS (SELECT item_id, b, {_WORDS.format('a')} AS v, {_WORDS.format('b')} AS w FROM p), r AS (SELECT item_id, b, {_RUNS.format('v')} AS x, {_RUNS.format('w')} AS y FROM w),
s AS (SELECT item_id % 4 AS session, b, CASE WHEN len(x) > 0 AND len(y) > 0 THEN round(len(list_intersect(x, y)) / least(len(x), len(y)), 3) END AS s FROM r), g AS (SELECT session, count(*) AS speeches, count(b) AS in_both, round(median(s), 3) AS median, count(*) FILTER (s < 0.9) AS below FROM s GROUP BY 1),
t AS (SELECT unnest([1, 2, 3, 4, 5, 6]) AS line, unnest(['# Sources compared', '', 'Agreement is the share of five-word runs that both sources have.', '', '| session | speeches | in_both | median | below |', '| --- | --- | --- | --- | --- |']) AS text)
SELECT line, text FROM t UNION ALL SELECT 6 + row_number() OVER (ORDER BY session), '| ' || session || ' | ' || speeches || ' | ' || in_both || ' | ' || coalesce(median::VARCHAR, '') || ' | ' || below || ' |' FROM g"""


# --- sources and sinks: written to the shared folder and read back ---


@query("SELECT page_id, replace(replace(regexp_extract(html, '<h1>([^<]*)</h1>', 1), '  ', ' '), '&amp;', '&') <> '' AS has_heading FROM pages")
def s7_block_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = html.articles(table(spark, sf_dir, "pages").select("page_id", "html"), F.col("html"))
    return p.select("page_id", (F.regexp_extract("html", "<h1>([^<]*)</h1>", 1) != "").alias("has_heading"))


@query("SELECT n_nationkey::VARCHAR AS n_nationkey, n_name, n_regionkey::VARCHAR AS n_regionkey FROM nation")
def s10_csv_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = own_folder(spark, "s10-csv")
    table(spark, sf_dir, "nation").write.mode("overwrite").csv(path, header=True)
    return readers.dimension(spark, path, ["n_nationkey", "n_name", "n_regionkey"])


@query("SELECT n_nationkey, 1::INT AS n, n_name AS first FROM nation")
def s11_sniffed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    sep = F.when(F.col("n_nationkey") % 2 == 0, "\t").otherwise(",")
    d = table(spark, sf_dir, "nation").select("n_nationkey", F.concat(F.lit("name"), sep, F.lit("x\n"), F.col("n_name"), sep, F.lit("1\n\n")).alias("t"))
    return readers.sniffed_rows(d, "t", "n_nationkey").where("n > 0").select("n_nationkey", "n", F.get("cells", 0).alias("first"))


@query("SELECT n_name AS delegation, n_regionkey::VARCHAR AS region FROM nation WHERE n_regionkey < 4 UNION ALL SELECT n_name, 'other' FROM nation WHERE n_regionkey = 4")
def s13_aliased_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sheet whose headers and codes vary: headers by an alias table, codes by a replacement, both checked."""
    sheet = table(spark, sf_dir, "nation").select(F.col("n_name").alias(" Country "), F.col("n_regionkey").cast("string").alias("Reg."))
    return readers.aliased(sheet, {"country": "delegation", "name": "delegation", "reg.": "region"}, ["delegation", "region"]).replace({"4": "other"}, subset=["region"])


@query("SELECT conv_id, turn, role FROM conversations")
def s15_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = own_folder(spark, "s15-json")
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    writers.json_lines(c, path)
    return spark.read.schema(c.schema).json(path)


@query("SELECT doc_id, source FROM documents WHERE lang = 'fr'")
def s16_pruned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitioned by language when written, so that the filter reads one folder and two columns."""
    path = own_folder(spark, "s16-parquet")
    writers.parquet(table(spark, sf_dir, "documents").select("doc_id", "source", "lang"), path, ["lang"])
    return spark.read.parquet(path).where("lang = 'fr'").select("doc_id", "source")


@query("SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL")
def k1_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as Parquet, a folder a source, and counted from what was written."""
    path = own_folder(spark, "k1-parquet")
    writers.parquet(table(spark, sf_dir, "documents").select("doc_id", "source", "lang"), path, ["source"])
    return spark.read.parquet(path).groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT doc_id, quality, toxic FROM labels")
def k4_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each written line is one JSON object: read as text, its fields taken out again."""
    path = own_folder(spark, "k4-json")
    writers.json_lines(table(spark, sf_dir, "labels"), path)
    f = lambda n: F.get_json_object("value", f"$.{n}").cast("long").alias(n)
    return spark.read.text(path).select(f("doc_id"), f("quality"), f("toxic"))


@query(r"""WITH u AS (SELECT doc_id, text, 'Page ' || text AS ocr, CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 3 = 1 THEN repeat('?', 400) ELSE text END AS layer FROM documents), x AS (SELECT *, regexp_extract_all(layer, '[\p{L}\p{M}]+') AS w FROM u), f AS (SELECT *, list_filter(w, lambda x: regexp_matches(x, '[^\P{L}\p{Latin}]')) AS f FROM x),
m AS (SELECT *, CASE WHEN len(f) < 50 THEN 0 ELSE len(list_filter(f, lambda x: regexp_matches(x, '\p{Latin}'))) / len(f) END AS mixed, len(regexp_extract_all(layer, '(?:^|[^\p{L}\p{M}])\p{M}')) / nullif(length(layer), 0) AS misordered, len(regexp_extract_all(layer, '[\p{L}\p{M}]')) / nullif(len(regexp_extract_all(layer, '\S')), 0) AS letters FROM f),
c AS (SELECT *, coalesce(length(layer) >= 300 AND letters >= 0.6 AND misordered <= 0.01 AND mixed <= 0.01, false) AS fit FROM m) SELECT doc_id, CASE WHEN fit THEN 'layer' ELSE 'ocr' END AS text_source, sha256(CASE WHEN fit THEN layer ELSE ocr END) AS digest FROM c""")
def s18_text_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The layer of every third document is missing, of every third unreadable; what was recognised takes its place there, and where a layer is too short."""
    k = F.col("doc_id") % 3
    d = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("Page "), "text").alias("ocr"), F.when(k == 1, F.repeat(F.lit("?"), 400)).when(k == 2, F.col("text")).alias("layer"))
    return layers.choose(d, "layer", "ocr").select("doc_id", "text_source", F.sha2("text", 256).alias("digest"))


@query("SELECT n_regionkey::VARCHAR AS region, 1 AS round, false AS hit, n FROM (SELECT n_regionkey, count(*) AS n FROM nation GROUP BY 1) UNION ALL SELECT n_regionkey::VARCHAR, 2, n_regionkey <> 4, n FROM (SELECT n_regionkey, count(*) AS n FROM nation GROUP BY 1)")
def s1_cached_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files fetched twice, one of which was not there the first time: the others are hits then, with the same content."""
    path, cache = own_folder(spark, "s1-files"), own_folder(spark, "s1-cache")
    n = table(spark, sf_dir, "nation").select("n_name", F.col("n_regionkey").cast("string").alias("region"))
    write = lambda df: df.coalesce(1).write.mode("append").partitionBy("region").json(path)
    write(n.where("region <> '4'"))
    named = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    first = stored(fetch(spark, path, cache))
    write(n.where("region = '4'"))
    second = stored(fetch(spark, path, cache))
    files = named.load(path).select(below(F.col("path"), path).alias("name"), F.regexp_extract("path", "region=([0-9]+)", 1).alias("region"), F.sha2("content", 256).alias("sha256"), F.regexp_count(F.col("content").cast("string"), F.lit("n_name")).cast("long").alias("n"))
    got = first.withColumn("round", F.lit(1)).unionByName(second.withColumn("round", F.lit(2)))
    new = files.where("region = '4'").select("region", F.lit(1).alias("round"), F.lit(False).alias("hit"), "n")
    return files.join(got, ["name", "sha256"]).select("region", "round", "hit", "n").unionByName(new)


@query()
def s19_glyph_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of a page's glyphs: here each document's first words set as bold labels and plain text on lines of eight words."""
    w = table(spark, sf_dir, "benchmark").select("item_id", F.posexplode(F.split("text", r"\s+")).alias("i", "word"))
    chars = w.select(F.col("item_id").alias("page"), "i", F.posexplode(F.split("word", "")).alias("j", "char")).where("char <> ''")
    g = chars.select("page", (F.floor(F.col("i") / 8) * 14 + 100).cast("double").alias("y"), ((F.col("i") % 8) * 60 + F.col("j") * 5).cast("double").alias("x0"), ((F.col("i") % 8) * 60 + F.col("j") * 5 + 5).cast("double").alias("x1"), F.lit(10.0).alias("size"), (F.col("i") < 2).alias("bold"), F.lit(False).alias("italic"), "char")
    return layout.blocks(g, "page")


#: A rating page's values around what a page has: bias and factual reporting, and the site that it rates, named or linked to most.
_RATED = """WITH p AS (SELECT page_id, regexp_replace(lower(regexp_extract(url, '://([^/?#]+)', 1)), '^www\\.', '') AS host FROM pages), l AS (SELECT page_id, host, string_split(host, '.') AS l FROM p)
SELECT page_id, CASE WHEN len(l) > 2 AND l[-2] IN ('co', 'com', 'org', 'net', 'gov', 'gob', 'ac', 'edu') THEN array_to_string(l[-3:], '.') ELSE array_to_string(l[-2:], '.') END AS site FROM l"""


@query(f"""SELECT 'outlet ' || page_id AS outlet, CASE page_id % 3 WHEN 0 THEN 'Left-Center & more' WHEN 1 THEN 'Right' ELSE 'Least Biased' END AS bias, 'High' AS factual, '2026-01-0' || (page_id % 9 + 1) AS updated, site FROM ({_RATED}) WHERE page_id % 5 <> 4""")
def s21_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of two candidate pages the first rates another site; the second rates the outlet's own, by its source line or by its links; some outlets have none."""
    i, host = F.col("page_id"), F.regexp_extract("url", "://([^/?#]+)", 1)
    p = table(spark, sf_dir, "pages").select("page_id", host.alias("domain"), F.concat(F.lit("outlet "), i.cast("string")).alias("outlet"))
    bias = F.when(i % 3 == 0, "Left-Center &amp; more").when(i % 3 == 1, "Right").otherwise("Least Biased")
    head = lambda b: F.concat(F.lit('{"name":"Bias Rating","value":"'), b, F.lit('"},{"name":"Factual Reporting","value":"High"},{"dateModified":"2026-01-0'), (i % 9 + 1).cast("string"), F.lit('T00:00"}'))
    named = lambda d: F.concat(F.lit('Source: <a class="x" href="https://'), d, F.lit('/">site</a>'))
    linked = F.concat(F.lit('<a href="https://twitter.com/a"></a><a href="https://twitter.com/b"></a><a href="http://'), F.col("domain"), F.lit('/story">x</a>'))
    own = F.when(i % 5 == 4, named(F.lit("else.org"))).when(i % 2 == 0, named(F.col("domain"))).otherwise(linked)
    pages = p.select("outlet", F.lit(1).alias("place"), F.concat(head(F.lit("Other")), named(F.lit("other.org"))).alias("html")).unionByName(p.select("outlet", F.lit(2).alias("place"), F.concat(head(bias), own).alias("html")))
    return readers.own_rating(pages, p.select("outlet", "domain")).withColumn("bias", html.unescaped(F.col("bias")))


@query("SELECT conv_id, string_agg(role, ' | ' ORDER BY turn) AS gaps FROM conversations GROUP BY 1")
def k3_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("texts"))
    d = c.withColumn("gaps", F.transform("texts", lambda x: x["role"]))
    return writers.parents_and_children(d, own_folder(spark, "k3"), keys=["conv_id"], children="texts", joined={"gaps": " | "}, order=["conv_id"])[0]


@query("SELECT lang, count(*) AS n, true AS sound FROM documents GROUP BY 1")
def k8_checksums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file a language with its checksum, which a second reading confirms, and the rows that the file has."""
    path = own_folder(spark, "k8")
    table(spark, sf_dir, "documents").select("doc_id", "lang").repartition("lang").write.partitionBy("lang").parquet(path)
    sums = stored(writers.checksums(spark, path).where(F.col("file").endswith(".parquet")))
    again = readers.files(spark, f"{path}/lang=*").select(below(F.col("path"), path).alias("file"), F.col("sha256").alias("again"))
    rows = spark.read.parquet(path).withColumn("file", below(F.col("_metadata.file_path"), path)).groupBy("lang", "file").agg(F.count(F.lit(1)).alias("n"))
    j = rows.join(sums, "file", "left").join(again, "file", "left")
    return j.groupBy("lang").agg(F.sum("n").alias("n"), F.bool_and((F.col("sha256") == F.col("again")) & (F.length("sha256") == 64)).alias("sound"))


@query(_AGREEMENT)
def k7_agreement_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How closely two sources of the same texts agree, a line a group, as a Markdown table."""
    i = F.col("item_id")
    b = table(spark, sf_dir, "benchmark").select(i.alias("doc_id"), F.col("text").alias("a"), F.when(i % 3 == 0, F.concat("text", F.lit(" and a few more words at its end"))).when(i % 3 == 1, F.col("text")).alias("b"))
    a = b.withColumn("agreement", textmining.shingle_agreement(F.col("a"), F.col("b")))
    g = a.groupBy((F.col("doc_id") % 4).alias("session")).agg(F.count(F.lit(1)).alias("speeches"), F.count("b").alias("in_both"), F.round(F.median("agreement"), 3).alias("median"), F.count_if(F.col("agreement") < 0.9).alias("below"))
    return writers.report(g, "Sources compared", "Agreement is the share of five-word runs that both sources have.", ["session"])


@query("SELECT doc_id, CASE WHEN doc_id % 50 = 0 THEN '__DATE__,__TITLE__' ELSE '__TITLE__' END AS left_over FROM documents WHERE doc_id % 25 = 0")
def k9_placeholders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendered pages that still have placeholders, of which some were left in."""
    i = F.col("doc_id")
    d = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.when(i % 50 == 0, "__DATE__ ").otherwise(""), F.when(i % 25 == 0, "__TITLE__").otherwise("Title"), F.lit("\n"), "text").alias("page"))
    return checks.placeholders(d, "page").select("doc_id", F.array_join("left_over", ",").alias("left_over"))


@query("SELECT source, count(*) AS n, count(*) FILTER (quality IS NULL) AS unlabelled, round(avg((n_chars >= 300)::INT), 6) AS long_share FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1")
def k6_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return d.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("quality").isNull()).alias("unlabelled"), F.round(F.avg((F.col("n_chars") >= 300).cast("double")), 6).alias("long_share"))


# --- functions not met elsewhere ---


@query()
def f5_closest_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").select("n_nationkey", F.concat(F.lower("n_name"), F.lit("x")).alias("t"))
    return sequences.closest_name(n, "t", {f"nation_{i}": f"N{i}" for i in range(25)}).select("n_nationkey", "code")


@query("SELECT s_suppkey, trim(replace(s_name, 'Supplier', '')) AS name FROM supplier")
def f7_honorifics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select("s_suppkey", F.btrim(F.replace(S.strip_honorific(F.concat(F.lit("H.E. "), F.col("s_name"), F.lit(" (X):")), r"H\.E\. "), F.lit("Supplier"), F.lit(""))).alias("name"))


@query(r"SELECT doc_id, lang, len(w) AS n_tokens, sha256(array_to_string(w, ' ')) AS tokens_sha256 FROM (SELECT doc_id, lang, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM documents)")
def f13_tokens_by_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), "text", "lang").select("doc_id", "lang", "n_tokens", "tokens_sha256")


@query("""WITH s AS (SELECT unnest(['the', 'and', 'of', 'assembly', 'thank']) AS w UNION SELECT unnest(regexp_extract_all(lower(n_name), '\\p{L}+')) FROM nation UNION SELECT unnest(regexp_extract_all(lower(r_name), '\\p{L}+')) FROM region), t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS w FROM documents)
SELECT doc_id, count(*) FILTER (w IN (SELECT w FROM s)) AS stopped, count(*) FILTER (w NOT IN (SELECT w FROM s)) AS kept FROM t GROUP BY 1""")
def f15_stop_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of texts that a list stops: common words, standing phrases, and the words of all names."""
    names = table(spark, sf_dir, "nation").select(F.col("n_name").alias("name")).unionByName(table(spark, sf_dir, "region").select(F.col("r_name").alias("name")))
    stop = textmining.stop_list([("The", "and", "of"), ("assembly", "thank")], names, "name").withColumn("stop", F.lit(True))
    t = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("word")).groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("n"))
    n = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).cast("long")
    return t.join(stop, "word", "left").groupBy("doc_id").agg(n(F.col("stop").isNotNull()).alias("stopped"), n(F.col("stop").isNull()).alias("kept"))


# --- the race: asks and candidates' mentions ---


@query(r"""WITH c AS (SELECT * FROM (VALUES ('A', 5, false), ('B', 9, false), ('C', 7, true)) v(name, encourage, withdrew)), m AS (SELECT doc_id, [regexp_matches(text, '(?i)(?:^|[^\p{L}\p{N}_])that(?:$|[^\p{L}\p{N}_])'), regexp_matches(text, '(?i)(?:^|[^\p{L}\p{N}_])from(?:$|[^\p{L}\p{N}_])'), regexp_matches(text, '(?i)(?:^|[^\p{L}\p{N}_])nicht(?:$|[^\p{L}\p{N}_])')] AS h FROM documents),
n AS (SELECT 'A' AS name, count(*) FILTER (h[1]) AS speeches FROM m UNION ALL SELECT 'B', count(*) FILTER (h[2]) FROM m UNION ALL SELECT 'C', count(*) FILTER (h[3]) FROM m) SELECT name, encourage, withdrew, speeches, name = 'B' AS leads FROM c JOIN n USING (name)""")
def t16_race(spark: SparkSession, sf_dir: str) -> DataFrame:
    who = spark.createDataFrame([("A", r"(?iu)\bthat\b", 5, False), ("B", r"(?iu)\bfrom\b", 9, False), ("C", r"(?iu)\bnicht\b", 7, True)], "name string, pattern string, encourage int, withdrew boolean")
    d = table(spark, sf_dir, "documents")
    english = d.where("lang = 'en'").select(F.col("doc_id").alias("slug"), "text")
    other = d.where("lang <> 'en'").select(F.col("doc_id").alias("slug"), "text")
    return candidates.summary(candidates.mentions(english, other, who.collect()), who)


# --- reports ---

@query(f"""WITH {_PANEL}, m AS (SELECT year(o_orderdate)::INT AS yr, l_suppkey AS outlet, p_brand AS subject, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY ALL), s AS (SELECT yr, subject, sum(n) AS n FROM m JOIN panel USING (outlet) GROUP BY ALL)
SELECT yr, subject, n::BIGINT AS n, place::INT AS place FROM (SELECT *, row_number() OVER (PARTITION BY yr ORDER BY n DESC, subject) AS place FROM s) WHERE place <= 5""")
def d1_attention_over_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, _, _ = _panel(spark, sf_dir)
    l = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    s = l.join(p.select(F.col("outlet").alias("l_suppkey")), "l_suppkey").groupBy(F.year("o_orderdate").alias("yr"), F.col("p_brand").alias("subject")).agg(F.count(F.lit(1)).alias("n"))
    return relational.top_per_key(s, ["yr"], [F.desc("n"), F.col("subject")], 5, "place")


@query("SELECT id, max_by(name, rank) AS name FROM (SELECT n_nationkey AS id, n_name AS name, 1 AS rank FROM nation UNION ALL SELECT n_nationkey, lower(n_name), 2 FROM nation WHERE n_nationkey % 2 = 0) GROUP BY 1")
def d2_names_later_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    u = n.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.lit(1).alias("rank")).unionByName(n.where("n_nationkey % 2 = 0").select(F.col("n_nationkey").alias("id"), F.lower("n_name").alias("name"), F.lit(2).alias("rank")))
    return relational.keep_one(u, ["id"], [F.desc("rank")]).drop("rank")


@query("""WITH p AS (SELECT p_brand, count(*) AS podium FROM part GROUP BY 1), q AS (SELECT p_brand, count(*) AS press FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_quantity > 40 GROUP BY 1) SELECT p_brand, podium, coalesce(press, 0) AS press FROM p LEFT JOIN q USING (p_brand) WHERE podium >= 30 AND coalesce(press, 0) / podium <= 6""")
def d5_quiet_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.count(F.lit(1)).alias("podium"))
    q = table(spark, sf_dir, "lineitem").where("l_quantity > 40").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand").agg(F.count(F.lit(1)).alias("press"))
    j = p.join(q, "p_brand", "left").withColumn("press", F.coalesce("press", F.lit(0).cast("long")))
    return j.where((F.col("podium") >= 30) & (F.col("press") / F.col("podium") <= 6))


@query("""WITH t AS (SELECT c_nationkey AS a, s_nationkey AS b, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL) SELECT a, round(sum(n) FILTER (a = b) / sum(n), 6) AS own FROM t GROUP BY 1 HAVING sum(n) FILTER (a = b) / sum(n) >= 0.04""")
def d6_self_heavy(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey").join(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).join(table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("a")), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("b")), F.col("l_suppkey") == F.col("s_suppkey"))
    return l.groupBy("a").agg((F.count_if(F.col("a") == F.col("b")) / F.count(F.lit(1))).alias("own")).where("own >= 0.04").select("a", F.round("own", 6).alias("own"))


@query(f"""WITH {_MENTIONS}, g AS (SELECT s_suppkey AS outlet, CASE WHEN s_acctbal > 4000 THEN 'right' ELSE 'left' END AS leaning FROM supplier), j AS (SELECT * FROM m JOIN g USING (outlet)), t AS (SELECT leaning, sum(n) AS total FROM j GROUP BY 1), s AS (SELECT leaning, subject, sum(n) / any_value(total) AS share FROM j JOIN t USING (leaning) GROUP BY ALL),
w AS (SELECT subject, coalesce(max(share) FILTER (leaning = 'left'), 0) - coalesce(max(share) FILTER (leaning = 'right'), 0) AS gap FROM s GROUP BY 1) SELECT subject, round(gap, 9) AS gap FROM w ORDER BY abs(round(gap, 9)) DESC, subject LIMIT 2""")
def d7_leaning_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, m, _ = _panel(spark, sf_dir)
    j = m.join(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("outlet"), F.when(F.col("s_acctbal") > 4000, "right").otherwise("left").alias("leaning")), "outlet")
    t = j.groupBy("leaning").agg(F.sum("n").alias("total"))
    s = j.groupBy("leaning", "subject").agg(F.sum("n").alias("n")).join(t, "leaning").withColumn("share", F.col("n") / F.col("total"))
    side = lambda x: F.coalesce(F.max(F.when(F.col("leaning") == x, F.col("share"))), F.lit(0.0))
    return s.groupBy("subject").agg(F.round(side("left") - side("right"), 9).alias("gap")).orderBy(F.desc(F.abs("gap")), "subject").limit(2)


@query("SELECT r_name, m, rank() OVER (ORDER BY m DESC)::INT AS place FROM (SELECT r_name, round(avg(c_acctbal), 6) AS m FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1)")
def d8_lens_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return c.groupBy("r_name").agg(F.round(F.avg("c_acctbal"), 6).alias("m")).withColumn("place", F.rank().over(Window.orderBy(F.desc("m"))))


@query("SELECT n_name FROM nation ORDER BY CASE n_regionkey WHEN 3 THEN 1 WHEN 1 THEN 2 ELSE 3 END, n_name LIMIT 6")
def d11_preferred_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").orderBy(relational.preference(F.col("n_regionkey").cast("string"), ["3", "1"]), "n_name").limit(6).select("n_name")


@query("""WITH p AS (SELECT user_id, max(event_type) FILTER (ts::DATE = DATE '2024-01-02') AS a, max(event_type) FILTER (ts::DATE = DATE '2024-01-20') AS b FROM events GROUP BY 1) SELECT user_id, a, b FROM p WHERE a = 'view' AND b <> 'view'""")
def d12_vote_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = lambda d: F.max(F.when(F.col("ts").cast("date") == F.lit(d).cast("date"), F.col("event_type")))
    return table(spark, sf_dir, "events").groupBy("user_id").agg(day("2024-01-02").alias("a"), day("2024-01-20").alias("b")).where("a = 'view' AND b <> 'view'")


@query("SELECT k.kind, count(b.user_id) AS n FROM (VALUES ('click'), ('view'), ('purchase'), ('signup'), ('error'), ('none')) k(kind) LEFT JOIN (SELECT user_id, max(event_type) AS kind FROM events WHERE ts >= TIMESTAMP '2024-01-28' GROUP BY 1) b USING (kind) GROUP BY 1")
def d13_where_they_went(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = spark.createDataFrame([(k,) for k in ("click", "view", "purchase", "signup", "error", "none")], "kind string")
    b = table(spark, sf_dir, "events").where(F.col("ts") >= F.lit("2024-01-28").cast("timestamp_ntz")).groupBy("user_id").agg(F.max("event_type").alias("kind"))
    return kinds.join(b, "kind", "left").groupBy("kind").agg(F.count("user_id").alias("n"))


@query("SELECT b.item_id, count(d.doc_id) AS quoted_by FROM benchmark b LEFT JOIN documents d ON contains(d.text, b.text) GROUP BY 1")
def d16_context_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In how many documents each whole item stands."""
    return sequences.quoted_by(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"), "item_id")


@query(f"WITH q AS (SELECT item_id, {SENTENCES}[1] AS quote FROM benchmark) SELECT q.item_id, quote, count(d.doc_id) AS quoted_by FROM q LEFT JOIN documents d ON contains(d.text, quote) GROUP BY ALL")
def d17_highlights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Highlights, here each item's first sentence, with the number of documents that hold them word for word."""
    q = table(spark, sf_dir, "benchmark").select("item_id", F.get(S.sentences(F.col("text")), 0).alias("quote"))
    n = sequences.quoted_by(q.withColumnRenamed("quote", "text"), table(spark, sf_dir, "documents"), "item_id")
    return q.join(n, "item_id")


@query(r"""SELECT conv_id, turn, lower(regexp_extract(role || ' (Spain) (spoke in ' || CASE WHEN turn % 2 = 0 THEN 'French' ELSE 'Spanish' END || ')', 'spoke in ([A-Za-z]+)', 1)) AS language, 'Spain' AS country FROM conversations""")
def d18_label_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").withColumn("label", F.concat("role", F.lit(" (Spain) (spoke in "), F.when(F.col("turn") % 2 == 0, "French").otherwise("Spanish"), F.lit(")")))
    return c.select("conv_id", "turn", F.lower(F.regexp_extract("label", turns.SPOKEN, 1)).alias("language"), F.regexp_extract("label", r"\(([^()]+)\)\s*(?:\((?:spoke|interpretation)[^)]*\))?\s*$", 1).alias("country"))


@query("WITH m AS (SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL), b AS (SELECT lang, min_by(source, struct_pack(a := -n, b := source)) AS item FROM m GROUP BY 1) SELECT doc_id, item FROM documents JOIN b USING (lang)")
def d19_learnt_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return d.join(aggregates.mode(d, ["lang"], "source").select("lang", F.col("source").alias("item")), "lang").select("doc_id", "item")


@query("SELECT s_suppkey, CASE WHEN s_nationkey % 4 = 0 THEN 'Left' WHEN s_nationkey % 4 = 1 THEN 'Right' ELSE 'Not rated' END AS leaning, s_nationkey % 5 = 0 AS state_media FROM supplier")
def d20_leaning_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions.rules import lookup

    s = table(spark, sf_dir, "supplier")
    return s.select("s_suppkey", lookup((F.col("s_nationkey") % 4).cast("string"), {"0": "Left", "1": "Right"}, "Not rated").alias("leaning"), (F.col("s_nationkey") % 5 == 0).alias("state_media"))


@query()
def d21_one_region_blocs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocs of texts with the language that most of their members share, whether it is more than 70 % of them, whether they are loose, and which is the tightest."""
    b = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"), "text")
    w = stored(textmining.tfidf(b, "doc_id", S.word_tokens(F.col("text")), min_df=2))
    members, figures = topics.blocs(w, "doc_id", k=8)
    return topics.bloc_labels(members, figures, b.select("doc_id", S.french_or_english(F.col("text")).alias("label")), "doc_id")


@query("""WITH d AS (SELECT doc_id, doc_id % 2 = 0 AS site, doc_id % 3 = 0 AS corpus, doc_id % 5 = 0 AS record, doc_id % 7 < 3 AS scan, doc_id % 4 = 0 AS near, text FROM documents), k AS (SELECT *, scan AND (NOT corpus OR near) AS s FROM d)
SELECT doc_id, CASE WHEN site THEN 'site' WHEN corpus THEN 'corpus' WHEN record THEN 'record' WHEN s THEN 'scan' END AS speaker_source, CASE WHEN record THEN 'en' WHEN site AND doc_id % 8 = 0 THEN 'fr' WHEN s THEN 'es' END AS spoken, CASE WHEN record THEN 'record' WHEN corpus THEN 'corpus' WHEN s THEN 'scan' WHEN site AND doc_id % 11 < 5 THEN 'site_statement' WHEN site THEN 'site_transcript' END AS english_source,
CASE WHEN site AND doc_id % 8 = 0 THEN 'site' WHEN record THEN 'english' END AS original_source, sha256(CASE WHEN record THEN 'r' WHEN corpus THEN 'c' WHEN s THEN 's' WHEN site AND doc_id % 11 < 5 THEN 'a' WHEN site THEN 'b' END || text) AS english, corpus AS in_corpus FROM k""")
def u7_fused_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a speech from four sources, of which each has some of the documents."""
    i, t = F.col("doc_id"), F.col("text")
    site, corpus, record, scan = i % 2 == 0, i % 3 == 0, i % 5 == 0, i % 7 < 3
    text = lambda mark, has: F.when(has, F.concat(F.lit(mark), t))
    d = table(spark, sf_dir, "documents").select(
        "doc_id", site.alias("has_site"), record.alias("has_record"), F.when(i % 4 == 0, 0.8).when(i % 4 == 1, 0.2).alias("agreement"),
        *[F.when(h, n).alias(f"{n}_speaker") for n, h in (("site", site), ("corpus", corpus), ("record", record), ("scan", scan))],
        F.when(record, "en").alias("record_spoken"), F.when(site & (i % 8 == 0), "fr").alias("site_spoken"), F.when(scan, "es").alias("scan_spoken"),
        text("r", record).alias("record_text"), text("c", corpus).alias("corpus_text"), text("s", scan).alias("scan_text"), text("a", site & (i % 11 < 5)).alias("site_statement"), text("b", site).alias("site_transcript"),
        F.when(site & (i % 8 == 0), t).alias("site_original"),
    )
    f = fusion.speeches(d, "doc_id")
    return f.select("doc_id", "speaker_source", "spoken", "english_source", "original_source", F.sha2("english", 256).alias("english"), "in_corpus")


@query("SELECT n_regionkey, max_by(n_name, struct_pack(a := n, b := n_name)) AS leader FROM (SELECT n_regionkey, n_name, count(*) AS n FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal > 0 GROUP BY ALL) GROUP BY 1")
def d22_leaders(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").where("s_acctbal > 0").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).groupBy("n_regionkey", "n_name").agg(F.count(F.lit(1)).alias("n"))
    return s.groupBy("n_regionkey").agg(F.max_by("n_name", F.struct("n", "n_name")).alias("leader"))


@query(f"WITH {_PANEL} SELECT count(*) FILTER (rule = 'reach') AS by_reach, count(*) FILTER (rule <> 'reach') AS by_words, (SELECT count(*) FROM o) - count(*) AS unused FROM panel")
def d24_panel_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, _, _ = _panel(spark, sf_dir)
    n = table(spark, sf_dir, "supplier").agg(F.count(F.lit(1)).alias("n"))
    return p.agg(F.count_if(F.col("rule") == "reach").alias("by_reach"), F.count_if(F.col("rule") != "reach").alias("by_words"), F.count(F.lit(1)).alias("used")).join(n, F.lit(True)).select("by_reach", "by_words", (F.col("n") - F.col("used")).alias("unused"))


# --- histories, fusion and checks that share operators with others ---


@query("SELECT s_suppkey, s_acctbal, '2024-01-01' AS valid_from, NULL::VARCHAR AS valid_to, true AS is_current, '2024-02-01' AS last_checked FROM supplier")
def h2_unchanged(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    first = s.select("*", F.lit("2024-01-01").alias("valid_from"), F.lit(None).cast("string").alias("valid_to"), F.lit(True).alias("is_current"), F.lit("2024-01-01").alias("last_checked"))
    return history.apply_batch(first, s, "s_suppkey", ["s_acctbal"], F.lit("2024-02-01"))


@query("SELECT doc_id, sha256(text) AS text_sha256, n_chars, '2024-01-01' AS valid_from FROM documents")
def h3_text_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("text_sha256"), "n_chars")
    empty = d.limit(0).select("*", F.lit(None).cast("string").alias("valid_from"), F.lit(None).cast("string").alias("valid_to"), F.lit(True).alias("is_current"), F.lit(None).cast("string").alias("last_checked"))
    return history.apply_batch(empty, d, "doc_id", ["text_sha256", "n_chars"], F.lit("2024-01-01")).select("doc_id", "text_sha256", "n_chars", "valid_from")


@query("SELECT lang, count(*) AS n FROM documents GROUP BY 1")
def h5_fingerprint_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored under a digest of the input's rows, so that the same input is not worked out twice."""
    from ..sources.tables import cached

    d = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return cached(d, "h5", lambda x: x.groupBy("lang").agg(F.count(F.lit(1)).alias("n")))


@query("SELECT n_nationkey FROM nation WHERE n_nationkey % 3 = 0")
def v3_unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").select("n_nationkey", F.when(F.col("n_nationkey") % 3 != 0, F.col("n_name")).otherwise("").alias("label"))
    return checks.unlabelled(n, "label").select("n_nationkey")
