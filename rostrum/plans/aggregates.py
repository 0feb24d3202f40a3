"""Aggregations, lexicon figures, attention and statistics on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import lexicon, numbers, rules
from ..functions import strings as S
from ..operators import aggregates as A
from ..operators import attention as T
from ..sources.tables import stored
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


#: A test lexicon that both engines' patterns can read, for the driver's invented texts.
ISSUES = {"rights": r"all rights reserved", "license": r"licen[sc]e", "password": r"password=", "numbers": r"[0-9]{3}", "mail": r"@[a-z0-9.]+"}
FRAMES = {"northern": r"tion|ing", "southern": r"ción|mente", "central": r"ung|keit"}
_I = lexicon.patterns(ISSUES)
_F = lexicon.patterns(FRAMES)
_DOC_ISSUES = "list_filter([" + ", ".join(f"CASE WHEN regexp_matches(text, '(?i){p}') THEN '{n}' END" for n, p in ISSUES.items()) + "], lambda x: x IS NOT NULL)"
_COUNT = {n: f"len(regexp_extract_all(text, '(?i){p}'))" for n, p in FRAMES.items()}
_WORDS = r"len(regexp_extract_all(text, '\S+'))"


@query(f"SELECT doc_id, array_to_string({_DOC_ISSUES}, ',') AS issues FROM documents")
def p4_issue_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(lexicon.flags(F.col("text"), _I), ",").alias("issues"))


@query(f"""WITH h AS (SELECT lang, unnest({_DOC_ISSUES}) AS name FROM documents), s AS (SELECT lang, count(*) AS size FROM documents GROUP BY 1)
SELECT name, lang, count(*) AS n, round(count(*) / any_value(size), 3) AS share FROM h JOIN s USING (lang) GROUP BY name, lang""")
def a3_issue_shares_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("lang", lexicon.flags(F.col("text"), _I).alias("issues"))
    return A.shares_by_group(d, F.col("issues"), "lang")


@query(f"""WITH h AS (SELECT lang, unnest({_DOC_ISSUES}) AS name FROM documents), s AS (SELECT lang, count(*) AS size FROM documents GROUP BY 1)
SELECT name, lang, count(*) AS n, round(count(*) / any_value(size), 3) AS share FROM h JOIN s USING (lang) GROUP BY name, lang UNION ALL SELECT name, NULL, count(*), round(count(*) / (SELECT count(*) FROM documents), 3) FROM h GROUP BY name""")
def m13_membership_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("lang", lexicon.flags(F.col("text"), _I).alias("issues"))
    return A.membership_shares(d, F.col("issues"), "lang")


#: Sentences of the kind that the political lists look for, one before each of the driver's invented texts.
SAID = ("A multipolar world needs the Charter. ", "Hegemony and double standards must end; lift unilateral coercive measures. ", "The great power veto harms the Global South. ", "Nuclear weapons defy international law. ", "We thank you. ")
_SAID = "(SELECT doc_id, (" + "[" + ", ".join(f"'{x}'" for x in SAID) + "])[doc_id % 5 + 1] || text AS text FROM documents)"


def _said(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.concat(F.get(F.array(*[F.lit(x) for x in SAID]), (F.col("doc_id") % 5).cast("int")), "text").alias("text"))


_MARKERS = "[" + ", ".join(f"CASE WHEN regexp_matches(text, '(?i){p}') THEN '{n}' END" for n, p in lexicon.MARKERS.items()) + "]"


@query(f"SELECT doc_id, array_to_string(list_filter({_MARKERS}, lambda x: x IS NOT NULL), ',') AS markers FROM {_SAID}")
def p5_marker_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _said(spark, sf_dir).select("doc_id", F.array_join(lexicon.flags(F.col("text"), lexicon.patterns(lexicon.MARKERS)), ",").alias("markers"))


@query(f"SELECT doc_id, regexp_matches(text, '(?i)\\bcharter\\b|international law') AS charter FROM {_SAID}")
def p6_charter_or_law(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _said(spark, sf_dir).select("doc_id", F.col("text").rlike(lexicon.CHARTER_OR_LAW).alias("charter"))


@query("SELECT doc_id, " + ", ".join(f"round(1000 * {c} / greatest({_WORDS}, 1), 2) AS {n}" for n, c in _COUNT.items()) + " FROM documents")
def t12_frame_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", *[c.alias(n) for n, c in lexicon.rates(F.col("text"), _F).items()])


@query("SELECT doc_id, " + ", ".join(f"round(1000 * len(regexp_extract_all(text, '(?i){p}')) / greatest({_WORDS}, 1), 2) AS {n}" for n, p in ISSUES.items()) + " FROM documents")
def m7_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", *[c.alias(n) for n, c in lexicon.rates(F.col("text"), _I).items()])


_RATES = "r AS (SELECT doc_id, lang, source, n_chars, " + ", ".join(f"round(1000 * {c} / greatest({_WORDS}, 1), 2) AS {n}" for n, c in _COUNT.items()) + " FROM documents)"


def _rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", "lang", "source", "n_chars", *[c.alias(n) for n, c in lexicon.rates(F.col("text"), _F).items()])


_Z = ", ".join(f"round(({n} - avg({n}) OVER ()) / coalesce(nullif(stddev_pop({n}) OVER (), 0), 1), 6) AS z_{n}" for n in FRAMES)


@query(f"""WITH {_RATES}, z AS (SELECT doc_id, {_Z} FROM r)
SELECT doc_id, z_northern, z_southern, z_central, CASE WHEN greatest(z_northern, z_southern, z_central) < 0.5 THEN 'No clear lean'
  WHEN z_northern = greatest(z_northern, z_southern, z_central) THEN 'northern' WHEN z_southern = greatest(z_northern, z_southern, z_central) THEN 'southern' ELSE 'central' END AS lean FROM z""")
def m5_zscore_lean(spark: SparkSession, sf_dir: str) -> DataFrame:
    z = numbers.z_scores(stored(_rates(spark, sf_dir)), list(FRAMES)).select("doc_id", *[F.round(f"z_{n}", 6).alias(f"z_{n}") for n in FRAMES])
    return z.withColumn("lean", numbers.lean({n: F.col(f"z_{n}") for n in FRAMES}))


@query(f"""WITH {_RATES}, r2 AS (SELECT source, lang, {", ".join(f"round(avg({n}), 6) AS {n}" for n in FRAMES)} FROM r GROUP BY ALL), z AS (SELECT source, lang, {_Z} FROM r2)
SELECT source, lang, CASE WHEN greatest(z_northern, z_southern, z_central) < 0.5 THEN 'No clear lean' WHEN z_northern = greatest(z_northern, z_southern, z_central) THEN 'northern' WHEN z_southern = greatest(z_northern, z_southern, z_central) THEN 'southern' ELSE 'central' END AS lean FROM z""")
def w16_lean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups' leans among all groups' mean rates."""
    m = stored(_rates(spark, sf_dir).groupBy("source", "lang").agg(*[F.round(F.avg(n), 6).alias(n) for n in FRAMES]))
    z = numbers.z_scores(m, list(FRAMES))
    return z.select("source", "lang", numbers.lean({n: F.round(f"z_{n}", 6) for n in FRAMES}).alias("lean"))


@query("""WITH z AS (SELECT doc_id, lang, round((n_chars - avg(n_chars) OVER (PARTITION BY lang)) / coalesce(nullif(stddev_pop(n_chars) OVER (PARTITION BY lang), 0), 1), 6) AS z FROM documents) SELECT * FROM z WHERE abs(z) >= 2.5""")
def w15_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return numbers.z_scores(d, ["n_chars"], ["lang"]).select("doc_id", "lang", F.round("z_n_chars", 6).alias("z")).where(F.abs("z") >= 2.5)


@query("""WITH b AS (SELECT floor(n_chars / 500)::BIGINT AS i, count(*) AS n FROM documents GROUP BY 1), g AS (SELECT unnest(generate_series((SELECT min(i) FROM b), (SELECT max(i) FROM b))) AS i)
SELECT (g.i * 500)::BIGINT AS bin, coalesce(n, 0) AS n FROM g LEFT JOIN b USING (i)""")
def m6_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbers.histogram(table(spark, sf_dir, "documents"), "n_chars", 500).withColumn("bin", F.col("bin").cast("long"))


@query("""WITH r AS (SELECT c_acctbal AS v, row_number() OVER (ORDER BY c_acctbal) - 1 AS i, count(*) OVER () AS n FROM customer), q AS (SELECT max(v) FILTER (i = floor(0.03 * n)) AS a, max(v) FILTER (i = floor(0.97 * n) - 1) AS b FROM r)
SELECT c_custkey, c_acctbal, greatest(0, least(1, (c_acctbal - a) / coalesce(nullif(b - a, 0), 1))) AS spread_c_acctbal FROM customer, q""")
def m8_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbers.spread(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), "c_acctbal")


@query(rf"""WITH d AS (SELECT doc_id, {_WORDS} AS w0, greatest(1, len({SENTENCES})) AS s, list_sum(list_transform(list_filter(string_split_regex(lower(text), '[^\p{{L}}]+'), lambda x: x <> ''), lambda x: greatest(1, len(regexp_extract_all(regexp_replace(x, '([^aeiouy])e$', '\1'), '[aeiouyàâäéèêëîïôöùûü]+'))))) AS y0 FROM documents),
n AS (SELECT doc_id, greatest(w0, 1) AS w, s, coalesce(y0, 0) AS y FROM d) SELECT doc_id, round(0.39::DOUBLE * w / s + 11.8::DOUBLE * y / w - 15.59::DOUBLE, 1) AS grade, round(206.835::DOUBLE - 1.015::DOUBLE * w / s - 84.6::DOUBLE * y / w, 1) AS ease, round(w / s, 1) AS words_per_sentence FROM n""")
def m9_readability(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", S.word_count(F.col("text")).alias("words"), F.greatest(F.lit(1), F.size(S.sentences(F.col("text")))).alias("sents"), numbers.syllable_count(F.col("text")).alias("syllables"))
    w, s, y = F.greatest(F.col("words"), F.lit(1)), F.col("sents"), F.col("syllables")
    return d.select("doc_id", numbers.grade_level(w, s, y).alias("grade"), numbers.reading_ease(w, s, y).alias("ease"), numbers.rounded(w / s, 1).alias("words_per_sentence"))


@query("SELECT lang, map_from_entries(list(struct_pack(k := source, v := n) ORDER BY source))::VARCHAR AS sources FROM (SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL) GROUP BY lang".replace("map_from_entries(list(struct_pack(k := source, v := n) ORDER BY source))::VARCHAR", "string_agg(source || '=' || n, ',' ORDER BY source)"))
def m12_map_of_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "documents").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    m = c.groupBy("lang").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("source", "n")))).alias("m"))
    return m.select("lang", F.array_join(F.transform(F.map_entries("m"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",").alias("sources"))


@query("SELECT count(*) AS n, sum(n_chars)::BIGINT AS total, floor(median(n_chars))::BIGINT AS median, avg((lang = 'en')::INT)::DOUBLE AS english_share, avg((n_chars > 2000)::INT)::DOUBLE AS long_share FROM documents")
def a1_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.overview(table(spark, sf_dir, "documents"), F.col("n_chars"), {"english": F.col("lang") == "en", "long": F.col("n_chars") > 2000})


@query("SELECT o_orderpriority, year(o_orderdate)::INT AS yr, count(*) AS n, median(o_totalprice) AS median, avg((o_orderstatus = 'F')::INT)::DOUBLE AS done_share FROM orders GROUP BY ALL")
def a2_distributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy("o_orderpriority", F.year("o_orderdate").alias("yr")).agg(F.count(F.lit(1)).alias("n"), F.median("o_totalprice").alias("median"), F.avg((F.col("o_orderstatus") == "F").cast("double")).alias("done_share"))


@query(f"WITH {_RATES} SELECT lang, source, round(avg(northern), 6) AS northern, round(avg(southern), 6) AS southern, count(*) AS n FROM r GROUP BY GROUPING SETS ((lang), (source))")
def a4_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.means_by(_rates(spark, sf_dir), ["lang", "source"], ["northern", "southern"], 6)


@query("SELECT lang, quality, count(*) AS n, round(avg(n_chars), 3) AS mean FROM documents JOIN labels USING (doc_id) GROUP BY CUBE (lang, quality)")
def a5_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    return d.cube("lang", "quality").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("n_chars"), 3).alias("mean"))


@query("SELECT lang, source, count(*) AS n FROM documents GROUP BY ROLLUP (lang, source)")
def a5_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").rollup("lang", "source").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT year(o_orderdate)::INT AS yr, count(*) AS n, floor(median(o_totalprice))::BIGINT AS median, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS priorities,
  CASE WHEN avg((o_orderstatus <> 'O')::INT) >= 0.5 THEN count(*) FILTER (o_orderstatus = 'F')::DOUBLE / count(*) FILTER (o_orderstatus <> 'O') END AS share FROM orders GROUP BY 1""")
def a6_yearly_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").withColumn("yr", F.year("o_orderdate"))
    a = o.groupBy("yr").agg(F.floor(F.median("o_totalprice")).cast("long").alias("median"), F.array_join(F.array_sort(F.collect_set("o_orderpriority")), ",").alias("priorities"))
    return a.join(A.share_if_known(o, ["yr"], F.col("o_orderstatus") == "F", F.col("o_orderstatus") != "O"), "yr")


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, count(DISTINCT l_suppkey) AS suppliers, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem GROUP BY ALL")
def a11_role_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem")
    return l.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("l_suppkey").alias("suppliers"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


@query("""SELECT event_type, c.n AS counted, o.n AS official FROM (SELECT event_type, count(*) AS n FROM events GROUP BY 1) c FULL JOIN (SELECT event_type, count(*) + (event_type = 'click')::INT AS n FROM events WHERE event_type <> 'error' GROUP BY 1) o USING (event_type) WHERE c.n IS DISTINCT FROM o.n""")
def a12_check_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Differences from official totals, of which one is wrong and one is missing here."""
    c = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    official = c.where("event_type <> 'error'").withColumn("n", F.col("n") + (F.col("event_type") == "click").cast("int"))
    return A.check_totals(c, official, ["event_type"])


@query("""WITH o AS (SELECT o_orderkey, o_totalprice FROM orders), l AS (SELECT l_orderkey AS o_orderkey, count(*) AS n FROM lineitem GROUP BY 1), x AS (SELECT o_orderkey, CASE WHEN o_orderkey % 100 = 0 THEN n + 1 ELSE n END AS n FROM l WHERE o_orderkey % 97 <> 0)
SELECT o_orderkey, l.n AS counted, x.n AS official FROM l FULL JOIN x USING (o_orderkey) WHERE l.n IS DISTINCT FROM x.n""")
def v4_vote_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose lines do not add up to their official number: some numbers were altered, some are missing."""
    l = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n"))
    k = F.col("o_orderkey")
    return A.check_totals(l, l.where(k % 97 != 0).withColumn("n", F.col("n") + (k % 100 == 0).cast("int")), ["o_orderkey"])


@query("""SELECT source, count(*) AS n, count(*) FILTER (quality IS NULL) AS unlabelled, count(*) FILTER (toxic = 1) AS toxic, median(n_chars) AS median, count(*) FILTER (n_chars < 1000) AS short, count(lang) AS language_known FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1""")
def a13_source_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return d.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("quality").isNull()).alias("unlabelled"), F.count_if(F.col("toxic") == 1).alias("toxic"), F.median("n_chars").alias("median"), F.count_if(F.col("n_chars") < 1000).alias("short"), F.count("lang").alias("language_known"))


@query("""WITH c AS (SELECT conv_id, bool_or(role = 'system') AS has_system, bool_or(length(text) > 500) AS has_long FROM conversations GROUP BY 1) SELECT count(*) AS conversations, count(*) FILTER (has_system) AS with_system, count(*) FILTER (has_long) AS with_long FROM c""")
def a14_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.bool_or(F.col("role") == "system").alias("s"), F.bool_or(F.length("text") > 500).alias("l"))
    return c.agg(F.count(F.lit(1)).alias("conversations"), F.count_if("s").alias("with_system"), F.count_if("l").alias("with_long"))


#: Headlines: a verb of some tone, if any, before and after a page's own words.
VERBS = ("warns against", "urges", "hails", "calls for", "pledges", "says")
_HEADS = "h AS (SELECT page_id, 'State ' || (['" + "', '".join(VERBS) + "'])[page_id % 6 + 1] || ' ' || CASE WHEN page_id % 4 = 0 THEN 'action on climate' ELSE 'peace in Ukraine' END || CASE WHEN page_id % 9 = 0 THEN ' and rejects sanctions' ELSE '' END AS head FROM pages)"
_TONES = ", ".join(f"nullif(regexp_extract(lower(head), '^(.*?)\\b(?:{p})\\b', 1), '') AS t{i}" for i, p in enumerate(lexicon.TONES.values()))


@query(f"""WITH {_HEADS}, t AS (SELECT page_id, head, {_TONES} FROM h), f AS (SELECT *, least(coalesce(length(t0), 9999), coalesce(length(t1), 9999), coalesce(length(t2), 9999)) AS first FROM t),
k AS (SELECT page_id, head, CASE WHEN first = 9999 THEN 'Statement, no verb' WHEN first = length(t0) THEN 'Alarm' WHEN first = length(t1) THEN 'Appeal' ELSE 'Showcase' END AS tone, CASE WHEN first < 9999 THEN regexp_extract(lower(head[first + 1 :]), '^(?:{"|".join(lexicon.TONES.values())})') END AS verb FROM f),
u AS (SELECT 'tone' AS kind, tone AS name, count(*) AS n FROM k GROUP BY 2 UNION ALL SELECT 'verb', verb, count(*) FROM k WHERE verb IS NOT NULL GROUP BY 2 UNION ALL SELECT 'issue', 'Climate change', count(*) FROM k WHERE contains(head, 'climate') UNION ALL SELECT 'issue', 'Ukraine', count(*) FROM k WHERE contains(head, 'Ukraine') UNION ALL SELECT 'issue', 'Sanctions', count(*) FROM k WHERE contains(head, 'sanction'))
SELECT kind, name, n, row_number() OVER (PARTITION BY kind ORDER BY n DESC, name)::INT AS place FROM u WHERE n > 0 QUALIFY kind <> 'verb' OR row_number() OVER (PARTITION BY kind ORDER BY n DESC, name) <= 15""")
def a15_headlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tones, the 15 most frequent verbs and issues of headlines."""
    i = F.col("page_id")
    head = F.concat(F.lit("State "), F.get(F.array(*[F.lit(v) for v in VERBS]), (i % 6).cast("int")), F.lit(" "), F.when(i % 4 == 0, "action on climate").otherwise("peace in Ukraine"), F.when(i % 9 == 0, " and rejects sanctions").otherwise(""))
    return A.headlines(table(spark, sf_dir, "pages").select(head.alias("head")), "head")


@query("""SELECT lower(m) AS lang, count(*) AS n, count(DISTINCT page_id) AS pages FROM (SELECT page_id, unnest(regexp_extract_all(html, '<html lang="([a-z]+)"', 1)) AS m FROM pages) GROUP BY 1""")
def a16_translations(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = table(spark, sf_dir, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('<html lang="([a-z]+)"'), F.lit(1))).alias("m"))
    return m.groupBy(F.lower("m").alias("lang")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("page_id").alias("pages"))


@query(f"SELECT lang, round(1000 * sum({_COUNT['northern']}) / nullif(sum({_WORDS}), 0), 2) AS rate FROM documents GROUP BY 1")
def a17_ratio_of_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.ratio_of_sums(table(spark, sf_dir, "documents"), ["lang"], lexicon.counts(F.col("text"), _F)["northern"], S.word_count(F.col("text")))


# --- attention: suppliers are outlets in their nations, part brands the subjects, balances the reach ---

_PANEL = """o AS (SELECT n_name AS country, n_regionkey, s_suppkey AS outlet, CASE WHEN s_acctbal > 5000 THEN s_acctbal END AS reach, words, reports FROM supplier JOIN nation ON s_nationkey = n_nationkey
  LEFT JOIN (SELECT l_suppkey, sum(l_quantity)::BIGINT AS words, count(*) AS reports FROM lineitem GROUP BY 1) ON l_suppkey = s_suppkey),
panel AS (SELECT country, outlet, CASE WHEN total IS NOT NULL THEN reach / total ELSE 1.0 END::DOUBLE AS weight, CASE WHEN total IS NOT NULL THEN 'reach' ELSE 'most words' END AS rule
  FROM (SELECT *, sum(reach) OVER (PARTITION BY country) AS total, row_number() OVER (PARTITION BY country ORDER BY words DESC NULLS LAST, reports DESC NULLS LAST, outlet) AS rn FROM o)
  WHERE (total IS NOT NULL AND reach IS NOT NULL) OR (total IS NULL AND rn = 1))"""
_MENTIONS = "m AS (SELECT l_suppkey AS outlet, p_brand AS subject, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)"
_OWN = "own AS (SELECT n_name AS country, 'Brand#' || (n_nationkey % 5 + 1) || (n_nationkey // 5 + 1) AS subject FROM nation)"
_VIEWS = f"""{_PANEL}, {_MENTIONS}, {_OWN}, f AS (SELECT m.outlet, m.subject, m.n, country, weight FROM m JOIN panel USING (outlet) WHERE (country, m.subject) NOT IN (SELECT (country, subject) FROM own)),
tot AS (SELECT country, outlet, weight, sum(n) AS total FROM f GROUP BY ALL), cw AS (SELECT country, sum(weight) AS w, sum(total) AS votes FROM tot GROUP BY 1),
views AS (SELECT country, subject, sum(f.weight * n / total) / any_value(w) AS share, any_value(votes)::BIGINT AS votes FROM f JOIN tot USING (country, outlet) JOIN cw USING (country) GROUP BY ALL)"""


def _panel(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    l = table(spark, sf_dir, "lineitem")
    words = l.groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.sum("l_quantity").cast("long").alias("words"), F.count(F.lit(1)).alias("reports"))
    outlets = s.join(n, s.s_nationkey == n.n_nationkey).join(words, "s_suppkey", "left").select(F.col("n_name").alias("country"), F.col("s_suppkey").alias("outlet"), F.when(F.col("s_acctbal") > 5000, F.col("s_acctbal")).alias("reach"), "words", "reports")
    mentions = l.join(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), l.l_partkey == F.col("p_partkey")).groupBy(F.col("l_suppkey").alias("outlet"), F.col("p_brand").alias("subject")).agg(F.count(F.lit(1)).alias("n"))
    own = n.select(F.col("n_name").alias("country"), F.concat(F.lit("Brand#"), (F.col("n_nationkey") % 5 + 1).cast("string"), (F.floor(F.col("n_nationkey") / 5) + 1).cast("string")).alias("subject"))
    # both are small next to the tables they sum up, and are used several times
    return stored(T.panel(outlets)), stored(mentions), own


@query(f"WITH {_PANEL} SELECT country, outlet, round(weight, 9) AS weight, rule FROM panel")
def a18_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _panel(spark, sf_dir)[0].withColumn("weight", F.round("weight", 9))


@query(f"WITH {_VIEWS} SELECT subject, round(sum(share) / (SELECT count(DISTINCT country) FROM views WHERE votes >= 10), 9) AS share FROM views WHERE votes >= 10 GROUP BY 1")
def a19_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, m, own = _panel(spark, sf_dir)
    return T.attention(T.country_views(m, p, own)).withColumn("share", F.round("share", 9))


@query(f"""WITH {_MENTIONS}, g AS (SELECT s_suppkey AS outlet, n_regionkey AS leaning FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal > 0), j AS (SELECT * FROM m JOIN g USING (outlet)), tot AS (SELECT outlet, sum(n) AS total FROM j GROUP BY 1), size AS (SELECT leaning, count(DISTINCT outlet) AS k FROM j GROUP BY 1)
SELECT leaning, subject, round(sum(n / total) / any_value(k), 9) AS share FROM j JOIN tot USING (outlet) JOIN size USING (leaning) GROUP BY ALL""")
def a20_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, m, _ = _panel(spark, sf_dir)
    g = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("outlet"), F.col("n_regionkey").alias("leaning"), (F.col("s_acctbal") <= 0).alias("state"))
    return T.by_group(m, g, "leaning", F.col("state")).withColumn("share", F.round("share", 9))


@query(f"""WITH {_VIEWS}, cr AS (SELECT n_name AS country, n_regionkey AS own_region FROM nation), sr AS (SELECT DISTINCT p_brand AS subject, (substr(p_brand, 7, 1)::INT - 1) AS region FROM part),
per AS (SELECT country, own_region, sum(CASE WHEN region = own_region THEN share ELSE 0 END) AS s FROM views JOIN cr USING (country) JOIN sr USING (subject) GROUP BY ALL)
SELECT own_region AS region, round(avg(s), 9) AS own_share, round((SELECT count(*) FROM sr WHERE region = own_region) / (SELECT count(*) FROM sr), 9) AS base_share FROM per WHERE own_region IN (SELECT region FROM sr) GROUP BY 1""")
def a21_home_bias(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, m, own = _panel(spark, sf_dir)
    cr = table(spark, sf_dir, "nation").select(F.col("n_name").alias("country"), F.col("n_regionkey").alias("region"))
    sr = table(spark, sf_dir, "part").select(F.col("p_brand").alias("subject"), (F.substring("p_brand", 7, 1).cast("int") - 1).alias("region")).distinct()
    return T.home_bias(T.country_views(m, p, own), cr, sr).select("region", F.round("own_share", 9).alias("own_share"), F.round("base_share", 9).alias("base_share"))


_VOICE = " UNION ALL ".join(f"SELECT '{n}' AS name, {c} AS n, {_WORDS} AS words FROM {{t}}" for n, c in _COUNT.items())


@query(f"""WITH a AS (SELECT name, round(1000 * sum(n) / sum(words), 2) AS podium FROM ({_VOICE.format(t='documents')}) GROUP BY 1), b AS (SELECT name, round(1000 * sum(n) / sum(words), 2) AS press FROM ({_VOICE.format(t='conversations')}) GROUP BY 1)
SELECT name, podium, press, round(press / nullif(podium, 0), 2) AS ratio FROM a FULL JOIN b USING (name)""")
def a22_voices(spark: SparkSession, sf_dir: str) -> DataFrame:
    def long(t: str) -> DataFrame:
        c = lexicon.counts(F.col("text"), _F)
        d = table(spark, sf_dir, t).select(S.word_count(F.col("text")).alias("words"), F.array(*[F.struct(F.lit(n).alias("name"), x.alias("n")) for n, x in c.items()]).alias("x"))
        return d.select("words", F.inline("x"))

    return T.voices(long("documents"), long("conversations"))


@query("""WITH c AS (SELECT r_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1)
SELECT r_name, n, 300::BIGINT AS quoted, CASE WHEN n = 300 THEN 'holds' WHEN abs(n - 300) <= 15 THEN 'close' ELSE 'differs' END AS verdict FROM c""")
def a23_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).groupBy("r_name").agg(F.count(F.lit(1)).alias("n"))
    return c.withColumn("quoted", F.lit(300).cast("long")).withColumn("verdict", F.when(F.col("n") == 300, "holds").when(F.abs(F.col("n") - 300) <= 15, "close").otherwise("differs"))


@query("""WITH x AS (SELECT lang, quality = 0 AS given, regexp_matches(text, '[#$%&*|!]{2}') AS found FROM labels JOIN documents USING (doc_id))
SELECT lang, count(*) AS n, count(*) FILTER (given = found) AS agree, count(*) FILTER (given AND found)::DOUBLE / nullif(count(*) FILTER (found), 0) AS precision, count(*) FILTER (given AND found)::DOUBLE / nullif(count(*) FILTER (given), 0) AS recall FROM x GROUP BY 1""")
def a24_precision_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents"), "doc_id").select("lang", (F.col("quality") == 0).alias("given"), F.col("text").rlike(r"[#$%&*|!]{2}").alias("found"))
    return A.precision_recall(x, ["lang"], F.col("given"), F.col("found"))


@query("""SELECT user_id, count(*) FILTER (event_type = 'click') AS click, count(*) FILTER (event_type = 'view') AS view, count(*) FILTER (event_type = 'signup') AS signup FROM events GROUP BY 1""")
def a25_crosstab(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.relational import crosstab

    return crosstab(table(spark, sf_dir, "events"), "user_id", "event_type", ["click", "view", "signup"])


@query("""SELECT n_name, p_brand, reach, row_number() OVER (PARTITION BY n_name ORDER BY reach DESC, p_brand)::INT AS rank FROM (SELECT n_name, p_brand, max(l_discount * 100) AS reach
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL)""")
def a26_brand_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")).join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    b = l.groupBy("n_name", "p_brand").agg(F.max(F.col("l_discount") * 100).alias("reach"))
    return b.withColumn("rank", F.row_number().over(Window.partitionBy("n_name").orderBy(F.desc("reach"), "p_brand")))


@query(r"""SELECT host, count(*) AS n FROM (SELECT regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host FROM pages) WHERE NOT suffix(host, '.example.com') GROUP BY 1 ORDER BY n DESC, host LIMIT 1""")
def a27_most_linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = table(spark, sf_dir, "pages").select(F.regexp_extract("url", "^[a-z]+://([^/?#]+)", 1).alias("host")).where(~F.col("host").endswith(".example.com"))
    return h.groupBy("host").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "host").limit(1)


@query("""SELECT user_id, event_type, n FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS rn FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL)) WHERE rn = 1""")
def a28_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.mode(table(spark, sf_dir, "events"), ["user_id"], "event_type")


@query("SELECT count(DISTINCT user_id) AS users, count(DISTINCT event_type) AS kinds, count(DISTINCT ts::DATE) AS days FROM events")
def a29_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").agg(F.count_distinct("user_id").alias("users"), F.count_distinct("event_type").alias("kinds"), F.count_distinct(F.col("ts").cast("date")).alias("days"))


@query("""SELECT c_mktsegment, n_name, n FROM (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY n DESC, n_name) AS rn FROM (SELECT c_mktsegment, n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL)) WHERE rn = 1""")
def a30_region_of_most(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return A.mode(c, ["c_mktsegment"], "n_name")


@query("""WITH t AS (SELECT o_orderpriority, o_custkey, sum(o_totalprice) AS v FROM orders GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY v) AS k FROM t)
SELECT o_orderpriority, round(2 * sum(k * v) / (count(*) * sum(v)) - (count(*) + 1) / count(*), 6) AS gini, count(*) AS n FROM r GROUP BY 1""")
def a31_gini(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "orders").groupBy("o_orderpriority", "o_custkey").agg(F.sum("o_totalprice").alias("v"))
    return A.lorenz(t, "v", ["o_orderpriority"]).withColumn("gini", F.round("gini", 6))


@query("""WITH t AS (SELECT s_nationkey, count(*) AS v FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1), r AS (SELECT v, row_number() OVER (ORDER BY v) AS k FROM t) SELECT round(2 * sum(k * v) / (count(*) * sum(v)) - (count(*) + 1) / count(*), 6) AS gini, count(*) AS n FROM r""")
def q5_lorenz_gini(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How unevenly attention (lines) falls on states."""
    t = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("v"))
    return A.lorenz(t, "v").withColumn("gini", F.round("gini", 6))


@query("""SELECT p_partkey, CASE WHEN regexp_matches(p_type, 'BRASS') AND regexp_matches(p_type, '^PROMO') THEN 'first' WHEN regexp_matches(p_type, 'STEEL|TIN') THEN 'second' WHEN regexp_matches(p_type, 'ECONOMY') THEN 'third' ELSE 'unclassified' END AS rank FROM part""")
def f6_ordered_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", rules.classify(F.col("p_type"), [("first", "^PROMO.*BRASS"), ("second", "STEEL|TIN"), ("third", "ECONOMY")], "unclassified").alias("rank"))


_TONE = {"warm": "th[ae]t", "cold": "la|le", "plain": "und"}


@query("""WITH p AS (SELECT doc_id, strpos(text, 'that') AS a1, strpos(text, 'thet') AS a2, strpos(text, 'la') AS b1, strpos(text, 'le') AS b2, strpos(text, 'und') AS c1 FROM documents),
m AS (SELECT doc_id, least(nullif(a1, 0), nullif(a2, 0)) AS warm, least(nullif(b1, 0), nullif(b2, 0)) AS cold, nullif(c1, 0) AS plain FROM p)
SELECT doc_id, CASE WHEN least(cold, plain, warm) IS NULL THEN NULL WHEN cold = least(cold, plain, warm) THEN 'cold' WHEN plain = least(cold, plain, warm) THEN 'plain' ELSE 'warm' END AS tone FROM m""")
def t15_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", lexicon.first_family(F.col("text"), _TONE).alias("tone"))
