"""Text queries on the driver's tables: scalar functions, tokens, similarity, entities."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import strings as S
from ..operators import entities as E
from ..operators import fusion
from ..operators import textmining as T
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


STOP = ("the", "and", "for", "les", "des", "der", "und", "los", "las")
_STOPS = "(" + ", ".join(f"'{w}'" for w in STOP) + ")"
TOK = rf"list_filter(regexp_extract_all(lower(text), '\p{{L}}+(?:[-''’]\p{{L}}+)*'), lambda w: length(w) >= 3 AND w NOT IN {_STOPS} AND NOT regexp_matches(w, '[''’](?:s|t|re|ve|ll|d|m)$'))"
_PLAIN = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')"


def _kept(token: "F.Column") -> "F.Column":
    return S.keeps(token, STOP)


def _tokens() -> "F.Column":
    return S.word_tokens(F.col("text"), STOP)


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


@query("""SELECT n_nationkey, lower(replace(replace(n_name, ' ', '-'), '_', '-')) AS slug FROM nation""")
def f19_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select("n_nationkey", S.slugify(F.col("n_name")).alias("slug"))


@query(r"""WITH h AS (SELECT page_id, regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/?#]+)', 1)), '^www\.', '') AS host FROM pages), l AS (SELECT page_id, string_split(host, '.') AS l FROM h)
SELECT page_id, CASE WHEN len(l) > 2 AND l[-2] IN ('co', 'com', 'org', 'net', 'gov', 'gob', 'ac', 'edu') THEN array_to_string(l[-3:], '.') ELSE array_to_string(l[-2:], '.') END AS site FROM l""")
def f20_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", S.site(F.regexp_extract("url", "^[a-z]+://([^/?#]+)", 1)).alias("site"))


#: Letters whose decomposition is one plain letter, as SQL twins need them.
_LETTERS, _PLAIN_LETTERS, _ = S.folding()
_NAME = rf"trim(regexp_replace(regexp_replace(lower(regexp_replace(translate(translate({{}}, '’`', repeat(chr(39), 2)), '{_LETTERS}', '{_PLAIN_LETTERS}'), '[^\x00-\x7F]', '', 'g')), '[^a-z'' -]', ' ', 'g'), '\s+', ' ', 'g'))"


@query(f"SELECT doc_id, sha256({_NAME.format('text')}) AS name FROM documents")
def f1_normalised_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", F.sha2(S.normalise_name(F.col("text")), 256).alias("name"))


@query(r"""WITH s AS (SELECT p_partkey, p_name, unnest(['red', 'deep red', 'blue', 'metal', 'steel', 'rose', 'blush']) AS name FROM part)
SELECT p.p_partkey, b.name, b.name AS code FROM part p LEFT JOIN (SELECT p_partkey, max_by(name, struct_pack(l := length(name), n := name)) AS name FROM s WHERE p_name = name OR suffix(p_name, ' ' || name) GROUP BY 1) b USING (p_partkey)""")
def f2_suffix_longest(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = spark.createDataFrame([(x, x) for x in ("red", "deep red", "blue", "metal", "steel", "rose", "blush")], "name string, code string")
    return E.resolve_suffix(table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_partkey", "p_name", names, normalise=False).select("p_partkey", "name", "code")


@query(r"""WITH s AS (SELECT p_partkey, p_name, unnest(['red', 'deep red', 'blue', 'metal', 'steel', 'rose', 'blush']) AS name FROM part)
SELECT p.p_partkey, b.name, b.name AS code FROM part p LEFT JOIN (SELECT p_partkey, max_by(name, struct_pack(l := length(name), n := name)) AS name FROM s WHERE contains(' ' || p_name || ' ', ' ' || name || ' ') GROUP BY 1) b USING (p_partkey)""")
def f3_contains_longest(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = spark.createDataFrame([(x, x) for x in ("red", "deep red", "blue", "metal", "steel", "rose", "blush")], "name string, code string")
    return E.find_within(table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_partkey", "p_name", names, normalise=False).select("p_partkey", "name", "code")


@query("""WITH s AS (SELECT s_suppkey, 'the office of ' || lower(replace(n_name, '_', ' ')) || CASE WHEN s_suppkey % 2 = 0 THEN '' ELSE ' abroad' END AS t, lower(replace(n_name, '_', ' ')) AS n FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN n END AS at_end, n AS within FROM s""")
def j5_theta_as_equi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names at the end of a text, and anywhere in it, both as equality joins: of "nation 2" and "nation 21" the right one."""
    n = table(spark, sf_dir, "nation").select("n_nationkey", F.lower(F.replace("n_name", F.lit("_"), F.lit(" "))).alias("name"))
    names = n.select("name", F.col("name").alias("code"))
    s = table(spark, sf_dir, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.concat(F.lit("the office of "), "name", F.when(F.col("s_suppkey") % 2 == 0, "").otherwise(" abroad")).alias("t"))
    ends = E.resolve_suffix(s, "s_suppkey", "t", names, normalise=False).select("s_suppkey", F.col("code").alias("at_end"))
    return E.find_within(s, "s_suppkey", "t", names, normalise=False).join(ends, "s_suppkey").select("s_suppkey", "at_end", F.col("code").alias("within"))


@query(f"""WITH n AS (SELECT upper(n_name[1]) || lower(n_name[2:]) AS base, 'N' || n_nationkey AS code FROM nation),
a AS (SELECT base || ' (Realm of)' AS name, code, 2 AS r FROM n UNION ALL SELECT 'Realm of ' || base, code, 2 FROM n UNION ALL SELECT base, code, 2 FROM n UNION ALL SELECT 'Old Realm', 'N0', 1 UNION ALL SELECT 'Côte d’Or', 'N1', 1)
SELECT name, max_by(code, struct_pack(r := r, c := code)) AS code FROM (SELECT {_NAME.format('name')} AS name, code, r FROM a) WHERE name <> '' GROUP BY 1""")
def f4_name_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").select(F.concat(F.initcap("n_name"), F.lit(" (Realm of)")).alias("name"), F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("code"))
    aliases = spark.createDataFrame([("Old Realm", "N0"), ("Côte d’Or", "N1")], "name string, code string")
    return E.name_table(n, aliases)


@query(f"SELECT doc_id, len({TOK})::INT AS n, array_to_string({TOK}[:5], ' ') AS head FROM documents")
def f14_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _docs(spark, sf_dir).select("doc_id", _tokens().alias("w"))
    return d.select("doc_id", F.size("w").alias("n"), F.array_join(F.slice("w", 1, 5), " ").alias("head"))


@query(f"SELECT t AS token, count(*) AS n, count(DISTINCT doc_id) AS docs FROM (SELECT doc_id, unnest({TOK}) AS t FROM documents) GROUP BY 1 ORDER BY n DESC, token LIMIT 30")
def a7_common_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.common(_docs(spark, sf_dir), "doc_id", S.raw_tokens(F.col("text")), 30, _kept)


@query(f"""WITH w AS (SELECT doc_id, {TOK} AS w FROM documents), g AS (SELECT doc_id, unnest(list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1])) AS t FROM w WHERE len(w) >= 2)
SELECT t AS token, count(*) AS n, count(DISTINCT doc_id) AS docs FROM g GROUP BY 1 ORDER BY n DESC, token LIMIT 40""")
def a7_common_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _docs(spark, sf_dir).select("doc_id", _tokens().alias("w"))
    return T.common(d, "doc_id", T.ngrams(F.col("w"), 2), 40)


@query("SELECT w AS word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]{2,}')) AS w FROM benchmark) GROUP BY 1 HAVING count(*) >= 3")
def a8_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.vocabulary(table(spark, sf_dir, "benchmark"), F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{2,}"), F.lit(0)), 3)


@query("""WITH v AS (SELECT w FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]{2,}')) AS w FROM benchmark) GROUP BY 1 HAVING count(*) >= 3), t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]{2,}')) AS w FROM documents)
SELECT d.doc_id, round(coalesce(s, 0), 3) AS share FROM documents d LEFT JOIN (SELECT doc_id, avg((w IN (SELECT w FROM v))::INT)::DOUBLE AS s FROM t GROUP BY 1) USING (doc_id)""")
def a9_token_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{2,}"), F.lit(0))
    known = T.vocabulary(table(spark, sf_dir, "benchmark"), words, 3)
    return T.vocabulary_share(_docs(spark, sf_dir), "doc_id", words, known)


@query(r"""WITH l AS (SELECT doc_id, trim(unnest(string_split(text, chr(10)))) AS line FROM documents) SELECT doc_id, line, count(*) AS n FROM l WHERE line <> '' AND length(line) < 80 GROUP BY ALL HAVING count(*) >= 3""")
def f11_repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.repeated_lines(_docs(spark, sf_dir), "doc_id", F.col("text"))


@query(r"""SELECT doc_id, len(s)::INT AS n, s[1] AS first FROM (SELECT doc_id, list_filter(string_split_regex(regexp_replace(text, '([.!?])\s+([A-Z"“])', '\1' || chr(1) || '\2', 'g'), chr(1)), lambda x: trim(x) <> '') AS s FROM documents)""")
def f16_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _docs(spark, sf_dir).select("doc_id", S.sentences(F.col("text")).alias("s"))
    return d.select("doc_id", F.size("s").alias("n"), F.get("s", 0).alias("first"))


#: Titles' points are hidden behind U+0002 while sentences are cut.
_HIDDEN = r"regexp_replace(replace(regexp_replace({}, '\b(Mr|Ms|Dr|St)\.', '\1' || chr(2), 'g'), 'H.E.', 'H.E' || chr(2)), 'Mrs\.', 'Mrs' || chr(2), 'g')"
TITLED = rf"""list_transform(list_filter(string_split_regex(regexp_replace(regexp_replace({_HIDDEN}, '([.!?])\s+([A-Z"“‘(])', '\1' || chr(1) || '\2', 'g'), '\s*[•●▪]\s*', chr(1), 'g'), chr(1)), lambda x: trim(x) <> ''), lambda x: replace(x, chr(2), '.'))"""
#: Titles and bullets, which the driver's texts have none of, put before each text.
_TITLES = "Mr. Smith met Dr. Lopez. Mrs. Jones came; H.E. Ms. Brown (St. Lucia) spoke! • One point ● Two points. “Quoted” end. "


@query(f"SELECT doc_id, len(s)::INT AS n, sha256(array_to_string(s, '|')) AS digest FROM (SELECT doc_id, {TITLED.format(f"'{_TITLES}' || text")} AS s FROM documents)")
def f17_sentences_with_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _docs(spark, sf_dir).select("doc_id", S.sentences(F.concat(F.lit(_TITLES), "text"), S.SENTENCE_TITLES).alias("s"))
    return d.select("doc_id", F.size("s").alias("n"), F.sha2(F.array_join("s", "|"), 256).alias("digest"))


@query(f"""WITH s AS (SELECT doc_id, {SENTENCES} AS s FROM documents) SELECT doc_id, (unnest(generate_series(0, (len(s) - 1) // 3)))::INT AS pos, array_to_string(s[3 * unnest(generate_series(0, (len(s) - 1) // 3)) + 1 : 3 * unnest(generate_series(0, (len(s) - 1) // 3)) + 3], ' ') AS chunk FROM s WHERE len(s) > 0""")
def f18_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _docs(spark, sf_dir).select("doc_id", S.chunks(S.sentences(F.col("text")), 3).alias("c"))
    return d.select("doc_id", F.posexplode("c").alias("pos", "chunk"))


@query(r"""SELECT page_id, NOT regexp_matches(t, '[.!?,:;”"]') AND len(list_filter(w, lambda x: regexp_matches(x, '^\P{L}') OR regexp_matches(x, '^\p{Lu}'))) >= 0.6 * len(w) AS menu
FROM (SELECT page_id, t, list_filter(string_split_regex(t, '\s+'), lambda x: x <> '') AS w FROM (SELECT page_id, regexp_extract(html, '<h1>([^<]*)', 1) AS t FROM pages))""")
def f21_menu(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", S.is_menu(F.regexp_extract("html", "<h1>([^<]*)", 1)).alias("menu"))


@query("""WITH h AS (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN '<meta property="article:published_time" content="2026-09-' || lpad((page_id % 28 + 1)::VARCHAR, 2, '0') || 'T10:00">' || html ELSE html END AS h FROM pages)
SELECT page_id, coalesce(nullif(regexp_extract(h, '(?is)<meta property="article:published_time" content="([0-9-]{10})', 1), ''), nullif(regexp_extract(h, '"datePublished"\\s*:\\s*"(20\\d\\d-\\d\\d-\\d\\d)', 1), ''), nullif(regexp_extract(h, '(?is)<time[^>]*datetime=["''][^"'']*?(20\\d\\d-\\d\\d-\\d\\d)', 1), '')) AS published FROM h""")
def f22_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = F.concat(F.lit('<meta property="article:published_time" content="2026-09-'), F.lpad((F.col("page_id") % 28 + 1).cast("string"), 2, "0"), F.lit('T10:00">'), F.col("html"))
    p = table(spark, sf_dir, "pages").select("page_id", F.when(F.col("page_id") % 2 == 0, html).otherwise(F.col("html")).alias("html"))
    return p.select("page_id", S.published(F.col("html")).alias("published"))


@query(r"""SELECT item_id, regexp_replace(regexp_replace(text, '([\\`*_\[\]<>])', '\\\1', 'g'), '(?m)^(\s*)(#{1,6}\s|[-+]\s|\d+\.\s)', '\1\\\2', 'g') AS markdown, '"' || replace(replace(text, '\', '\\'), '"', '\"') || '"' AS yaml,
item_id || CASE WHEN item_id % 100 BETWEEN 11 AND 13 THEN 'th' WHEN item_id % 10 = 1 THEN 'st' WHEN item_id % 10 = 2 THEN 'nd' WHEN item_id % 10 = 3 THEN 'rd' ELSE 'th' END AS place
FROM (SELECT item_id, '# a [link] *bold*' || chr(10) || '- list "x" \ y' || chr(10) || text AS text FROM benchmark)""")
def f23_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = table(spark, sf_dir, "benchmark").withColumn("text", F.concat(F.lit('# a [link] *bold*\n- list "x" \\ y\n'), "text"))
    return b.select("item_id", S.escape_markdown(F.col("text")).alias("markdown"), S.yaml_scalar(F.col("text")).alias("yaml"), S.ordinal(F.col("item_id")).alias("place"))


@query("SELECT item_id, item_id || CASE WHEN item_id % 100 BETWEEN 11 AND 13 THEN 'th' WHEN item_id % 10 = 1 THEN 'st' WHEN item_id % 10 = 2 THEN 'nd' WHEN item_id % 10 = 3 THEN 'rd' ELSE 'th' END AS place FROM benchmark")
def f23_ordinals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select("item_id", S.ordinal(F.col("item_id")).alias("place"))


@query(r"""WITH h AS (SELECT doc_id, text, strpos(text, 'that') AS p FROM documents WHERE contains(text, 'that')),
w AS (SELECT doc_id, list_filter(string_split_regex(text[: p - 1], '\s+'), lambda x: x <> '') AS b, list_filter(string_split_regex(text[p + 4 :], '\s+'), lambda x: x <> '') AS a,
  CASE WHEN p > 1 AND regexp_matches(text[p - 1 : p - 1], '^\S$') THEN '' ELSE ' ' END AS l, CASE WHEN regexp_matches(text[p + 4 : p + 4], '^\S$') THEN '' ELSE ' ' END AS r FROM h)
SELECT doc_id, trim(array_to_string(b[greatest(len(b) - 19, 1) :], ' ') || l || 'that' || r || array_to_string(a[: 20], ' ')) AS text, len(b) > 20 AS cut_start, len(a) > 20 AS cut_end FROM w""")
def f24_excerpts(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.locate("that", F.col("text")) - 1
    return _docs(spark, sf_dir).where(F.col("text").contains("that")).select("doc_id", S.excerpt(F.col("text"), at, at + 4).alias("x")).select("doc_id", "x.*")


#: First evidence in SQL: the first sentence with a match, with those after it until there are eight words, without a page number at its end, cut to
#: 300 characters around the match in whole words.
def evidence_sql(pattern: str, of: str = "documents") -> str:
    return rf"""(WITH s AS (SELECT doc_id, string_split_regex(regexp_replace(text, '([.!?])\s+([A-Z"“])', '\1' || chr(1) || '\2', 'g'), chr(1)) AS s FROM {of}),
a AS (SELECT doc_id, s, list_position(list_transform(s, lambda x: regexp_matches(x, '{pattern}')), true) AS i FROM s), h AS (SELECT doc_id, s[i:] AS s FROM a WHERE i > 0),
k AS (SELECT doc_id, s, coalesce(list_min(list_filter(generate_series(1, len(s)), lambda j: list_sum(list_transform(s[:j], lambda x: len(regexp_extract_all(x, '\S+')))) >= 8)), len(s)) AS k FROM h),
w AS (SELECT doc_id, regexp_replace(trim(array_to_string(s[:k], ' ')), '\s+\d{{1,3}}\.?$', '') AS w FROM k),
p AS (SELECT doc_id, w, greatest(length(string_split_regex(w, '{pattern}')[1]), 0) AS hit, length(w) AS n FROM w),
c AS (SELECT doc_id, w, n, greatest(0, least(n, greatest(0, hit - 150) + 300) - 300) AS a, least(n, greatest(0, hit - 150) + 300) AS b FROM p),
e AS (SELECT doc_id, w, n, a - length(regexp_extract(w[:a], '\S*$')) AS a, b + length(regexp_extract(w[b + 1:], '^\S*')) AS b FROM c)
SELECT doc_id, trim(w[a + 1:b]) AS text, a > 0 AS cut_start, b < n AS cut_end FROM e)"""


@query(evidence_sql(r"(?i)\bthat\b")[1:-1])
def f25_first_mention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.first_evidence(_docs(spark, sf_dir), "doc_id", F.col("text"), r"(?iu)\bthat\b", S.SENTENCE)


_DENSE = rf"""WITH s AS (SELECT doc_id, unnest(s) AS sentence, generate_subscripts(s, 1) - 1 AS pos FROM (SELECT doc_id, list_transform({SENTENCES}, lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))) AS s FROM documents)),
h AS (SELECT *, len(regexp_extract_all(sentence, '(?i)tion|ing')) AS hits FROM s WHERE length(sentence) BETWEEN 60 AND 400 AND NOT regexp_matches(sentence, '(?i)rights reserved')),
b AS (SELECT * FROM h WHERE hits > 0 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY hits DESC, pos) = 1)"""


@query(_DENSE + r" SELECT doc_id, pos::INT AS pos, regexp_replace(sentence, '([\p{L}\p{N}_])[‐­] ([\p{L}\p{N}_])', '\1\2', 'g') AS sentence, hits::INT AS hits FROM b")
def f26_densest_sentence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.densest_sentence(_docs(spark, sf_dir), "doc_id", S.sentences(F.col("text")), r"(?iu)tion|ing", not_with="(?i)rights reserved")


@query(rf"""WITH s AS (SELECT doc_id, unnest(s) AS sentence, generate_subscripts(s, 1) - 1 AS pos FROM (SELECT doc_id, {SENTENCES} AS s FROM documents)),
h AS (SELECT *, len(list_intersect(list_distinct(regexp_extract_all(lower(sentence), '\p{{L}}+')), ['that', 'with', 'from', 'pour', 'avec', 'para', 'con', 'nicht', 'auf'])) AS hits FROM s WHERE length(sentence) BETWEEN 60 AND 320)
SELECT doc_id, pos::INT AS pos, sentence, hits::INT AS hits FROM h QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY hits DESC, pos) = 1""")
def f27_representative_sentence(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.array(*[F.lit(w) for w in ("that", "with", "from", "pour", "avec", "para", "con", "nicht", "auf")])
    return T.representative_sentence(_docs(spark, sf_dir), "doc_id", S.sentences(F.col("text")), words)


_FR = ", ".join(f"'{w}'" for w in S.FRENCH)
_EN = ", ".join(f"'{w}'" for w in S.ENGLISH)


@query(rf"""WITH w AS (SELECT doc_id, string_split_regex(lower(text), '[^\p{{L}}]+') AS w FROM documents)
SELECT doc_id, CASE WHEN len(list_filter(w, lambda x: x IN ({_FR}))) > len(list_filter(w, lambda x: x IN ({_EN}))) THEN 'fr' ELSE 'en' END AS language FROM w""")
def f28_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", S.french_or_english(F.col("text")).alias("language"))


_ONLINE = S.ONLINE.removeprefix("(?i)")


@query(f"SELECT page_id, regexp_matches(host, '(?i){_ONLINE}') AS address, regexp_matches(split_part(host, '.', 1), '(?i){_ONLINE}') OR page_id % 3 = 0 AS name FROM (SELECT page_id, regexp_extract(url, '://([^/?#]+)', 1) AS host FROM pages)")
def f30_brand_online(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", "://([^/?#]+)", 1).alias("host"))
    return p.select("page_id", S.is_online(F.col("host")).alias("address"), S.is_online(F.concat(F.element_at(F.split("host", r"\."), 1), F.when(F.col("page_id") % 3 == 0, " Online").otherwise(" Gazette"))).alias("name"))


@query("SELECT n_nationkey, CASE WHEN n_nationkey + 20 >= 31 THEN 'A/' || (n_nationkey + 20) || '/PV.' || n_nationkey ELSE 'A/PV.' || n_nationkey END AS symbol, n_nationkey + 20 + 1945 AS yr FROM nation")
def f31_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("n_nationkey") + 20
    return table(spark, sf_dir, "nation").select("n_nationkey", S.meeting_symbol(s, F.col("n_nationkey")).alias("symbol"), S.session_year(s).alias("yr"))


@query("SELECT s_suppkey, s_nationkey + 1945 AS yr FROM supplier")
def m1_session_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select("s_suppkey", S.session_year(F.col("s_nationkey")).alias("yr"))


@query(r"""SELECT DISTINCT p_type, p_brand, replace(replace(replace(p_type, 'O', 'o'), 'E', 'e'), ' ', '') || ' defence treaty' AS readable FROM part""")
def f29_readable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patterns made of a part's type: word ends, a class for every O and E, an alternation of two endings."""
    t = F.regexp_replace(F.regexp_replace(F.replace("p_type", F.lit(" "), F.lit("")), "O", "[oO]"), "E", "[eE]")
    pattern = F.concat(F.lit(r"\b"), t, F.lit(r" defen[cs]e\b treat(y|ies)"))
    return table(spark, sf_dir, "part").select("p_type", "p_brand", S.readable_pattern(pattern).alias("readable")).distinct()


@query("SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM events")
def m2_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("Held on Monday, 31 February 2020 and "), F.date_format(F.col("ts"), "EEEE, d MMMM yyyy"))
    return table(spark, sf_dir, "events").select("event_id", S.meeting_date(text).cast("string").alias("day"))


@query("SELECT event_id FROM events WHERE ts::DATE BETWEEN DATE '2024-01-05' AND DATE '2024-01-09' OR event_type = 'signup'")
def m3_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.where(F.col("ts").cast("date").between(F.lit("2024-01-05").cast("date"), F.lit("2024-01-09").cast("date")) | (F.col("event_type") == "signup")).select("event_id")


@query("SELECT doc_id, sha256(text) AS sha256, md5(text) AS md5 FROM documents")
def m4_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", F.sha2("text", 256).alias("sha256"), F.md5("text").alias("md5"))


@query(rf"""WITH b AS (SELECT item_id, list_distinct(list_transform(generate_series(1, greatest(len(w) - 4, 0)), lambda i: array_to_string(w[i : i + 4], ' '))) AS x FROM (SELECT item_id, {_PLAIN} AS w FROM benchmark)),
d AS (SELECT doc_id, list_distinct(list_transform(generate_series(1, greatest(len(w) - 4, 0)), lambda i: array_to_string(w[i : i + 4], ' '))) AS y FROM (SELECT doc_id, {_PLAIN} AS w FROM documents))
SELECT doc_id, CASE WHEN len(x) > 0 AND len(y) > 0 THEN round(len(list_intersect(x, y)) / least(len(x), len(y)), 3) END AS agreement FROM d JOIN b ON doc_id = item_id""")
def t11_shingle_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _docs(spark, sf_dir).select("doc_id", F.col("text").alias("y"))
    b = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"), F.col("text").alias("x"))
    return d.join(b, "doc_id").select("doc_id", T.shingle_agreement(F.col("x"), F.col("y")).alias("agreement"))


@query(r"""WITH w AS (SELECT conv_id, role = 'assistant' AS a, unnest(regexp_extract_all(lower(text), '\p{L}+')) AS w FROM conversations), s AS (SELECT conv_id, coalesce(list(DISTINCT w) FILTER (a), []) AS x, coalesce(list(DISTINCT w) FILTER (NOT a), []) AS y FROM w GROUP BY 1)
SELECT conv_id, len(list_intersect(x, y)) AS both, len(x) - len(list_intersect(x, y)) AS only_x, len(list_distinct(x || y)) AS either, CASE WHEN len(x) > 0 AND len(y) > 0 THEN round(len(list_intersect(x, y)) / least(len(x), len(y)), 3) END AS containment FROM s""")
def m10_set_algebra(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the answers and of the other turns of a conversation as sets."""
    w = table(spark, sf_dir, "conversations").select("conv_id", (F.col("role") == "assistant").alias("a"), F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))).alias("w"))
    s = w.groupBy("conv_id").agg(F.collect_set(F.when(F.col("a"), F.col("w"))).alias("x"), F.collect_set(F.when(~F.col("a"), F.col("w"))).alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    share = F.when((F.size("x") > 0) & (F.size("y") > 0), F.round(both / F.least(F.size("x"), F.size("y")), 3))
    return s.select("conv_id", both.cast("long").alias("both"), F.size(F.array_except("x", "y")).cast("long").alias("only_x"), F.size(F.array_union("x", "y")).cast("long").alias("either"), share.alias("containment"))


@query("SELECT doc_id, list_reduce(list_transform(string_split(text, chr(10)), lambda l: [trim(l)]), lambda a, b: CASE WHEN list_contains(a, b[1]) THEN a ELSE a || b END) AS l FROM documents".replace("SELECT doc_id, ", "SELECT doc_id, len(l)::INT AS n, sha256(array_to_string(l, chr(10))) AS digest FROM (SELECT doc_id, ", 1) + ")")
def x5_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of a text, each where it is first seen."""
    d = _docs(spark, sf_dir).select("doc_id", F.array_distinct(F.transform(F.split("text", "\n", -1), lambda x: F.btrim(x))).alias("l"))
    return d.select("doc_id", F.size("l").alias("n"), F.sha2(F.array_join("l", "\n"), 256).alias("digest"))


@query(r"""SELECT event_id, regexp_extract(props, '"k"\s*:\s*(-?[0-9]+)', 1)::BIGINT AS k FROM events""")
def m11_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("SELECT lang, (round(avg((n_chars > 2000)::INT) * 100)::BIGINT)::VARCHAR || '%' AS long FROM documents GROUP BY 1")
def m14_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).groupBy("lang").agg(S.percent(F.avg((F.col("n_chars") > 2000).cast("double"))).alias("long"))


_TF = f"""t AS (SELECT doc_id, unnest({TOK}) AS token FROM documents), tf AS (SELECT doc_id, token, count(*) AS tf FROM t GROUP BY ALL), n AS (SELECT count(*) AS n FROM documents), df AS (SELECT token, count(*) AS df FROM tf GROUP BY 1),
w AS (SELECT doc_id, token, (1 + ln(tf)) * (ln((1 + n) / (1 + df)) + 1) AS w FROM tf JOIN df USING (token), n WHERE df >= 2 AND df <= 0.5 * n), x AS (SELECT doc_id, token, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM w)"""


@query(f"WITH {_TF} SELECT doc_id, token, round(weight, 6) AS weight, place::INT AS place FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(weight, 9) DESC, token DESC) AS place FROM x) WHERE place <= 3")
def t1_tfidf_top_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = T.tfidf(_docs(spark, sf_dir), "doc_id", S.raw_tokens(F.col("text")), keep=_kept)
    o = Window.partitionBy("doc_id").orderBy(F.desc(F.round("weight", 9)), F.desc("token"))
    return w.withColumn("place", F.row_number().over(o)).where("place <= 3").select("doc_id", "token", F.round("weight", 6).alias("weight"), "place")


@query(f"WITH {_TF}, p AS (SELECT doc_id, token, row_number() OVER (PARTITION BY doc_id ORDER BY round(weight, 9) DESC, token DESC) AS place FROM x WHERE weight > 0) SELECT doc_id, string_agg(token, ',' ORDER BY place) AS words FROM p WHERE place <= 8 GROUP BY 1")
def t7_top_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.top_tokens(_weights(spark, sf_dir), "doc_id", 8).select("doc_id", F.array_join("words", ",").alias("words"))


def _weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(T.tfidf(_docs(spark, sf_dir), "doc_id", S.raw_tokens(F.col("text")), keep=_kept))


@query(f"""WITH {_TF}, s AS (SELECT a.doc_id AS a, b.doc_id AS b, sum(a.weight * b.weight) AS s FROM x a JOIN x b ON a.token = b.token AND a.doc_id <> b.doc_id GROUP BY ALL HAVING sum(a.weight * b.weight) >= 0.3)
SELECT a AS doc_id, b AS other, round(s, 6) AS similarity, place::INT AS place FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY round(s, 9) DESC, b DESC) AS place FROM s) WHERE place <= 3""")
def t7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.nearest(_weights(spark, sf_dir), "doc_id", 0.3).select("doc_id", "other", F.round("similarity", 6).alias("similarity"), "place")


@query(f"""WITH {_TF}, a AS (SELECT token, sum(weight) AS a FROM x GROUP BY 1), m AS (SELECT doc_id, round(coalesce(sum(weight * a) - sum(weight * weight), 0) / (SELECT count(*) - 1 FROM documents), 6) AS s FROM documents LEFT JOIN (x JOIN a USING (token)) USING (doc_id) GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, round(sum(a.weight * b.weight), 6) AS s FROM x a JOIN x b ON a.token = b.token AND a.doc_id < b.doc_id GROUP BY ALL HAVING sum(a.weight * b.weight) >= 0.6),
u AS (SELECT 'most_distinctive' AS kind, row_number() OVER (ORDER BY s, doc_id) AS place, doc_id AS a, NULL AS b, s FROM m UNION ALL SELECT 'most_typical', row_number() OVER (ORDER BY s DESC, doc_id DESC), doc_id, NULL, s FROM m UNION ALL SELECT 'similar_pairs', row_number() OVER (ORDER BY s DESC, a DESC, b DESC), a, b, s FROM p)
SELECT kind, place::INT AS place, a, b, s AS similarity FROM u WHERE place <= 5""")
def t18_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.extremes(_weights(spark, sf_dir), _docs(spark, sf_dir), "doc_id")


@query(f"WITH {_TF} SELECT a.doc_id AS a, b.doc_id AS b, round(sum(a.weight * b.weight), 6) AS similarity FROM x a JOIN x b ON a.token = b.token AND a.doc_id < b.doc_id GROUP BY ALL HAVING sum(a.weight * b.weight) >= 0.6")
def t3_cosine_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.cosine_pairs(_weights(spark, sf_dir), "doc_id", 0.6).select("a", "b", F.round("similarity", 6).alias("similarity"))


@query("WITH l AS (SELECT DISTINCT l_orderkey, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey) SELECT x.p_brand AS a, y.p_brand AS b, count(*) AS n FROM l x JOIN l y ON x.l_orderkey = y.l_orderkey AND x.p_brand < y.p_brand GROUP BY ALL")
def j14_unordered_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of brands in one order, each pair once."""
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey").join(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "p_brand").distinct()
    other = l.withColumnRenamed("p_brand", "b")
    return l.join(other, "l_orderkey").where("p_brand < b").groupBy(F.col("p_brand").alias("a"), "b").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH t AS (SELECT lang, unnest({TOK}) AS token FROM documents), c AS (SELECT lang, token, count(*) AS y FROM t GROUP BY ALL), g AS (SELECT lang, sum(y) AS ng FROM c GROUP BY 1), p AS (SELECT token, sum(y) AS p FROM c GROUP BY 1), j AS (SELECT lang, token, y, p, ng, (SELECT sum(y) FROM c) AS tp FROM c JOIN p USING (token) JOIN g USING (lang) WHERE p >= 10 AND y >= 5),
z AS (SELECT lang, token, y::BIGINT AS n, (ln((y + p) / (ng + tp - (y + p))) - ln((2 * p - y) / (tp - ng + tp - (2 * p - y)))) / sqrt(1 / (y + p) + 1 / (2 * p - y)) AS z FROM j)
SELECT lang, token, n, round(z, 6) AS z, place::INT AS place FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY z DESC, token DESC) AS place FROM z) WHERE place <= 10""")
def t8_log_odds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.log_odds(_docs(spark, sf_dir), "lang", S.raw_tokens(F.col("text")), keep=_kept).withColumn("z", F.round("z", 6))


_NAMES = {"thing": "THI", "the thing": "TTH", "that": "THA", "from": "FRO", "nation": "", "der": "DER"}


@query(r"""WITH m AS (SELECT doc_id, unnest(regexp_extract_all(' ' || regexp_replace(lower(text), '([^\p{L}\p{N}_-])', '\1\1', 'g') || ' ', '[^\p{L}\p{N}_-](that|from|der)[^\p{L}\p{N}_-]', 1)) AS m FROM documents)
SELECT doc_id, CASE m WHEN 'that' THEN 'THA' WHEN 'from' THEN 'FRO' ELSE 'DER' END AS code, count(*) AS n FROM m GROUP BY ALL""")
def t14_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.mentions(_docs(spark, sf_dir), "doc_id", F.col("text"), {"that": "THA", "from": "FRO", "der": "DER"})


@query(r"""WITH m AS (SELECT doc_id, unnest(regexp_extract_all(' ' || regexp_replace(lower(text), '([^\p{L}\p{N}_-])', '\1\1', 'g') || ' ', '[^\p{L}\p{N}_-](that|from|der)[^\p{L}\p{N}_-]', 1)) AS m FROM documents)
SELECT m AS code, count(DISTINCT doc_id) AS named_by, count(*) AS times FROM m GROUP BY 1""")
def a10_naming_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = E.mentions(_docs(spark, sf_dir), "doc_id", F.col("text"), {"that": "that", "from": "from", "der": "der"})
    return E.naming_totals(m.select(F.col("doc_id").alias("from_code"), F.col("code").alias("to_code"), F.col("n").alias("times")))


_PEOPLE = (("THA", "Than"), ("THA", "The"), ("FRO", "Ther"), ("DER", "Und"), ("DER", "Dieses"))


def _word(w: str, case: str = "") -> str:
    return rf"{case}(?:^|[^\p{{L}}\p{{N}}_-]){w}(?:$|[^\p{{L}}\p{{N}}_-])"


@query(f"""WITH p AS (SELECT doc_id AS article, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS p FROM documents), n AS (SELECT * FROM (VALUES ('that', 'THA'), ('from', 'FRO'), ('der', 'DER')) v(name, code)),
c AS (SELECT article, p, code FROM p, n WHERE CASE code WHEN 'THA' THEN regexp_matches(text, '{_word("that", "(?i)")}') WHEN 'FRO' THEN regexp_matches(text, '{_word("from", "(?i)")}') ELSE regexp_matches(text, '{_word("der", "(?i)")}') END),
s AS (SELECT DISTINCT article, p, code FROM (SELECT article, p, unnest(['THA', 'FRO']) AS code, [regexp_matches(text, '{_word("Than")}'), regexp_matches(text, '{_word("Ther")}')] AS hit, unnest([1, 2]) AS k FROM p) WHERE hit[k] UNION SELECT article, p, 'DER' FROM p WHERE regexp_matches(text, '{_word("Dieses")}')),
w AS (SELECT s.* FROM s SEMI JOIN c ON c.article = s.article AND c.code = s.code) SELECT article, p::INT AS p, code, 'country' AS how FROM c UNION ALL SELECT article, p::INT, code, 'person' FROM w ANTI JOIN c ON c.article = w.article AND c.p = w.p AND c.code = w.code""")
def j13_paragraph_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs (lines) that name a code's country, or a person of it in a document that names the country; surnames of under four letters do not count."""
    p = _docs(spark, sf_dir).select(F.col("doc_id").alias("article"), F.posexplode(F.split("text", "\n", -1)).alias("p", "text"))
    return E.paragraph_matches(p, {"that": "THA", "from": "FRO", "der": "DER"}, spark.createDataFrame(_PEOPLE, "code string, surname string"))


@query(r"""SELECT doc_id, length(text) >= 300 AS long_enough, round(len(regexp_extract_all(text, '[\p{L}\p{M}]')) / nullif(len(regexp_extract_all(text, '\S')), 0), 6) AS letters FROM documents""")
def p7_fitness(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    return _docs(spark, sf_dir).select("doc_id", (F.length(t) >= 300).alias("long_enough"), F.round(S.letter_share(t), 6).alias("letters"))


@query(r"""WITH x AS (SELECT doc_id, text, regexp_extract_all(text, '[\p{L}\p{M}]+') AS w FROM documents), f AS (SELECT doc_id, text, list_filter(w, lambda x: regexp_matches(x, '[^\P{L}\p{Latin}]')) AS f FROM x),
m AS (SELECT doc_id, text, CASE WHEN len(f) < 50 THEN 0 ELSE len(list_filter(f, lambda x: regexp_matches(x, '\p{Latin}'))) / len(f) END AS mixed, (len(regexp_extract_all(text, '(?:^|[^\p{L}\p{M}])\p{M}'))) / nullif(length(text), 0) AS misordered,
  len(regexp_extract_all(text, '[\p{L}\p{M}]')) / nullif(len(regexp_extract_all(text, '\S')), 0) AS letters FROM f)
SELECT doc_id, length(text) >= 300 AND letters >= 0.6 AND misordered <= 0.01 AND mixed <= 0.01 AS usable, round(mixed, 6) AS mixed, round(misordered, 6) AS misordered FROM m""")
def p7_usable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", S.usable_layer(F.col("text")).alias("usable"), F.round(S.mixed_script_share(F.col("text")), 6).alias("mixed"), F.round(S.misordered_mark_share(F.col("text")), 6).alias("misordered"))


@query("SELECT doc_id FROM documents WHERE lang IN ('en', 'fr') AND text IS NOT NULL AND n_chars >= 300")
def p2_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).where(F.col("lang").isin("en", "fr") & F.col("text").isNotNull() & (F.col("n_chars") >= 300)).select("doc_id")


@query(r"SELECT doc_id FROM documents WHERE len(regexp_extract_all(text, '\S+')) >= 300")
def p3_long_enough(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).where(S.word_count(F.col("text")) >= 300).select("doc_id")


@query(r"SELECT conv_id, turn FROM conversations WHERE len(regexp_extract_all(text, '\S+')) >= 50")
def p9_turn_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").where(S.word_count(F.col("text")) >= 50).select("conv_id", "turn")


@query("SELECT page_id FROM pages WHERE NOT starts_with(url, 'http://www.')")
def p10_outside(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").where(~F.col("url").startswith("http://www.")).select("page_id")


@query("SELECT l_suppkey FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1 HAVING avg((p_size > 25)::INT) >= 0.5")
def p11_having_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part").select("p_partkey", "p_size"), F.col("l_partkey") == F.col("p_partkey"))
    return l.groupBy("l_suppkey").agg(F.avg((F.col("p_size") > 25).cast("double")).alias("s")).where("s >= 0.5").select("l_suppkey")


_SHINGLES = "list_distinct(list_transform(generate_series(1, greatest(len({0}) - 4, 0)), lambda i: array_to_string({0}[i : i + 4], ' ')))"


@query(rf"""WITH d AS (SELECT doc_id, {_PLAIN} AS w FROM documents), c AS (SELECT item_id AS doc_id, CASE WHEN item_id % 4 = 0 THEN d.text ELSE b.text END AS text FROM benchmark b LEFT JOIN documents d ON d.doc_id = b.item_id WHERE item_id % 5 <> 0), e AS (SELECT doc_id, {_PLAIN} AS v FROM c),
s AS (SELECT d.doc_id, e.doc_id IS NOT NULL AS has, {_SHINGLES.format('w')} AS x, {_SHINGLES.format('v')} AS y FROM d LEFT JOIN e USING (doc_id))
SELECT doc_id, has AS in_corpus FROM s WHERE NOT has OR (len(x) > 0 AND len(y) > 0 AND round(len(list_intersect(x, y)) / least(len(x), len(y)), 3) >= 0.5)""")
def p8_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scans (documents) that are kept: no text in the corpus, or agreement with it. Here the corpus has items, some of which are the scan's own text."""
    d = _docs(spark, sf_dir).select("doc_id", "text")
    own = d.select(F.col("doc_id").alias("item_id"), F.col("text").alias("own"))
    i = F.col("item_id")
    corpus = table(spark, sf_dir, "benchmark").where(i % 5 != 0).join(own, "item_id", "left").select(i.alias("doc_id"), F.when(i % 4 == 0, F.col("own")).otherwise(F.col("text")).alias("corpus_text"))
    j = d.join(corpus, "doc_id", "left").withColumn("agreement", T.shingle_agreement(F.col("text"), F.col("corpus_text")))
    return j.where(fusion.kept_scan(F.col("text"), F.col("corpus_text"), F.col("agreement"))).select("doc_id", F.col("corpus_text").isNotNull().alias("in_corpus"))


@query("SELECT q.doc_id FROM documents q JOIN documents d ON d.doc_id = q.doc_id + 1 WHERE NOT contains(d.text, q.text)")
def j15_quote_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's whole text as a quote from the next document."""
    from ..operators.checks import missing_quotes

    q = _docs(spark, sf_dir).select("doc_id", F.col("text").alias("quote"), (F.col("doc_id") + 1).alias("source_id"))
    s = _docs(spark, sf_dir).select(F.col("doc_id").alias("source_id"), F.col("text").alias("source_text"))
    return missing_quotes(q, s, "source_id", "quote", "source_text").select("doc_id")


@query(_DENSE + """, q AS (SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN 'They said: ' || sentence ELSE sentence END AS quote FROM b) SELECT q.doc_id FROM q JOIN documents d USING (doc_id) WHERE NOT contains(trim(regexp_replace(d.text, '\\s+', ' ', 'g')), quote)""")
def v1_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes that are no part of their text: each document's densest sentence, of which every tenth was given a beginning that it does not have."""
    from ..operators.checks import missing_quotes

    b = T.densest_sentence(_docs(spark, sf_dir), "doc_id", S.sentences(F.col("text")), r"(?iu)tion|ing", not_with="(?i)rights reserved")
    q = b.select("doc_id", F.concat(F.when(F.col("doc_id") % 10 == 0, "They said: ").otherwise(""), "sentence").alias("quote"))
    return missing_quotes(q, _docs(spark, sf_dir).select("doc_id", S.collapse(F.col("text")).alias("source")), "doc_id", "quote", "source").select("doc_id")


@query(r"""SELECT doc_id FROM documents WHERE regexp_matches(text, '(?i)\bthat\b') AND doc_id % 7 = 0""")
def v2_excerpts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence that is in no text of its source: every document's first mention, cut by the operator, is found; those of every seventh document were altered."""
    from ..operators.checks import excerpts_missing

    e = T.first_evidence(_docs(spark, sf_dir), "doc_id", F.col("text"), r"(?iu)\bthat\b", S.SENTENCE)
    e = e.select("doc_id", F.concat("text", F.when(F.col("doc_id") % 7 == 0, " (altered)").otherwise("")).alias("excerpt"))
    return excerpts_missing(e, _docs(spark, sf_dir), "doc_id", "excerpt", "text").select("doc_id")
