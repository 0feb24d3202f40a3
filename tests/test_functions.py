"""Scalar functions, rules and lexicons on small cases."""

import pytest
from pyspark.sql import functions as F

from rostrum.functions import lexicon, numbers, rules
from rostrum.functions import strings as S

c = F.col("x")


def one(spark, column, *values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}").select("i", column.alias("y")).orderBy("i").collect()
    return [r.y for r in rows]


def test_names(spark):
    assert one(spark, S.normalise_name(c), "Côte d’Ivoire", "  São  Tomé (and) Príncipe ", None, "") == ["cote d'ivoire", "sao tome and principe", None, ""]
    assert one(spark, S.slugify(c), "Trinidad & Tobago", "--A b--") == ["trinidad-and-tobago", "a-b"]
    assert one(spark, S.site(c), "www.news.bbc.co.uk", "a.b.example.org", "localhost") == ["bbc.co.uk", "example.org", "localhost"]
    assert one(spark, S.strip_honorific(c, r"(?:H\.E\.|Mr\.?)\s+"), "H.E. Ana Diaz (Chile):", "Ana") == ["Ana Diaz", "Ana"]


def test_sentences(spark):
    assert one(spark, S.sentences(c), "One. Two? \"Three\" four. five") == [["One.", "Two?", '"Three" four. five']]
    assert one(spark, S.sentences(c, S.SENTENCE_TITLES), "We met Mr. Smith. H.E. Jones spoke. • Item") == [["We met Mr. Smith.", "H.E. Jones spoke.", "Item"]]
    assert one(spark, S.chunks(S.sentences(c), 2), "A b. C d. E f.") == [["A b. C d.", "E f."]]


def test_tokens(spark):
    assert one(spark, S.word_tokens(c, ("the",)), "The well-known Éclair isn't at https://x.y/z of THE end's place", None) == [["well-known", "éclair", "place"], None]
    assert one(spark, S.word_count(c), "a  b\nc", "", None) == [3, 0, 0]
    assert one(spark, S.is_menu(c), "News Sport Weather Travel", "A story about one thing.", "the small words here") == [True, False, False]


def test_text_formats(spark):
    assert one(spark, S.ordinal(c), 1, 2, 3, 4, 11, 12, 13, 21, 112, kind="int") == ["1st", "2nd", "3rd", "4th", "11th", "12th", "13th", "21st", "112th"]
    assert one(spark, S.yaml_scalar(c), 'a "b" \\', None) == ['"a \\"b\\" \\\\"', "null"]
    assert one(spark, S.escape_markdown(c), "*a* [b]\n# c\n1. d") == ["\\*a\\* \\[b\\]\n\\# c\n\\1. d"]
    assert one(spark, S.percent(c), 0.126, kind="double") == ["13%"]
    assert one(spark, S.straight_quotes(c), "“a” ‘b’") == ["\"a\" 'b'"]


def test_dates(spark):
    got = one(spark, S.meeting_date(c).cast("string"), "Held on Monday, 31 February 1990, then Tuesday 2 October 1990 at 10", "no date")
    assert got == ["1990-10-02", None]
    pages = ['<meta content="2026-09-22T10" property="article:published_time">', '<script>"datePublished": "2026-09-21T"</script>', '<time datetime="2026-09-20">', "<p>2026-01-01</p>", None]
    assert one(spark, S.published(c), *pages) == ["2026-09-22", "2026-09-21", "2026-09-20", None, None]
    assert one(spark, S.meeting_symbol(c, F.lit(7)), 30, 31, kind="int") == ["A/PV.7", "A/31/PV.7"]


def test_excerpt_keeps_whole_words(spark):
    text = " ".join(f"w{i}" for i in range(100))
    at = text.index("w50")
    r = one(spark, S.excerpt(c, F.lit(at), F.lit(at + 3), 10), text)[0]
    assert r.text == " ".join(f"w{i}" for i in range(45, 56)) and r.cut_start and r.cut_end


def test_text_quality(spark):
    assert one(spark, S.french_or_english(c), "le chat et la souris", "the cat and le chat") == ["fr", "en"]
    assert one(spark, F.round(S.letter_share(c), 2), "ab 12", "") == [0.5, None]
    assert one(spark, S.refine_cyrillic(c, F.lit("ru")), "ӣқҷ" * 11, "да" * 30) == ["tg", "ru"]


ROLES = [
    ("President of the Republic", "head_of_state"), ("Prime Minister and Minister for Foreign Affairs", "head_of_government"), ("Vice-President", "deputy_head"), ("Minister of State for Trade", "junior_minister"), ("Minister of State and for Foreign Affairs", "foreign_minister"),
    ("Deputy Prime Minister", "deputy_head"), ("Minister for Foreign Affairs", "foreign_minister"), ("Minister of Health", "other_minister"), ("Permanent Representative", "diplomat"), ("Secretary-General", "un_official"),
    ("Vice-Minister for Foreign Affairs", "junior_minister"), ("President of the European Council", "regional_organisation"), ("Amir", "head_of_state"), ("Chargé d'affaires", "diplomat"), ("", "unclassified"), (None, "unclassified"), ("Poet", "unclassified"),
]


@pytest.mark.parametrize(("title", "role"), ROLES)
def test_roles(spark, title, role):
    assert one(spark, rules.role(c), title) == [role]


def test_role_of_a_delegation_and_its_group(spark):
    r = spark.createDataFrame([("Secretary of State", "holy-see"), ("Secretary of State", "x")], "t string, s string")
    assert [x.y for x in r.select(rules.role(F.col("t"), F.col("s")).alias("y")).collect()][0] == "head_of_government"
    assert one(spark, rules.role_group(c), "head_of_state", "diplomat") == ["head_of_state_or_government", "diplomat"]


def test_lexicons(spark):
    p = lexicon.patterns(lexicon.ISSUES, lexicon.CASE_SENSITIVE)
    got = one(spark, lexicon.flags(c, p), "The war in South Sudan and debt", "Sudan uses AI", "Ai is a name. UKRAINE", "")
    assert got == [["Debt"], ["Sudan", "Artificial intelligence"], ["Ukraine"], []]
    f = lexicon.patterns(lexicon.FRAMES)
    assert one(spark, lexicon.rates(c, f)["Realism"], "power and security", "", "wars") == [666.67, 0.0, 1000.0]
    assert one(spark, lexicon.first_family(c, {"b": "two", "a": "two|one"}), "x one two", "two", "zilch") == ["a", "a", None]


def test_numbers(spark):
    d = spark.createDataFrame([(1, 2.0), (2, 4.0), (3, 6.0)], "i int, v double")
    z = {r.i: round(r.z_v, 6) for r in numbers.z_scores(d, ["v"]).collect()}
    assert z == {1: -1.224745, 2: 0.0, 3: 1.224745}
    assert all(r.z_v == 0 for r in numbers.z_scores(d.withColumn("v", F.lit(3.0)), ["v"]).collect())
    h = numbers.histogram(spark.createDataFrame([(1.0,), (9.0,), (None,)], "v double"), "v", 2).orderBy("bin").collect()
    assert [(r.bin, r.n) for r in h] == [(0, 1), (2, 0), (4, 0), (6, 0), (8, 1)]
    assert numbers.histogram(d.where("false"), "v", 2).count() == 0
    assert one(spark, numbers.bucket(c, [1, 5]), 0, 1, 5, 9, kind="int") == [0, 1, 2, 2]
