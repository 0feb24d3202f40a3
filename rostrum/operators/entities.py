"""Names to codes: dictionaries, suffix and containment joins, mentions, naming networks."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.strings import normalise_name


def name_table(names: DataFrame, aliases: DataFrame, name: str = "name", code: str = "code") -> DataFrame:
    """name (normalised) and code: aliases and registered names, "X (Y of)" also as "Y of X" and "X"; registered names win."""
    n = names.where(F.coalesce(F.col(code), F.lit("")) != "")
    inner = F.regexp_extract(name, r"^(.+?) \((.+?) of\)$", 1)
    outer = F.regexp_extract(name, r"^(.+?) \((.+?) of\)$", 2)
    forms = F.when(inner != "", F.array(F.col(name), F.concat(outer, F.lit(" of "), inner), inner)).otherwise(F.array(F.col(name)))
    own = n.select(F.explode(forms).alias("name"), F.col(code).alias("code"), F.lit(2).alias("_rank"))
    other = aliases.select(F.col(name).alias("name"), F.col(code).alias("code"), F.lit(1).alias("_rank"))
    all_ = own.unionByName(other).select(normalise_name(F.col("name")).alias("name"), "code", "_rank").where("name <> ''")
    return all_.groupBy("name").agg(F.max_by("code", F.struct("_rank", "code")).alias("code"))


def _longest(texts: DataFrame, key: str, candidates: DataFrame) -> DataFrame:
    best = candidates.groupBy(key).agg(F.max_by(F.struct("name", "code"), F.struct(F.length("name"), "name")).alias("b"))
    return texts.join(best, key, "left").select(*texts.columns, F.col("b.name").alias("name"), F.col("b.code").alias("code"))


def resolve_suffix(texts: DataFrame, key: str, text: str, names: DataFrame, *, normalise: bool = True) -> DataFrame:
    """texts with the longest name that ends each text at a word's start, and its code.

    Every suffix that begins at a word is a key, so the join is an equality and not a comparison of all texts with all names.
    """
    t = normalise_name(F.col(text)) if normalise else F.col(text)
    words = F.split(t, " ")
    tails = F.transform(F.sequence(F.lit(1), F.size(words)), lambda i: F.array_join(F.slice(words, i, F.size(words)), " "))
    c = texts.select(key, F.explode(F.array_distinct(tails)).alias("name")).join(names, "name")
    return _longest(texts, key, c)


def find_within(texts: DataFrame, key: str, text: str, names: DataFrame, *, longest: int = 8, normalise: bool = True) -> DataFrame:
    """texts with the longest name anywhere in each text, between word ends; names have at most so many words."""
    t = normalise_name(F.col(text)) if normalise else F.col(text)
    words = F.split(t, " ")
    runs = F.flatten(F.transform(F.sequence(F.lit(1), F.size(words)), lambda i: F.transform(F.sequence(F.lit(1), F.least(F.lit(longest), F.size(words) - i + 1)), lambda n: F.array_join(F.slice(words, i, n), " "))))
    c = texts.select(key, F.explode(F.array_distinct(runs)).alias("name")).join(names, "name")
    return _longest(texts, key, c)


def alternation(names: Sequence[str]) -> str:
    """One pattern for all names, longest first, not inside a word or beside a hyphen; blanks match any white space, apostrophes either form."""
    def one(n: str) -> str:
        return re.sub(r"\\? ", r"\\s+", re.escape(n)).replace("'", "['’]")

    return r"(?iu)(?<![\p{L}\p{N}_-])(?:" + "|".join(one(n) for n in sorted(names, key=lambda n: (-len(n), n))) + r")(?![\p{L}\p{N}_-])"


def mentions(df: DataFrame, key: str, text: Column, names: Mapping[str, str]) -> DataFrame:
    """key, code, n: how often each text names each code. A name with an empty code is matched, so that what is inside it is not counted, and counts for nothing."""
    found = F.regexp_extract_all(text, F.lit(alternation(list(names))), F.lit(0))
    m = df.select(key, F.explode(found).alias("m")).select(key, F.regexp_replace(F.replace(F.lower("m"), F.lit("’"), F.lit("'")), r"\s+", " ").alias("name"))
    table = F.create_map(*[F.lit(x) for n, c in names.items() if c for x in (n.lower(), c)])
    return m.select(key, F.try_element_at(table, F.col("name")).alias("code")).where("code IS NOT NULL").groupBy(key, "code").agg(F.count(F.lit(1)).alias("n"))


#: Letters of a surname that counts on its own.
SURNAME = 4


def paragraph_matches(paragraphs: DataFrame, names: Mapping[str, str], people: DataFrame, *, least: int = SURNAME) -> DataFrame:
    """article, p, code, how: paragraphs (article, p, text) that name a code's country, or a person (code, surname) of it in an article that names the country.

    Each paragraph's words are looked up once: countries by one pattern, surnames as keys of an equality join with the words between other
    characters than letters, digits and hyphens. A paragraph that names the country counts as that, whoever else it names.
    """
    named = mentions(paragraphs.select(F.struct("article", "p").alias("_key"), "text"), "_key", F.col("text"), names)
    by_country = named.select("_key.article", "_key.p", "code").distinct()
    words = F.array_distinct(F.regexp_extract_all("text", F.lit(r"[\p{L}\p{N}_-]+"), F.lit(0)))
    long = people.where(F.length("surname") >= least).select("code", F.col("surname").alias("word")).distinct()
    by_person = paragraphs.select("article", "p", F.explode(words).alias("word")).join(long, "word").select("article", "p", "code").distinct()
    in_article = by_person.join(by_country.select("article", "code").distinct(), ["article", "code"], "left_semi")
    rest = in_article.join(by_country, ["article", "p", "code"], "left_anti")
    return by_country.withColumn("how", F.lit("country")).unionByName(rest.withColumn("how", F.lit("person")))


def naming_edges(counts: DataFrame, speakers: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """from_code, to_code, times of mentions (code, target, n) by speakers (code) of other speakers or of extra codes."""
    ok = speakers.select(F.col("code").alias("target")).distinct()
    c = counts.where(F.col("code") != F.col("target"))
    kept = c.join(ok, "target", "left_semi")
    if extra:
        kept = kept.unionByName(c.where(F.col("target").isin(*extra)).join(ok, "target", "left_anti").select(kept.columns))
    return kept.select(F.col("code").alias("from_code"), F.col("target").alias("to_code"), F.col("n").alias("times"))


def naming_totals(edges: DataFrame) -> DataFrame:
    """code, named_by (distinct namers), times."""
    return edges.groupBy(F.col("to_code").alias("code")).agg(F.count_distinct("from_code").alias("named_by"), F.sum("times").cast("long").alias("times"))
