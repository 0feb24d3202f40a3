"""Sequence comparison of candidate pairs, in Arrow-backed functions: what was filed and what was said, and shared passages."""

from __future__ import annotations

import hashlib
import re
import unicodedata
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship
from ..sources.tables import stored
from .textmining import let, ngrams

# Marks and letter forms that Arabic files differ in, and the scripts that are compared by characters.
MARKS = re.compile("[\u0610-\u061a\u064b-\u065f\u0670\u06d6-\u06ed\u0640]")
FORMS = str.maketrans({"أ": "ا", "إ": "ا", "آ": "ا", "ٱ": "ا", "ى": "ي", "ی": "ي", "ة": "ه", "ک": "ك"})
IDEOGRAPHS = re.compile(r"[぀-ヿ㐀-鿿]")
NOTICE = r"(?ms)\A.*?^‏?\[.*?\][^\S\n]*$"


def tokens(text: str, language: str | None) -> list[str]:
    """Words to compare; characters for Arabic (letters folded), Chinese and Japanese."""
    t = unicodedata.normalize("NFKC", text or "").lower()
    if language == "ar":
        return [c for c in MARKS.sub("", t).translate(FORMS) if c.isalnum()]
    if language in ("zh", "ja"):
        return [c for c in t if c.isalnum() or IDEOGRAPHS.match(c)]
    return re.findall(r"\w+", t)


def transcript_body(text: Column) -> Column:
    """What follows a transcript's first line in brackets, or the whole."""
    return F.regexp_replace(text, NOTICE, "")


def delivered(df: DataFrame, filed: str, said: str, language: str | None = None) -> DataFrame:
    """df with delivered (share of filed words that were said) and unscripted (share of said words not filed), three decimals; 0 and 0 if either is empty."""
    ship(df.sparkSession)

    @F.pandas_udf("struct<delivered:double,unscripted:double>")
    def compare(a: pd.Series, b: pd.Series, lang: pd.Series) -> pd.DataFrame:
        rows = []
        for x, y, l in zip(a, b, lang):
            f, s = tokens(x, l), tokens(y, l)
            if f and s:
                same = sum(m.size for m in SequenceMatcher(None, f, s, autojunk=False).get_matching_blocks())
                rows.append((round(same / len(f), 3), round(1 - same / len(s), 3)))
            else:
                rows.append((0.0, 0.0))
        return pd.DataFrame(rows, columns=["delivered", "unscripted"])

    lang = F.col(language) if language else F.lit("en")
    return df.withColumn("_c", compare(F.col(filed), transcript_body(F.col(said)), lang)).select(*df.columns, "_c.*")


def shared_passage(df: DataFrame, a: str, b: str, context: int = 25) -> DataFrame:
    """df with passage (longest common run of words, case and punctuation aside), n_words, and it with its context in a."""
    ship(df.sparkSession)

    @F.pandas_udf("struct<passage:string,n_words:int,around:string>")
    def find(x: pd.Series, y: pd.Series) -> pd.DataFrame:
        rows = []
        for s, t in zip(x, y):
            u, v = (s or "").split(), (t or "").split()
            bare = lambda ws: [re.sub(r"\W+", "", w).lower() for w in ws]
            m = SequenceMatcher(None, bare(u), bare(v), autojunk=False).find_longest_match(0, len(u), 0, len(v))
            rows.append((" ".join(u[m.a : m.a + m.size]), m.size, " ".join(u[max(0, m.a - context) : m.a + m.size + context])))
        return pd.DataFrame(rows, columns=["passage", "n_words", "around"])

    return df.withColumn("_c", find(F.col(a), F.col(b))).select(*df.columns, "_c.*")


#: Words of a run that two texts must share to be compared; a shorter text is one run of its own length.
RUN = 5


def passage_pairs(docs: DataFrame, items: DataFrame, doc: str, item: str, text: str = "text", run: int = RUN) -> DataFrame:
    """doc, item, a, b: every document and item, with their texts, that share a run of words, case and punctuation aside.

    Runs meet by an equality join, so no pair is compared that shares none. Ids are distinct and not null.
    """
    ship(docs.sparkSession)

    @F.pandas_udf("array<string>")
    def bare(x: pd.Series) -> pd.Series:
        return pd.Series([[re.sub(r"\W+", "", w).lower() for w in (t or "").split()] for t in x])

    b = items.select(item, bare(F.col(text)).alias("w")).where(F.size("w") > 0).withColumn("n", F.least(F.size("w"), F.lit(run)))
    sizes = [r.n for r in b.select("n").distinct().collect()]
    d = docs.select(doc, bare(F.col(text)).alias("w"))
    runs = lambda df, k, n: df.select(k, F.explode(F.array_distinct(ngrams(F.col("w"), n))).alias("run"))
    met = None
    for n in sizes:
        one = runs(d, doc, n).join(runs(b.where(F.col("n") == n), item, n), "run").select(doc, item)
        met = one if met is None else met.unionByName(one)
    if met is None:
        met = docs.select(doc).join(items.select(item), F.lit(False))
    return met.distinct().join(docs.select(doc, F.col(text).alias("a")), doc).join(items.select(item, F.col(text).alias("b")), item)


def quoted_by(items: DataFrame, docs: DataFrame, item: str, text: str = "text", run: int = RUN) -> DataFrame:
    """item and quoted_by: in how many documents an item's whole text stands, exactly.

    The words between an item's first and last are whole words of any text that holds it, so the first run of them finds the
    candidates; items of less than three words are looked for in every document. Ids of items are distinct.
    """
    cut = lambda t: F.split(t, r"\s+")
    q = items.select(item, F.col(text).alias("q")).withColumn("w", cut(F.col("q"))).withColumn("n", F.greatest(F.least(F.size("w") - 2, F.lit(run)), F.lit(0)))
    q = q.withColumn("run", F.array_join(F.slice("w", 2, F.col("n")), " ")).drop("w")
    sizes = [r.n for r in q.where("q IS NOT NULL").select("n").distinct().collect()]
    # rows of documents have no key of their own that can be relied on
    d = stored(docs.select(F.expr("uuid()").alias("_d"), F.col(text).alias("t")).where("t IS NOT NULL"))
    found = None
    for n in sizes:
        mine = q.where((F.col("n") == n) & F.col("q").isNotNull())
        if n:
            met = d.select("_d", F.explode(F.array_distinct(let(cut(F.col("t")), lambda w: ngrams(w, n)))).alias("run")).join(mine, "run").select("_d", item, "q").join(d, "_d")
        else:
            met = d.join(mine, F.lit(True))
        one = met.where(F.contains("t", "q")).select(item)
        found = one if found is None else found.unionByName(one)
    if found is None:
        return items.select(item, F.lit(0).cast("long").alias("quoted_by"))
    n = found.groupBy(item).agg(F.count(F.lit(1)).alias("quoted_by"))
    return items.select(item).join(n, item, "left").select(item, F.coalesce("quoted_by", F.lit(0).cast("long")).alias("quoted_by"))


def count_tokens(df: DataFrame, text: str, language: str) -> DataFrame:
    """df with n_tokens and tokens_sha256, of the tokens joined by blanks."""
    ship(df.sparkSession)

    @F.pandas_udf("struct<n_tokens:long,tokens_sha256:string>")
    def count(x: pd.Series, lang: pd.Series) -> pd.DataFrame:
        rows = [(len(t), hashlib.sha256(" ".join(t).encode()).hexdigest()) for t in map(tokens, x, lang)]
        return pd.DataFrame(rows, columns=["n_tokens", "tokens_sha256"])

    return df.withColumn("_c", count(F.col(text), F.col(language))).select(*df.columns, "_c.*")


def closest_name(df: DataFrame, text: str, names: dict[str, str], cutoff: float = 0.85) -> DataFrame:
    """df with code: the name's code that is closest to a text by matching blocks, if close enough. The dictionary is small and fixed."""
    from difflib import get_close_matches

    ship(df.sparkSession)

    @F.pandas_udf("string")
    def match(x: pd.Series) -> pd.Series:
        keys = list(names)
        return pd.Series([names[c[0]] if t and (c := get_close_matches(t, keys, n=1, cutoff=cutoff)) else None for t in x])

    return df.withColumn("code", match(F.col(text)))
