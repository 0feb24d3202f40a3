"""Text mining in the JVM: tokens, vocabularies, TF-IDF, similarity, distinctive words, shingle agreement."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.strings import let
from ..sources.tables import stored
from .blocks import nearest_rows, pairs_at_least


def token_table(df: DataFrame, doc: str, tokens: Column, keep: Sequence[str] = ()) -> DataFrame:
    """doc, pos (from 0), token of every token of an array column."""
    return df.select(doc, *keep, F.posexplode(tokens).alias("pos", "token"))


def ngrams(tokens: Column, n: int) -> Column:
    """Runs of n neighbouring items of an array, joined by blanks."""
    starts = F.when(F.size(tokens) >= n, F.sequence(F.lit(1), F.size(tokens) - (n - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(tokens, i, n), " "))


#: A condition on a token, asked once for each of a document's or group's distinct tokens instead of at every occurrence.
Keep = Callable[[Column], Column]
ALL: Keep = lambda token: F.lit(True)


def counted(tokens: Column) -> Column:
    """token and c, how often it occurs, of each distinct token of an array: by sorting it, within the row."""
    def ends(s: Column) -> Column:
        return let(F.filter(F.sequence(F.lit(1), F.size(s)), lambda i: (i == F.size(s)) | (F.get(s, i - 1) != F.get(s, i))), lambda e: F.transform(e, lambda i, k: F.struct(F.get(s, i - 1).alias("token"), (i - F.when(k > 0, F.get(e, k - 1)).otherwise(0)).alias("c"))))

    return F.when(F.size(tokens) > 0, let(F.array_sort(tokens), ends))


def token_counts(df: DataFrame, doc: str, tokens: Column) -> DataFrame:
    """doc, token, c: how often each document has each of its tokens. Nothing is shuffled unless ids repeat, whose rows are put together first."""
    d = df.select(doc, tokens.alias("_w"))
    if df.groupBy(doc).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count():
        d = d.groupBy(doc).agg(F.flatten(F.collect_list("_w")).alias("_w"))
    return d.select(doc, F.explode(counted(F.col("_w"))).alias("_x")).select(doc, "_x.token", "_x.c")


def common(df: DataFrame, doc: str, tokens: Column, k: int, keep: Keep = ALL) -> DataFrame:
    """token, n, docs: the k most frequent tokens with the number of documents that have them; ties by the token."""
    t = token_counts(df, doc, tokens).groupBy("token").agg(F.sum("c").cast("long").alias("n"), F.count(doc).alias("docs"))
    return t.where(keep(F.col("token"))).orderBy(F.desc("n"), "token").limit(k)


def vocabulary(df: DataFrame, words: Column, least: int) -> DataFrame:
    """word and n of the words that occur so often at least."""
    return df.select(F.explode(words).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def vocabulary_share(df: DataFrame, doc: str, words: Column, known: DataFrame, digits: int = 3) -> DataFrame:
    """Share of each document's words that a vocabulary has; 0 for a document without words. Spark decides whether to broadcast the vocabulary."""
    t = df.select(doc, F.explode(words).alias("word")).groupBy(doc, "word").agg(F.count(F.lit(1)).alias("c"))
    s = t.join(known.select("word", F.lit(1).alias("_k")), "word", "left").groupBy(doc).agg((F.sum(F.when(F.col("_k") == 1, F.col("c")).otherwise(0)) / F.sum("c")).alias("s"))
    return df.select(doc).join(s, doc, "left").select(doc, F.round(F.coalesce("s", F.lit(0.0)), digits).alias("share"))


def tfidf(df: DataFrame, doc: str, tokens: Column, *, min_df: int = 2, max_df: float = 0.5, keep: Keep = ALL) -> DataFrame:
    """doc, token, weight: (1 + ln tf) * (ln((1 + n) / (1 + df)) + 1), rows of length 1.

    Tokens in fewer than min_df documents or more than the max_df share of them are left out; n counts all documents.
    """
    # counted within rows; entries move twice, to their token and, those that are kept, back to their document
    tf = token_counts(df, doc, tokens).where(keep(F.col("token"))).repartition("token")
    n = df.agg(F.count(F.lit(1)).alias("docs"))
    w = tf.withColumn("df", F.count(F.lit(1)).over(Window.partitionBy("token"))).where(F.col("df") >= min_df)
    w = w.join(F.broadcast(n), F.lit(True)).where(F.col("df") <= max_df * F.col("docs"))
    w = w.select(doc, "token", ((1 + F.log("c")) * (F.log((1 + F.col("docs")) / (1 + F.col("df"))) + 1)).alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(doc)))
    return w.select(doc, "token", (F.col("w") / norm).alias("weight"))


def cosine_pairs(weights: DataFrame, doc: str, least: float) -> DataFrame:
    """a < b and their similarity where it reaches a least value, as sums over shared tokens; pairs are made block by block and never shuffled."""
    return pairs_at_least(weights, doc, least)


def log_odds(df: DataFrame, group: str, tokens: Column, *, least_prior: int = 10, least: int = 5, k: int = 10, keep: Keep = ALL) -> DataFrame:
    """group, token, n, z, place: each group's k most distinctive tokens by weighted log-odds with the corpus as prior; ties to the larger token."""
    c = stored(df.select(group, F.explode(tokens).alias("token")).groupBy(group, "token").agg(F.count(F.lit(1)).alias("y")).where(keep(F.col("token"))))
    totals = c.groupBy(group).agg(F.sum("y").alias("n_g"))
    prior = c.groupBy("token").agg(F.sum("y").alias("p"))
    whole = c.agg(F.sum("y").alias("n_all"))
    j = c.where(F.col("y") >= least).join(prior.where(F.col("p") >= least_prior), "token").join(totals, group).join(F.broadcast(whole), F.lit(True))
    a, b = F.col("y") + F.col("p"), F.col("p") - F.col("y") + F.col("p")
    delta = F.log(a / (F.col("n_g") + F.col("n_all") - a)) - F.log(b / (F.col("n_all") - F.col("n_g") + F.col("n_all") - b))
    z = j.select(group, "token", F.col("y").alias("n"), (delta / F.sqrt(1 / a + 1 / b)).alias("z"))
    return z.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy(F.desc("z"), F.desc("token")))).where(F.col("place") <= k)


def shingle_agreement(a: Column, b: Column, n: int = 5, digits: int = 3) -> Column:
    """Containment of distinct word n-grams in the smaller set; null if either has none. Tokens are lower-case letters, digits and underscores."""
    words = lambda t: F.regexp_extract_all(F.lower(t), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    grams = lambda t: let(words(t), lambda w: F.array_distinct(ngrams(w, n)))
    share = lambda p: F.when((F.size(p["x"]) > 0) & (F.size(p["y"]) > 0), F.round(F.size(F.array_intersect(p["x"], p["y"])) / F.least(F.size(p["x"]), F.size(p["y"])), digits))
    return let(F.struct(grams(a).alias("x"), grams(b).alias("y")), share)


def repeated_lines(df: DataFrame, doc: str, text: Column, *, least: int = 3, longest: int = 80) -> DataFrame:
    """doc, line, n of the short lines that repeat within a document."""
    lines = df.select(doc, F.explode(F.transform(F.split(text, "\n"), lambda x: F.btrim(x))).alias("line"))
    return lines.where((F.col("line") != "") & (F.length("line") < longest)).groupBy(doc, "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def stop_list(lists: Sequence[Sequence[str]], names: DataFrame, name: str) -> DataFrame:
    """word: the words of all lists and of all names, lower-case, each once."""
    spark = names.sparkSession
    given = spark.createDataFrame([(w.lower(),) for words in lists for w in words], "word string")
    own = names.select(F.explode(F.regexp_extract_all(F.lower(name), F.lit(r"\p{L}+"), F.lit(0))).alias("word"))
    return given.unionByName(own).distinct()


def top_tokens(weights: DataFrame, doc: str, k: int) -> DataFrame:
    """doc and words: each document's k tokens of most weight, of equal weight the later in the alphabet first."""
    order = Window.partitionBy(doc).orderBy(F.desc(F.round("weight", 9)), F.desc("token"))
    top = weights.where("weight > 0").withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= k)
    listed = F.array_sort(F.collect_list(F.struct("_place", "token")))
    return top.groupBy(doc).agg(F.transform(listed, lambda x: x["token"]).alias("words"))


def mean_similarity(weights: DataFrame, docs: DataFrame, doc: str) -> DataFrame:
    """doc and similarity: each document's mean cosine to all others, without a pair being made: by the sum of all rows, less its own part."""
    whole = weights.groupBy("token").agg(F.sum("weight").alias("_all"))
    dots = weights.join(whole, "token").groupBy(doc).agg((F.sum(F.col("weight") * F.col("_all")) - F.sum(F.col("weight") * F.col("weight"))).alias("_s"))
    n = docs.agg((F.count(F.lit(1)) - 1).alias("_n"))
    return docs.select(doc).join(dots, doc, "left").join(F.broadcast(n), F.lit(True)).select(doc, (F.coalesce("_s", F.lit(0.0)) / F.nullif("_n", F.lit(0))).alias("similarity"))


def extremes(weights: DataFrame, docs: DataFrame, doc: str, *, k: int = 5, least: float = 0.6) -> DataFrame:
    """kind, place, a, b, similarity: the k most distinctive and the k most typical documents by their mean similarity, and the k closest pairs
    among those of at least a similarity. Ties go to the smaller id, for typical ones and pairs to the larger."""
    mean = stored(mean_similarity(weights, docs, doc).select(F.col(doc).alias("a"), F.lit(None).cast(docs.schema[doc].dataType).alias("b"), F.round("similarity", 6).alias("similarity")))
    pairs = cosine_pairs(weights, doc, least).select("a", "b", F.round("similarity", 6).alias("similarity"))
    kinds = [("most_distinctive", mean, [F.asc("similarity"), F.asc("a")]), ("most_typical", mean, [F.desc("similarity"), F.desc("a")]), ("similar_pairs", pairs, [F.desc("similarity"), F.desc("a"), F.desc("b")])]
    out = None
    for kind, df, order in kinds:
        top = df.orderBy(*order).limit(k).withColumn("place", F.row_number().over(Window.orderBy(*order))).select(F.lit(kind).alias("kind"), "place", "a", "b", "similarity")
        out = top if out is None else out.unionByName(top)
    return out


def nearest(weights: DataFrame, doc: str, least: float, k: int = 3) -> DataFrame:
    """doc, other, similarity, place: each document's k nearest among pairs of at least a similarity; of equal nine places the larger id first."""
    near = nearest_rows(weights, doc, least, k)
    return near.withColumn("place", F.row_number().over(Window.partitionBy(doc).orderBy(F.desc(F.round("similarity", 9)), F.desc("other")))).where(F.col("place") <= k)


def representative_sentence(df: DataFrame, doc: str, sentences: Column, words: Column, *, low: int = 60, high: int = 320) -> DataFrame:
    """doc, pos, sentence: the sentence of fitting length with the most of a document's listed words (counted once), ties to the earlier."""
    s = df.select(doc, words.alias("_w"), F.posexplode(sentences).alias("pos", "sentence")).where(F.length("sentence").between(low, high))
    hits = F.size(F.array_intersect(F.array_distinct(F.regexp_extract_all(F.lower("sentence"), F.lit(r"\p{L}+"), F.lit(0))), "_w"))
    return s.withColumn("hits", hits).groupBy(doc).agg(F.max_by(F.struct("pos", "sentence", "hits"), F.struct("hits", -F.col("pos"))).alias("b")).select(doc, "b.*")


def densest_sentence(df: DataFrame, doc: str, sentences: Column, pattern: str, *, low: int = 60, high: int = 400, not_with: str | None = None) -> DataFrame:
    """doc, pos, sentence, hits: the sentence of fitting length with the most matches, ties to the earlier; documents without a match are left out."""
    s = df.select(doc, F.posexplode(F.transform(sentences, lambda x: F.btrim(F.regexp_replace(x, r"\s+", " ")))).alias("pos", "sentence")).where(F.length("sentence").between(low, high))
    if not_with:
        s = s.where(~F.col("sentence").rlike(not_with))
    s = s.withColumn("hits", F.regexp_count("sentence", F.lit(pattern))).where("hits > 0")
    out = s.groupBy(doc).agg(F.max_by(F.struct("pos", "sentence", "hits"), F.struct("hits", -F.col("pos"))).alias("b")).select(doc, "b.*")
    # a typographic or soft hyphen and a blank are a line break inside a word
    return out.withColumn("sentence", F.regexp_replace("sentence", "(?U)(\\w)[‐­] (\\w)", "$1$2"))


def first_evidence(df: DataFrame, doc: str, text: Column, pattern: str, sentence: str, *, chars: int = 300, least_words: int = 8) -> DataFrame:
    """doc, text, cut_start, cut_end: the first sentence that matches, about so many characters around the match, in whole words.

    A fragment of few words takes in the sentences after it until it has enough. Texts without a match are left out. Every step
    is a column of its own, so that no expression holds another many times over; a text is split once, and what has no match goes by
    an explode, since a filter would be pushed below and split it for every sentence.
    """
    at = lambda s: F.array_position(F.transform(s, lambda x: x.rlike(pattern)), True).cast("int")
    rest = let(F.split(text, sentence, -1), lambda s: let(at(s), lambda i: F.when(i > 0, F.array(F.slice(s, i, F.size(s))))))
    d = df.select(doc, F.explode(rest).alias("_s"))
    # words from the match on: the sentence at which there are enough ends the piece
    d = d.withColumn("_n", F.transform("_s", lambda x: F.regexp_count(x, F.lit(r"\S+"))))
    d = d.withColumn("_take", F.aggregate("_n", F.struct(F.lit(0).alias("k"), F.lit(0).alias("w")), lambda a, x: F.when(a["w"] >= least_words, a).otherwise(F.struct((a["k"] + 1).alias("k"), (a["w"] + x).alias("w"))))["k"])
    d = d.withColumn("_w", F.regexp_replace(F.btrim(F.array_join(F.slice("_s", 1, F.col("_take")), " ")), r"\s+\d{1,3}\.?$", ""))
    d = d.withColumn("_hit", F.greatest(F.regexp_instr("_w", F.lit(pattern)) - 1, F.lit(0))).withColumn("_a", F.greatest(F.lit(0), F.col("_hit") - chars // 2))
    d = d.withColumn("_b", F.least(F.length("_w"), F.col("_a") + chars)).withColumn("_a", F.greatest(F.lit(0), F.col("_b") - chars))
    d = d.withColumn("_lead", F.length(F.regexp_extract(F.substring(F.col("_w"), F.lit(1), F.col("_a")), r"\S*$", 0)))
    d = d.withColumn("_tail", F.length(F.regexp_extract(F.substring(F.col("_w"), F.col("_b") + 1, F.length("_w")), r"^\S*", 0)))
    d = d.withColumn("_a", F.col("_a") - F.col("_lead")).withColumn("_b", F.col("_b") + F.col("_tail"))
    return d.select(doc, F.btrim(F.substring(F.col("_w"), F.col("_a") + 1, F.col("_b") - F.col("_a"))).alias("text"), (F.col("_a") > 0).alias("cut_start"), (F.col("_b") < F.length("_w")).alias("cut_end"))
