"""Grouped figures: overviews, shares, distributions, inequality, agreement."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lexicon


def overview(df: DataFrame, words: Column, flags: Mapping[str, Column]) -> DataFrame:
    """One row: number of rows, sum and whole median of words, share of rows of each flag."""
    shares = [F.avg(f.cast("double")).alias(f"{n}_share") for n, f in flags.items()]
    return df.agg(F.count(F.lit(1)).alias("n"), F.sum(words).cast("long").alias("total"), F.floor(F.median(words)).cast("long").alias("median"), *shares)


def shares_by_group(df: DataFrame, names: Column, group: str, digits: int = 3) -> DataFrame:
    """For rows with an array of names: name, group, n, share of the group's rows. Groups without a name are not listed."""
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("size"))
    hits = df.select(group, F.explode(F.array_distinct(names)).alias("name")).groupBy("name", group).agg(F.count(F.lit(1)).alias("n"))
    return hits.join(sizes, group).select("name", group, "n", F.round(F.col("n") / F.col("size"), digits).alias("share"))


def membership_shares(df: DataFrame, names: Column, group: str, digits: int = 3) -> DataFrame:
    """name, group, n, share as shares_by_group gives them, and over all rows, where the group is null."""
    flat = df.select(F.col(group).cast("string").alias(group), names.alias("_names"))
    whole = shares_by_group(flat.withColumn(group, F.lit("")), F.col("_names"), group, digits).withColumn(group, F.lit(None).cast("string"))
    return shares_by_group(flat, F.col("_names"), group, digits).unionByName(whole)


def means_by(df: DataFrame, groupings: Sequence[str], values: Sequence[str], digits: int = 2) -> DataFrame:
    """Means of values by each grouping column alone, in one pass (grouping sets)."""
    sets = [[F.col(g)] for g in groupings]
    return df.groupingSets(sets, *[F.col(g) for g in groupings]).agg(*[F.round(F.avg(v), digits).alias(v) for v in values], F.count(F.lit(1)).alias("n"))


def share_if_known(df: DataFrame, by: Sequence[str], value: Column, known: Column, least: float = 0.5) -> DataFrame:
    """The share of rows with the value among those known, null where fewer than a least share are known."""
    k = F.avg(known.cast("double"))
    share = F.count_if(known & value) / F.nullif(F.count_if(known), F.lit(0))
    return df.groupBy(*by).agg(F.when(k >= least, share).alias("share"), F.count(F.lit(1)).alias("n"))


def ratio_of_sums(df: DataFrame, by: Sequence[str], part: Column, whole: Column, per: float = 1000, digits: int = 2) -> DataFrame:
    """A pooled rate: the sum of parts by the sum of wholes, not the mean of ratios."""
    return df.groupBy(*by).agg(F.round(per * F.sum(part) / F.nullif(F.sum(whole), F.lit(0)), digits).alias("rate"))


def lorenz(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Gini coefficient of non-negative values, from their ranks: 2 * sum(rank * value) / (n * sum) - (n + 1) / n.

    Equal values share the sum whatever their order. Ranks come from counts of distinct values, so no task sorts all rows.
    """
    by = list(by)
    v = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("c"))
    # rows below each distinct value, by a running sum over value ranges
    w = Window.partitionBy(*by).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    r = v.withColumn("below", F.coalesce(F.sum("c").over(w), F.lit(0)))
    ranks = F.col("c") * F.col("below") + F.col("c") * (F.col("c") + 1) / 2
    return r.groupBy(*by).agg((2 * F.sum(ranks * F.col(value)) / (F.sum("c") * F.sum(F.col("c") * F.col(value))) - (F.sum("c") + 1) / F.sum("c")).alias("gini"), F.sum("c").cast("long").alias("n"))


def precision_recall(df: DataFrame, by: Sequence[str], given: Column, found: Column) -> DataFrame:
    """Rows, agreement, precision and recall of a rule against labels."""
    both = F.count_if(given & found)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(given == found).alias("agree"),
        (both / F.nullif(F.count_if(found), F.lit(0))).alias("precision"), (both / F.nullif(F.count_if(given), F.lit(0))).alias("recall"),
    )


def headlines(df: DataFrame, text: str, *, verbs: int = 15) -> DataFrame:
    """kind (tone, verb, issue), name, n, place: how often headlines have each tone, their most frequent verbs, and the issues they name."""
    tone, verb = lexicon.headline(F.col(text))
    issues = lexicon.flags(F.col(text), lexicon.patterns(lexicon.ISSUES, lexicon.CASE_SENSITIVE))
    one = lambda kind, name: F.array(F.struct(F.lit(kind).alias("kind"), name.alias("name")))
    all_ = F.concat(one("tone", tone), one("verb", verb), F.transform(issues, lambda i: F.struct(F.lit("issue").alias("kind"), i.alias("name"))))
    n = df.select(F.explode(all_).alias("x")).select("x.*").where("name IS NOT NULL").groupBy("kind", "name").agg(F.count(F.lit(1)).alias("n"))
    ranked = n.withColumn("place", F.row_number().over(Window.partitionBy("kind").orderBy(F.desc("n"), "name")))
    return ranked.where((F.col("kind") != "verb") | (F.col("place") <= verbs))


def mode(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """The most frequent value of each key, of equally frequent ones the smallest."""
    c = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    return c.groupBy(*by).agg(F.min_by(value, F.struct(-F.col("n"), F.col(value))).alias(value), F.max("n").alias("n"))


def check_totals(counts: DataFrame, official: DataFrame, on: Sequence[str], n: str = "n") -> DataFrame:
    """Rows where counts and official totals differ or one of them is missing; should be empty."""
    a, b = counts.withColumnRenamed(n, "counted"), official.withColumnRenamed(n, "official")
    return a.join(b, list(on), "full_outer").where(~F.col("counted").eqNullSafe(F.col("official")))
