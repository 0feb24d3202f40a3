"""Attention that outlets pay to subjects, weighted within countries and averaged over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def panel(outlets: DataFrame) -> DataFrame:
    """country, outlet, weight, rule from outlets (country, outlet, reach or null, words, reports).

    A country's outlets of known reach share its weight by reach; where none has reach, the outlet of most words (then reports,
    then the first name) has it all.
    """
    w = Window.partitionBy("country")
    o = outlets.withColumn("_all", F.sum("reach").over(w))
    o = o.withColumn("_rn", F.row_number().over(w.orderBy(F.desc("words"), F.desc("reports"), "outlet")))
    by_reach = F.col("_all").isNotNull()
    kept = o.where((by_reach & F.col("reach").isNotNull()) | (~by_reach & (F.col("_rn") == 1)))
    return kept.select("country", "outlet", F.when(by_reach, F.col("reach") / F.col("_all")).otherwise(F.lit(1.0)).alias("weight"), F.when(by_reach, "reach").otherwise("most words").alias("rule"))


def country_views(mentions: DataFrame, weights: DataFrame, own: DataFrame | None = None) -> DataFrame:
    """country, subject, share, votes: the blend of an outlet's shares in each country.

    mentions: outlet, subject, n. With own (country, subject), a country's own subject is left out of its outlets' mentions.
    Outlets without mentions carry no weight, so weights are divided by those of the country's other outlets.
    """
    m = mentions.join(weights, "outlet")
    if own is not None:
        m = m.join(own.withColumn("_own", F.lit(True)), ["country", "subject"], "left").where("_own IS NULL").drop("_own")
    totals = m.groupBy("country", "outlet", "weight").agg(F.sum("n").alias("total")).where("total > 0")
    whole = totals.groupBy("country").agg(F.sum("weight").alias("all_weight"), F.sum("total").alias("votes"))
    shares = m.join(totals.select("country", "outlet", "total"), ["country", "outlet"]).groupBy("country", "subject").agg(F.sum(F.col("weight") * F.col("n") / F.col("total")).alias("blend"))
    return shares.join(whole, "country").select("country", "subject", (F.col("blend") / F.col("all_weight")).alias("share"), "votes")


def attention(views: DataFrame, least: int = 10) -> DataFrame:
    """subject and share: the mean over countries with at least so many mentions, countries without the subject counting 0."""
    voting = views.where(F.col("votes") >= least)
    n = voting.agg(F.count_distinct("country").alias("countries"))
    return voting.groupBy("subject").agg(F.sum("share").alias("total")).join(F.broadcast(n), F.lit(True)).select("subject", (F.col("total") / F.col("countries")).alias("share"))


def by_group(mentions: DataFrame, groups: DataFrame, group: str, leave_out: Column | None = None) -> DataFrame:
    """group, subject, share: the mean of outlets' shares within a group of outlets (outlet, group, ...)."""
    m = mentions.join(groups if leave_out is None else groups.where(~leave_out), "outlet")
    totals = m.groupBy("outlet").agg(F.sum("n").alias("total"))
    sizes = m.groupBy(group).agg(F.count_distinct("outlet").alias("outlets"))
    s = m.join(totals, "outlet").groupBy(group, "subject").agg(F.sum(F.col("n") / F.col("total")).alias("sum"))
    return s.join(sizes, group).select(group, "subject", (F.col("sum") / F.col("outlets")).alias("share"))


def home_bias(views: DataFrame, country_region: DataFrame, subject_region: DataFrame) -> DataFrame:
    """region, own_share (mean over the region's countries of the share of subjects of that region), base_share (subjects of the region among all)."""
    base = subject_region.groupBy("region").agg(F.count(F.lit(1)).alias("k"))
    total = subject_region.agg(F.count(F.lit(1)).alias("total"))
    v = views.join(country_region.withColumnRenamed("region", "own"), "country").join(subject_region, "subject")
    per = v.groupBy("country", "own").agg(F.sum(F.when(F.col("region") == F.col("own"), F.col("share")).otherwise(0.0)).alias("own_share"))
    r = per.groupBy(F.col("own").alias("region")).agg(F.avg("own_share").alias("own_share"))
    return r.join(base, "region").join(F.broadcast(total), F.lit(True)).select("region", "own_share", (F.col("k") / F.col("total")).alias("base_share"))


def voices(podium: DataFrame, press: DataFrame, name: str = "name", digits: int = 2) -> DataFrame:
    """name, podium and press rate per 1000 words (pooled: n and words a row), and their ratio, null where the podium is silent."""
    rate = lambda df, a: df.groupBy(name).agg(F.round(1000 * F.sum("n") / F.nullif(F.sum("words"), F.lit(0)), digits).alias(a))
    j = rate(podium, "podium").join(rate(press, "press"), name, "full_outer")
    return j.withColumn("ratio", F.round(F.col("press") / F.nullif(F.col("podium"), F.lit(0.0)), digits))
