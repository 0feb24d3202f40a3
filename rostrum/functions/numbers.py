"""Numeric functions over columns and windows."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import stored


def z_scores(df: DataFrame, columns: list[str], by: list[str] = ()) -> DataFrame:
    """(value - mean) / population standard deviation of each column, as z_<column>; a deviation of 0 counts as 1.

    Means are aggregated first and joined back, so that no task holds all rows as an empty window would."""
    stats = []
    for c in columns:
        stats += [F.avg(c).alias(f"_m_{c}"), F.stddev_pop(c).alias(f"_s_{c}")]
    by = list(by)
    means = df.groupBy(*by).agg(*stats)
    joined = df.join(means, by, "left") if by else df.join(F.broadcast(means), F.lit(True), "left")
    out = joined.withColumns({f"z_{c}": (F.col(c) - F.col(f"_m_{c}")) / F.coalesce(F.nullif(F.col(f"_s_{c}"), F.lit(0.0)), F.lit(1.0)) for c in columns})
    return out.drop(*[f"_{k}_{c}" for c in columns for k in "ms"])


def lean(scores: Mapping[str, Column], least: float = 0.5, fallback: str = "No clear lean") -> Column:
    """The name of the highest score, the first of equal ones, if it reaches a least value."""
    best = F.greatest(*scores.values())
    out = F.when(best < least, fallback)
    for name, score in scores.items():
        out = out.when(score == best, name)
    return out


def histogram(df: DataFrame, column: str, width: float, start: float = 0) -> DataFrame:
    """bin (its lower end) and n, for every bin from the lowest to the highest that has a value."""
    b = F.floor((F.col(column) - start) / width).cast("long")
    counted = df.where(F.col(column).isNotNull()).groupBy(b.alias("i")).agg(F.count(F.lit(1)).alias("n"))
    ends = counted.agg(F.min("i").alias("a"), F.max("i").alias("b")).where("a IS NOT NULL")
    grid = ends.select(F.explode(F.sequence("a", "b")).alias("i"))
    return grid.join(counted, "i", "left").select((F.col("i") * width + start).alias("bin"), F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def at_places(df: DataFrame, column: str, places: list[Callable[[Column], Column]]) -> DataFrame:
    """One row with _q: the values at places (from 0, given the number of values) of the ascending order, exactly.

    Equal values are counted first, values are dealt by range, and each partition's count tells where its places begin, so no
    task holds all values; only counts per partition reach one place.
    """
    counted = stored(df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.count(F.lit(1)).alias("n")).repartitionByRange(F.col("v")).withColumn("_p", F.spark_partition_id()))
    before = counted.groupBy("_p").agg(F.sum("n").alias("m")).withColumn("_before", F.sum("m").over(Window.orderBy("_p")) - F.col("m"))
    run = F.sum("n").over(Window.partitionBy("_p").orderBy("v"))
    placed = counted.join(F.broadcast(before), "_p").withColumn("_to", F.col("_before") + run).withColumn("_from", F.col("_to") - F.col("n"))
    total = counted.agg(F.sum("n").alias("total"))
    hit = lambda at: F.max(F.when((F.col("_from") <= at) & (at < F.col("_to")), F.col("v")))
    return placed.join(F.broadcast(total), F.lit(True)).agg(F.array(*[hit(p(F.col("total"))) for p in places]).alias("_q"))


def spread(df: DataFrame, column: str, inner: float = 0.97) -> DataFrame:
    """The column between the values at places floor(n (1 - inner)) and floor(n inner) - 1 of its order, clipped to 0 and 1, as spread_<column>."""
    ends = [lambda n: F.floor(n * (1 - inner) + 1e-9), lambda n: F.floor(n * inner + 1e-9) - 1]
    a, b = F.get("_q", 0), F.get("_q", 1)
    value = (F.col(column) - a) / F.coalesce(F.nullif(b - a, F.lit(0)), F.lit(1))
    return df.join(F.broadcast(at_places(df, column, ends)), F.lit(True), "left").withColumn(f"spread_{column}", F.greatest(F.lit(0.0), F.least(F.lit(1.0), value))).drop("_q")


def rounded(value: Column, digits: int) -> Column:
    """A double to some places as SQL engines round it: the shifted value to the nearest whole number, halves away from zero, signs kept.

    F.round goes by the shortest decimals that stand for the double, and differs where shifting makes a half of what is just below one.
    """
    shifted = F.round(F.abs(value) * 10.0**digits) / 10.0**digits
    return F.when(value < 0, -shifted).otherwise(shifted)


def grade_level(words: Column, sentences: Column, syllables: Column) -> Column:
    """Flesch-Kincaid grade, one decimal."""
    return rounded(0.39 * words / sentences + 11.8 * syllables / words - 15.59, 1)


def reading_ease(words: Column, sentences: Column, syllables: Column) -> Column:
    return rounded(206.835 - 1.015 * words / sentences - 84.6 * syllables / words, 1)


def syllable_count(text: Column) -> Column:
    """Groups of vowels, a silent final e left out, one a word at least."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}]+"), lambda w: w != "")
    one = lambda w: F.greatest(F.lit(1), F.regexp_count(F.regexp_replace(w, r"(?<=[^aeiouy])e$", ""), F.lit("[aeiouyàâäéèêëîïôöùûü]+")))
    return F.aggregate(F.transform(words, one), F.lit(0), lambda a, x: a + x)


def bucket(value: Column, edges: list[float]) -> Column:
    """How many of the sorted edges are at most the value."""
    return sum((F.when(value >= e, 1).otherwise(0) for e in edges), F.lit(0))
