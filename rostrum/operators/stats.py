"""Tests and resampling: chi-square, binomial, Fisher, bootstrap. Statistics in the JVM; exact tails on aggregated rows."""

from __future__ import annotations

from collections.abc import Iterator
from math import exp, lgamma

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship


def chi_square(df: DataFrame, a: str, b: str, *, yates: bool = True, tests: int = 1) -> DataFrame:
    """chi2, dof, n, cramers_v, and p (Bonferroni-corrected for a number of tests) of independence of two columns.

    A 2x2 table gets Yates' correction unless told otherwise. The p-value is worked out where the one row of figures is.
    """
    ship(df.sparkSession)
    t = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    ra = t.groupBy(a).agg(F.sum("n").alias("na"))
    rb = t.groupBy(b).agg(F.sum("n").alias("nb"))
    size = t.agg(F.sum("n").alias("total"), F.count_distinct(a).alias("ka"), F.count_distinct(b).alias("kb"))
    grid = ra.join(rb, F.lit(True)).join(size, F.lit(True)).join(t, [a, b], "left")
    e = F.col("na") * F.col("nb") / F.col("total")
    off = F.abs(F.coalesce("n", F.lit(0)) - e)
    off = F.when(F.lit(yates) & (F.col("ka") == 2) & (F.col("kb") == 2), F.greatest(F.lit(0.0), off - 0.5)).otherwise(off)
    s = grid.groupBy("total", "ka", "kb").agg(F.sum(off * off / e).alias("chi2"))
    s = s.select("chi2", ((F.col("ka") - 1) * (F.col("kb") - 1)).alias("dof"), F.col("total").alias("n"), F.sqrt(F.col("chi2") / (F.col("total") * F.nullif(F.least("ka", "kb") - 1, F.lit(0)))).alias("cramers_v"))

    @F.pandas_udf("double")
    def tail(chi2: pd.Series, dof: pd.Series) -> pd.Series:
        return pd.Series([min(1.0, tests * chi2_tail(x, k)) for x, k in zip(chi2, dof)])

    return s.withColumn("p", tail("chi2", "dof"))


def chi2_tail(x: float, dof: int) -> float:
    """The chance of a chi-square value of at least x, by the incomplete gamma function's series or continued fraction."""
    if x <= 0 or dof <= 0:
        return 1.0
    a, z = dof / 2, x / 2
    scale = exp(-z + a * np.log(z) - lgamma(a))
    if z < a + 1:
        term = total = 1 / a
        k = a
        while term > total * 1e-15:
            k += 1
            term *= z / k
            total += term
        return max(0.0, 1 - total * scale)
    tiny, b = 1e-300, z + 1 - a
    c, d = 1 / tiny, 1 / b
    h = d
    for i in range(1, 1000):
        n = -i * (i - a)
        b += 2
        d = 1 / (n * d + b or tiny)
        c = b + n / c or tiny
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return scale * h


def _choose(n: float, k: float) -> float:
    return lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1)


def binomial_p(k: int, n: int, p: float, low: float = 0.001, high: float = 0.999) -> float:
    """Two-sided exact binomial test: the chance of outcomes no likelier than k, p clipped."""
    p = min(high, max(low, p))
    logs = [_choose(n, i) + i * np.log(p) + (n - i) * np.log1p(-p) for i in range(n + 1)]
    return min(1.0, sum(exp(x) for x in logs if x <= logs[k] + 1e-7))


def fisher_p(a: int, b: int, c: int, d: int) -> float:
    """Two-sided Fisher exact test of a 2x2 table."""
    r, s, k = a + b, c + d, a + c
    logs = {i: _choose(r, i) + _choose(s, k - i) - _choose(r + s, k) for i in range(max(0, k - s), min(k, r) + 1)}
    return min(1.0, sum(exp(x) for x in logs.values() if x <= logs[a] + 1e-7))


def binomial_tests(df: DataFrame, k: str, n: str, p: str) -> DataFrame:
    """df (one row a test) with p_value."""
    ship(df.sparkSession)

    @F.pandas_udf("double")
    def test(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        return pd.Series([binomial_p(int(x), int(y), float(z)) if pd.notna(z) else np.nan for x, y, z in zip(a, b, c)])

    return df.withColumn("p_value", test(F.col(k), F.col(n), F.col(p).cast("double")))


def fisher_tests(df: DataFrame, a: str, b: str, c: str, d: str) -> DataFrame:
    """df (one row a 2x2 table) with p_value."""
    ship(df.sparkSession)

    @F.pandas_udf("double")
    def test(w: pd.Series, x: pd.Series, y: pd.Series, z: pd.Series) -> pd.Series:
        return pd.Series([fisher_p(*map(int, t)) for t in zip(w, x, y, z)])

    return df.withColumn("p_value", test(a, b, c, d))


def bootstrap_mean(df: DataFrame, by: list[str], key: str, value: str, *, draws: int = 500, low: float = 0.05, high: float = 0.95, seed: int = 17) -> DataFrame:
    """by, mean, low, high: quantiles of the mean over Poisson resamples.

    Row weights come from a hash of the key and the draw's number, so each row is read once, resampled where it is, and only
    sums per group and draw are shuffled.
    """
    u = F.pmod(F.xxhash64(F.col(key), F.col("draw"), F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    # Poisson(1) by its distribution function
    steps, total, term = [], 0.0, exp(-1)
    for k in range(12):
        total += term
        steps.append((k, total))
        term /= k + 1
    weight = F.lit(12)
    for k, t in reversed(steps):
        weight = F.when(u < t, k).otherwise(weight)
    d = df.select(*by, key, F.col(value).cast("double").alias("v"), F.explode(F.sequence(F.lit(1), F.lit(draws))).alias("draw")).withColumn("w", weight)
    m = d.groupBy(*by, "draw").agg((F.sum(F.col("w") * F.col("v")) / F.nullif(F.sum("w"), F.lit(0))).alias("m"))
    q = m.groupBy(*by).agg(F.percentile("m", low).alias("low"), F.percentile("m", high).alias("high"))
    return df.groupBy(*by).agg(F.avg(value).alias("mean")).join(q, by)
