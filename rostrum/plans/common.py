"""What the plans share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Test lexicons for the driver's invented texts; the political lists are the defaults of the functions themselves.
ISSUES = {"unity": r"\bthe\b.*\btion", "words": r"(?:^|[^a-z])(?:la|les|de)(?:[^a-z]|$)", "order": r"thing", "digits": r"[0-9]{3}", "rights": r"all rights reserved"}
FRAMES = {"northern": r"(?:tion|ing|ed)", "southern": r"(?:ción|mente|ez)", "central": r"(?:ung|keit|sch)"}
STOP = ("the", "and", "for", "les", "des", "der", "und", "los", "las")


#: Tables whose rows hold texts, so that work on them is by far dearer than moving them.
TEXTS = ("documents", "pages", "conversations", "benchmark")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the driver's; texts that come in fewer splits than there are cores, as a file of one row group does, are dealt out first."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return dealt(df) if name in TEXTS else df


def dealt(df: DataFrame) -> DataFrame:
    """df with a partition a core at least. Inputs of as many splits stay as they are, so large ones are never shuffled for it."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.queryExecution().toRdd().getNumPartitions() < cores else df


#: Sentences in SQL: cuts are marked by U+0001, since its patterns look neither back nor ahead.
SENTENCES = r"""list_filter(string_split_regex(regexp_replace(text, '([.!?])\s+([A-Z"“])', '\1' || chr(1) || '\2', 'g'), chr(1)), lambda x: trim(x) <> '')"""
