"""Files kept in a cache with what is known of them: the file-based form of cached downloads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import below, exists, stored

KNOWN = "name string, sha256 string, size long, modified timestamp, content binary, fetched_at timestamp"


def fetch(spark: SparkSession, path: str, cache: str, refresh: bool = False) -> DataFrame:
    """name (its path below path), sha256, size, hit of every file: contents that the cache has are not read again unless refresh says so.

    What is new is appended to the cache, a Parquet table, with the time it was fetched; of a name the newest record counts. A file that is
    gone from path stays in the cache but is not listed.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).withColumn("name", below(F.col("path"), path))
    known = spark.read.schema(KNOWN).parquet(cache) if exists(spark, cache) else spark.createDataFrame([], KNOWN)
    before = stored(known.select("name").distinct().withColumn("hit", F.lit(not refresh)))
    new = files if refresh else files.join(before, "name", "left_anti")
    got = new.select("name", F.sha2("content", 256).alias("sha256"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"), "content", F.current_timestamp().alias("fetched_at"))
    got.write.mode("append").parquet(cache)
    newest = spark.read.schema(KNOWN).parquet(cache).groupBy("name").agg(F.max_by(F.struct("sha256", "size"), "fetched_at").alias("k"))
    return files.select("name").join(newest, "name").join(before, "name", "left").select("name", "k.sha256", "k.size", F.coalesce("hit", F.lit(False)).alias("hit"))
