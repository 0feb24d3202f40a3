"""Stored intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which driver and executors share; only a local session may do without the setting."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="rostrum-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def own_folder(spark: SparkSession, name: str) -> str:
    """A folder below the shared one that no other call has."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder if it exists."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def below(path: Column, base: str) -> Column:
    """What a file's path has after the folder base."""
    return F.substring_index(path, f"/{base.rstrip('/').rpartition('/')[2]}/", -1)


def stored(df: DataFrame) -> DataFrame:
    """df written as Parquet in the shared folder and read again, so that several uses compute it once and survive lost executors."""
    path = own_folder(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cached(df: DataFrame, name: str, work, version: int = 1) -> DataFrame:
    """work(df), stored under a digest of df's rows and the work's version: a later call with equal rows reads what is stored. A work that changes needs a new version."""
    spark = df.sparkSession
    d = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("s")).first()
    path = f"{shared_folder(spark)}/cache-{name}-{version}-{d.n}-{d.s}"
    if not exists(spark, f"{path}/_SUCCESS"):
        work(df).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
