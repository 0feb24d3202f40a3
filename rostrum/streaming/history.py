"""Streaming extensions: histories kept up by micro-batches, and event-time windows. The batch forms are in operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.history import apply_batch
from ..sources.tables import exists, remove, stored


def windowed_counts(events: DataFrame, at: str, kind: str, *, width: str = "1 day", slide: str | None = None, late: str = "2 days") -> DataFrame:
    """window start, kind, n, total by tumbling or sliding windows; rows later than the watermark are dropped when streaming."""
    e = events.withColumn(at, F.col(at).cast("timestamp"))
    if e.isStreaming:
        e = e.withWatermark(at, late)
    return e.groupBy(F.window(at, width, slide or width), kind).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), kind, "n", "total")


def sessions(events: DataFrame, at: str, key: str, gap: str = "6 hours", late: str = "2 days") -> DataFrame:
    """key, start, end, n of runs of events that are less than a gap apart."""
    e = events.withColumn(at, F.col(at).cast("timestamp"))
    if e.isStreaming:
        e = e.withWatermark(at, late)
    return e.groupBy(F.session_window(at, gap), key).agg(F.count(F.lit(1)).alias("n")).select(key, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def keep_history(spark: SparkSession, source: str, schema: T.StructType, target: str, checkpoint: str, key: str, tracked: list[str], observed: str, overwrite: list[str] = ()):
    """A query that applies each new file of observations to a history, once, and ends when all files are read (available now).

    Versions go to folders target/v=<batch>; the newest complete one is the history, so a batch that runs twice writes the same version again.
    A batch's days are applied in order, each to a stored table, so that plans do not grow with the days; versions before the last two are deleted.
    """
    def newest(before: int) -> DataFrame | None:
        for v in range(before - 1, -1, -1):
            if exists(spark, f"{target}/v={v}/_SUCCESS"):
                return spark.read.parquet(f"{target}/v={v}")
        return None

    def batch(df: DataFrame, number: int) -> None:
        days = [r[0] for r in df.select(observed).distinct().orderBy(observed).collect()]
        history = newest(number)
        if history is None:
            empty = T.StructType([schema[c] for c in (key, *tracked, *overwrite)])
            history = spark.createDataFrame([], empty).select("*", *[F.lit(None).cast(schema[observed].dataType).alias(c) for c in ("valid_from", "valid_to")], F.lit(None).cast("boolean").alias("is_current"), F.lit(None).cast(schema[observed].dataType).alias("last_checked"))
        for day in days:
            history = stored(apply_batch(history, df.where(F.col(observed) == F.lit(day)), key, tracked, F.lit(day), list(overwrite)))
        history.write.mode("overwrite").parquet(f"{target}/v={number}")
        remove(spark, f"{target}/v={number - 2}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
