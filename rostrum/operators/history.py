"""Type-2 histories: from a batch of observations, or from an event log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def apply_batch(history: DataFrame, batch: DataFrame, key: str, tracked: list[str], observed: Column, overwrite: list[str] = ()) -> DataFrame:
    """The history after a batch of observations of one time.

    history has the key, tracked and overwritten columns, valid_from, valid_to, is_current, last_checked. An unchanged key's current row
    gets last_checked, and overwritten columns where the batch has a value; a changed key's current row is closed and a new one
    opened; keys that the batch does not have stay as they are; new keys open. Rows of one key in one batch that differ
    each open a version; equal ones are one.
    """
    cols = [key, *tracked, *overwrite]
    b = batch.select(*cols).dropDuplicates([key, *tracked])
    now = history.where("is_current")
    done = history.where("NOT is_current")
    same = None
    for c in tracked:
        eq = F.col(f"h.{c}").eqNullSafe(F.col(f"b.{c}"))
        same = eq if same is None else same & eq
    seen = b.select(F.col(key).alias("_k")).distinct()
    j = now.alias("h").join(b.alias("b"), (F.col(f"h.{key}") == F.col(f"b.{key}")) & same, "left")
    hit = F.col(f"b.{key}").isNotNull()
    j = j.join(seen, F.col(f"h.{key}") == F.col("_k"), "left")
    gone = ~hit & F.col("_k").isNotNull()
    kept = j.select(
        *[F.col(f"h.{c}").alias(c) for c in [key, *tracked]],
        *[F.when(hit & F.col(f"b.{c}").isNotNull(), F.col(f"b.{c}")).otherwise(F.col(f"h.{c}")).alias(c) for c in overwrite],
        F.col("h.valid_from").alias("valid_from"),
        F.when(gone, observed).otherwise(F.col("h.valid_to")).alias("valid_to"),
        (~gone).alias("is_current"),
        F.when(hit, observed).otherwise(F.col("h.last_checked")).alias("last_checked"),
    )
    fresh = b.alias("b").join(now.alias("h"), (F.col(f"h.{key}") == F.col(f"b.{key}")) & same, "left_anti")
    opened = fresh.select(*cols, observed.alias("valid_from"), F.lit(None).cast(history.schema["valid_to"].dataType).alias("valid_to"), F.lit(True).alias("is_current"), observed.alias("last_checked"))
    order = history.columns
    return done.select(*order).unionByName(kept.select(*order)).unionByName(opened.select(*order))


def from_log(log: DataFrame, key: str, at: str, tracked: list[str], tie: list[str] = ()) -> DataFrame:
    """The history that a log of observations adds up to: one row for each run of equal tracked values of a key."""
    w = Window.partitionBy(key).orderBy(at, *tie)
    state = F.struct(*tracked)
    runs = log.withColumn("_before", F.lag(state).over(w)).withColumn("_first", F.row_number().over(w) == 1)
    starts = runs.where(F.col("_first") | ~F.col("_before").eqNullSafe(state))
    after = F.lead(at).over(w)
    last = log.groupBy(key).agg(F.max(at).alias("_last"))
    out = starts.select(key, *tracked, F.col(at).alias("valid_from"), after.alias("valid_to")).withColumn("is_current", F.col("valid_to").isNull())
    return out.join(last, key).withColumn("last_checked", F.coalesce("valid_to", "_last")).drop("_last")


def snapshots(versions: DataFrame, content: str, keep: list[str]) -> DataFrame:
    """One row for each distinct content, by its digest, with the columns to keep of its first row."""
    d = versions.withColumn("sha256", F.sha2(F.col(content), 256))
    return d.groupBy("sha256").agg(F.min(F.struct(*keep)).alias("first"), F.count(F.lit(1)).alias("n")).select("sha256", "first.*", "n")
