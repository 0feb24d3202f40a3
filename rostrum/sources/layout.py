"""Glyph rows of a page to text blocks, by windows: rows, words, blocks, bold prefixes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Sizes in points and shares of the type size.
BODY_SIZE, GAP_AS_SPACE = 9.5, 0.15
FURNITURE = r"^(?:\d{1,3}|\d{2}-\d{5}\s*\(E\)|\*\d{7,}\*|\d{1,3}\s*/\s*\d{1,3})$"


def blocks(glyphs: DataFrame, page: str, *, least_size: float = BODY_SIZE, leading: float = 1.8) -> DataFrame:
    """page, seq, text, bold (the bold characters that open it), all_bold, italic of each block of glyphs (page, y, x0, x1, size, bold, italic, char).

    Small type is dropped. Glyphs within half a type size of height are a row; a wide gap is a blank; a row farther than so many sizes
    below the last, or the start of bold after plain type, begins a block. Page numbers and document marks are dropped.
    """
    p = Window.partitionBy(page).orderBy("y", "x0")
    g = glyphs.where(F.col("size") >= least_size)
    g = g.withColumn("_new", (F.coalesce(F.col("y") - F.lag("y").over(p), F.lit(0.0)) > F.col("size") / 2).cast("int")).withColumn("_row", F.sum("_new").over(p.rowsBetween(Window.unboundedPreceding, 0)))
    r = Window.partitionBy(page, "_row").orderBy("x0")
    g = g.withColumn("_c", F.concat(F.when(F.coalesce(F.col("x0") - F.lag("x1").over(r), F.lit(0.0)) > GAP_AS_SPACE * F.col("size"), " ").otherwise(""), F.col("char")))
    rows = g.groupBy(page, "_row").agg(F.min("y").alias("y"), F.max("size").alias("size"), F.array_sort(F.collect_list(F.struct("x0", "_c", "bold"))).alias("cs"), F.min("bold").alias("all_bold"), F.min("italic").alias("italic"))
    text = F.btrim(F.array_join(F.transform("cs", lambda c: c["_c"]), ""))
    lead = F.aggregate("cs", F.struct(F.lit("").alias("t"), F.lit(True).alias("on")), lambda s, c: F.struct(F.when(s["on"] & c["bold"], F.concat(s["t"], c["_c"])).otherwise(s["t"]).alias("t"), (s["on"] & c["bold"]).alias("on")), lambda s: F.btrim(s["t"]))
    rows = rows.select(page, "_row", "y", "size", text.alias("text"), lead.alias("lead"), "all_bold", "italic").where(~F.col("text").rlike(FURNITURE))
    w = Window.partitionBy(page).orderBy("_row")
    far = F.col("y") - F.lag("y").over(w) > leading * F.col("size")
    turn = (F.col("lead") != "") & ~F.lag("all_bold").over(w)
    rows = rows.withColumn("_b", F.sum((F.coalesce(far, F.lit(False)) | F.coalesce(turn, F.lit(False))).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    b = rows.groupBy(page, "_b").agg(F.array_sort(F.collect_list(F.struct("_row", "text"))).alias("ts"), F.min_by("lead", "_row").alias("bold"), F.min("all_bold").alias("all_bold"), F.min("italic").alias("italic"))
    return b.select(page, F.col("_b").cast("long").alias("seq"), F.array_join(F.transform("ts", lambda t: t["text"]), " ").alias("text"), "bold", "all_bold", "italic")
