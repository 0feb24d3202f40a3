"""Which text of a document counts: its own layer where that is fit to use, else what was recognised from its image."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.strings import usable_layer


def choose(df: DataFrame, layer: str, recognised: str) -> DataFrame:
    """df with text and text_source: "layer" if the layer is usable, else "ocr" if something was recognised, else the layer for want of better, or null."""
    fit = F.coalesce(usable_layer(F.col(layer)), F.lit(False))
    source = F.when(fit, "layer").when(F.coalesce(F.btrim(recognised), F.lit("")) != "", "ocr").when(F.col(layer).isNotNull(), "layer")
    return df.withColumn("text_source", source).withColumn("text", F.when(source == "ocr", F.col(recognised)).when(source == "layer", F.col(layer)))
