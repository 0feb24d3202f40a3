"""Writers: Parquet, CSV without texts, parents and children, JSON lines, Markdown, checksums."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.strings import escape_markdown, yaml_scalar
from .tables import below


def parquet(df: DataFrame, path: str, by: list[str] = ()) -> None:
    w = df.write.mode("overwrite")
    (w.partitionBy(*by) if by else w).parquet(path)


def csv_without_text(df: DataFrame, path: str) -> DataFrame:
    """Write every column whose name has no "text" in it; returns what was written."""
    kept = df.select(*[c for c in df.columns if "text" not in c])
    kept.write.mode("overwrite").csv(path, header=True)
    return kept


def parents_and_children(df: DataFrame, path: str, *, keys: list[str], children: str, joined: dict[str, str], order: list[str]) -> tuple[DataFrame, DataFrame]:
    """parents/ as CSV (arrays of strings joined by their separator, sorted) and children/ as JSON lines (keys and the fields of each struct)."""
    parents = df.select(*[F.concat_ws(joined[c], c).alias(c) if c in joined else F.col(c) for c in df.columns if c != children])
    kids = df.select(*keys, F.explode(children).alias("_c")).select(*keys, "_c.*")
    parents.orderBy(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in order]).write.mode("overwrite").csv(f"{path}/parents", header=True)
    kids.write.mode("overwrite").json(f"{path}/children")
    return parents, kids


def json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def markdown(df: DataFrame, head: dict[str, str], title: str, text: str):
    """A Markdown document a row: a YAML head, a title, the text with its marks escaped."""
    meta = [F.concat(F.lit(f"{k}: "), yaml_scalar(F.col(c))) for k, c in head.items()]
    return F.concat_ws("\n", F.lit("---"), *meta, F.lit("---"), F.lit(""), F.concat(F.lit("# "), escape_markdown(F.col(title))), F.lit(""), escape_markdown(F.col(text)), F.lit(""))


def report(df: DataFrame, title: str, intro: str, order: list[str]) -> DataFrame:
    """line and its text: a Markdown report with a table of all columns, a row each in an order; an empty cell for null."""
    cells = lambda cs: F.concat(F.lit("| "), F.array_join(F.array(*cs), " | "), F.lit(" |"))
    n = len(df.columns)
    head = [f"# {title}", "", intro, "", "| " + " | ".join(df.columns) + " |", "| " + " | ".join(["---"] * n) + " |"]
    body = df.select(F.row_number().over(Window.orderBy(*order)).alias("_n"), cells([F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]).alias("text"))
    top = df.sparkSession.createDataFrame(list(enumerate(head, 1)), "line int, text string")
    return top.unionByName(body.select((F.col("_n") + len(head)).alias("line"), "text"))


def tar_gz(members: dict[str, bytes], path: str) -> str:
    """Write a small archive of files by name, whole in memory, to any file system that Hadoop knows; returns its path."""
    import io
    import tarfile

    from pyspark.sql import SparkSession

    held = io.BytesIO()
    with tarfile.open(fileobj=held, mode="w:gz") as t:
        for name, content in members.items():
            info = tarfile.TarInfo(name)
            info.size = len(content)
            t.addfile(info, io.BytesIO(content))
    sc = SparkSession.getActiveSession().sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(sc._jsc.hadoopConfiguration()).create(p)
    out.write(bytearray(held.getvalue()))
    out.close()
    return path


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """file (its path below path) and sha256 of every file, sorted by name."""
    d = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return d.select(below(F.col("path"), path).alias("file"), F.sha2("content", 256).alias("sha256")).orderBy("file")
