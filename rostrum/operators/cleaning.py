"""Clean text for analysis: furniture off, broken lines joined to paragraphs. JVM only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .sequences import transcript_body
from .textmining import let

# --- Fixed values: lines that are no part of a speech. ---
PAGE_MARK = r"(?i)^(page\s*)?\d{1,3}(\s*(of|/|de|из)\s*\d{1,3})?$|^-\s*\d{1,3}\s*-$"
DELIVERY_NOTE = r"(?i)^\(?\s*(please\s+)?check\s+against\s+delivery\s*\)?$|^\(?\s*seul le prononcé fait foi\s*\)?$|^\(?\s*cotejar con el discurso pronunciado\s*\)?$"
PRESIDING = r"(?i)^(the (general )?assembly will (now )?hear|on behalf of the (general )?assembly|i thank the .{0,120} for (his|her|their|the)|i would (like|wish) to thank (the )?(president|prime minister|minister|vice|king|his|her)|i would like\.?$|i (now )?(request|ask) (the )?protocol|(and )?(i )?invite (him|her) to|on behalf of the general assembly|i now give the floor|i (now )?invite|i give the floor|thank you\.?$|merci\.?$|gracias\.?$|l'assemblée va|je prie le protocole|la asamblea escuchará|solicito al protocolo)"
CLOSING = r"(?is)\s*(on behalf of the (general )?assembly, i (wish to )?thank|i thank the .{0,120} for (his|her|their) ).*$"
SENTENCE_END = r"[.!?:;\"”’»)\]]$|[。！？]$"
# --- End of fixed values. ---


def lines_of(text: Column) -> Column:
    return F.transform(F.split(F.replace(text, F.lit("\r"), F.lit("")), "\n", -1), lambda x: F.btrim(x, F.lit(" \t‏")))


def drop_repeated(lines: Column, least: int = 3, longest: int = 80) -> Column:
    """Lines without the short ones that occur so often in the same text: in sorted order, those that are met again so many places on."""
    short = F.array_sort(F.filter(lines, lambda x: (x != "") & (F.length(x) < longest)))
    often = lambda s: F.array_distinct(F.filter(s, lambda x, i: F.get(s, i + (least - 1)) == x))
    without = lambda gone: F.filter(lines, lambda x: ~F.array_contains(gone, x))
    return let(let(short, often), without)


def trim_presiding(lines: Column, opening: int = 10) -> Column:
    """Lines after the last presiding line among the first few, without presiding or blank lines at the end."""
    last = lambda xs, test: F.coalesce(F.array_max(F.filter(F.transform(xs, lambda x, i: F.when(test(x), i + 1)), lambda i: i.isNotNull())), F.lit(0))
    start = last(F.slice(lines, 1, opening), lambda x: x.rlike(PRESIDING))
    rest = let(start, lambda s: F.slice(lines, s + 1, F.greatest(F.size(lines) - s, F.lit(0))))
    return let(rest, lambda r: F.slice(r, F.lit(1), last(r, lambda x: (x != "") & ~x.rlike(PRESIDING))))


def join_lines(text: Column) -> Column:
    """Lines of a paragraph as one: a soft or typographic hyphen joins a word, a plain one stays, ideographs need no blank."""
    t = F.regexp_replace(text, r"(?<=\p{L})[‐­]\n(?=\p{Ll})", "")
    t = F.regexp_replace(t, r"(?<=\p{L}-)\n", "")
    t = F.regexp_replace(t, "(?<=[　-鿿])\\n(?=[　-鿿])", "")
    return F.regexp_replace(F.regexp_replace(t, r"\n", " "), r"[ \t]+", " ")


def regroup(lines: Column) -> Column:
    """Paragraphs from lines: a new one after a sentence's end before a blank line, a capital or what is no letter; blank lines inside sentences vanish."""
    solid = F.filter(F.transform(lines, lambda x, i: F.struct(x.alias("x"), i.alias("i"))), lambda e: e["x"] != "")

    def joined(e: Column) -> Column:
        def glue(now: Column, k: Column) -> Column:
            before = F.get(e, k - 1)
            blank = now["i"] - before["i"] > 1
            new = before["x"].rlike(SENTENCE_END) & (blank | now["x"].rlike(r"^\p{Lu}") | ~now["x"].rlike(r"^\p{L}"))
            return F.concat(F.when(k == 0, "").when(new, "\n\n").otherwise("\n"), now["x"])

        return F.array_join(F.transform(e, glue), "")

    return F.btrim(F.array_join(F.transform(F.split(let(solid, joined), "\n\n", -1), join_lines), "\n\n"))


def clean(df, text: str, kind: str, out: str = "clean"):
    """df with the cleaned text: transcripts lose their notice and the chair's words, statements their repeated lines; "" for no text."""
    t = F.coalesce(F.col(text), F.lit(""))
    is_transcript, is_statement = F.col(kind) == "transcript", F.col(kind) == "statement"
    d = df.withColumn("_l", lines_of(F.when(is_transcript, transcript_body(t)).otherwise(t)))
    d = d.withColumn("_l", F.when(is_transcript, trim_presiding(F.col("_l"))).when(is_statement, drop_repeated(F.col("_l"))).otherwise(F.col("_l")))
    n = F.size("_l")
    closed = F.transform(F.col("_l"), lambda x, i: F.when(is_transcript & (i == n - 1), F.regexp_replace(x, CLOSING, "")).otherwise(x))
    d = d.withColumn("_l", closed)
    d = d.withColumn("_l", F.filter("_l", lambda x: ~x.rlike(PAGE_MARK) & ~x.rlike(DELIVERY_NOTE)))
    return d.withColumn(out, regroup(F.col("_l"))).drop("_l")
