"""Meetings to speakers' turns: marks as rows, turn ends and headings by windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .relational import as_of

# --- Fixed values: marks of a record's text. ---
GENERAL = r"(?i:g\s?e\s?n\s?e\s?r\s?a\s?[l1I]\s+(?:debate|discussion))"
TITLE = r"(?:Mr|Mrs|Miss|Ms|Sir|Dame|Lord|Lady|Prince|Princess|Sheikh|Shaikh|King|Queen|Emir|General|Marshal|Archbishop|Cardinal|Baron|Count|Dr|U|Mgr|Monsignor|President|Vice-President|Prime\s+Minister|Chancellor|Emperor|Grand\s+Duke|Crown\s+Prince)"
START = r"(?:^|\n|(?<=[.!?:;\"”)])\s)"
_LANG = r"(?:\(((?:translated|interpretation|spoke)[^)]*)\))?\s*"
#: No name goes on over a line that begins with a courtesy title: there another label begins.
_ON = r"(?!\n\s*(?:\d{1,3}\s*[.,]\s*)?(?:Mr|Mrs|Miss|Ms)[.•,]?\s)"
LABEL = rf"{START}\s*(?:\d{{1,3}}\s*[.,]\s*)?({TITLE}[.•,]?(?:{_ON}\s)+(?:{_ON}[^():]){{1,60}}?)\s*\(([^()]{{2,70}})\)\s*{_LANG}:"
CAPS_LABEL = rf"{START}\s*(?:\d{{1,3}}\s*[.,]\s*)?(?:[A-Za-z][a-z]{{0,8}}[.•,]?\s+){{0,2}}([A-Z][A-Z~!'’\-.]{{2,}}(?:\s+[A-Z][A-Z~!'’\-.]{{1,}}){{0,4}})\s*\(([^()]{{2,70}})\)\s*{_LANG}[:;]"
HEAD_LABEL = rf"{START}\s*((?:President|Prime\s+Minister|King|Queen|Emir|Sultan|Chairman|General|Prince|Grand\s+Duke)\s+[A-Z][^():]{{1,50}}?)\s*{_LANG}:"
CHAIR = r"(?i)(?:^|\n)\s*(?:\d{1,3}\s*[.,]\s*)?The\s+(?:ACTING\s+|TEMPORARY\s+)?PRESIDENT\b[^:\n]{0,70}:"
ROSE = r"(?i)The\s+meeting\s+rose\s+at"
ADDRESS = r"ADDRESS\s+BY\s+([^\n]+?),\s+([^\n]+?)\s+OF\s+([^\n]+)"
AGENDA = rf"(?:^|\n)\s*(?:AGENDA\s+ITEM\s+(\d+)[^\n]*\n\s*([^\n(]*)|(GENERAL\s+(?:DEBATE|DISCUSSION))\b)"
TRIBUTE = r"(?:^|\n)\s*(?:TRIBUTE\s+TO|Tribute\s+to\s+the\s+memory|COMMEMORATI|Commemorati)"
SPOKEN = r"(?i)(?:translated|interpretation|spoke)\s+(?:from|in)\s+([A-Za-z]+)"
HEADING_REACH, MIN_TURN_WORDS = 3000, 150
PRESIDING = r"(?i)^the\s*(acting\s*|temporary\s*)?president\b|^the\s*(co-)?chair"
OFFICIAL = r"(?i)^the\s*(deputy\s*)?secretary-general|under-secretary-general|high representative"
RIGHT_OF_REPLY = r"(?i)right of reply"
# --- End of fixed values. ---


def find_marks(df: DataFrame, key: str, text: str, kind: str, pattern: str, groups: Sequence[str] = ()) -> DataFrame:
    """key, at, stop, kind, match and named groups of every match of a pattern; places by a running sum over what lies between matches."""
    got = {g: F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(i)) for i, g in enumerate(("match", *groups))}
    d = df.select(key, F.col(text).alias("_t"), *[c.alias(f"_{g}") for g, c in got.items()]).where(F.size("_match") > 0)
    d = d.withColumn("_gap", F.slice(F.split("_t", pattern, -1), 1, F.size("_match"))).drop("_t")
    names = ["_gap", *[f"_{g}" for g in got]]
    d = d.select(key, F.posexplode(F.arrays_zip(*names)).alias("_i", "_x"))
    w = Window.partitionBy(key).orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("stop", F.sum(F.length("_x._gap") + F.length("_x._match")).over(w))
    return d.select(key, (F.col("stop") - F.length("_x._match")).alias("at"), "stop", F.lit(kind).alias("kind"), *[F.col(f"_x._{g}").alias(g) for g in got])


def scanned_turns(df: DataFrame, key: str, text: str, *, least_words: int = MIN_TURN_WORDS, reach: int = HEADING_REACH) -> DataFrame:
    """key, n, name, country, language note, heading, words, body of each delegate's turn under the general debate.

    Labels, offices, the chair and the closing are marks; a capitals label within five characters of a plain one is the same mark. A turn ends at the next mark.
    The latest agenda mark strictly before a turn decides whether it counts; without any agenda mark all do. An address heading counts for a turn within reach.
    """
    part = lambda kind, p, g: find_marks(df, key, text, kind, p, g)
    plain = part("delegate", LABEL, ("name", "country", "lang"))
    caps = part("delegate", CAPS_LABEL, ("name", "country", "lang"))
    near = plain.select(F.col(key).alias("_k"), F.col("at").alias("_at"))
    caps = caps.join(near, (F.col(key) == F.col("_k")) & (F.abs(F.col("at") - F.col("_at")) < 5), "left_anti")
    head = part("head", HEAD_LABEL, ("name", "lang"))
    marks = plain.unionByName(caps).unionByName(head, True).unionByName(part("chair", CHAIR, ()), True).unionByName(part("end", ROSE, ()), True)
    w = Window.partitionBy(key).orderBy("at", "kind")
    turns = marks.withColumn("_end", F.lead("at").over(w)).where("kind IN ('delegate', 'head')")
    address = part("address", ADDRESS, ("speaker", "title", "of"))
    agenda = part("agenda", AGENDA, ("item", "heading", "debate"))
    states = agenda.select(key, F.col("at").alias("a_at"), ((F.col("debate") != "") | F.col("heading").rlike(GENERAL)).alias("is_debate"))
    states = states.unionByName(address.select(key, F.col("at").alias("a_at"), F.lit(True).alias("is_debate"))).unionByName(part("tribute", TRIBUTE, ()).select(key, F.col("at").alias("a_at"), F.lit(False).alias("is_debate")))
    t = as_of(turns, states, [key], "at", "a_at", ["is_debate"])
    t = as_of(t, address.select(key, F.col("at").alias("h_at"), "speaker", F.col("title").alias("office"), "of"), [key], "at", "h_at", ["speaker", "office", "of"], within=reach)
    has = states.select(key).distinct().withColumn("_has", F.lit(True))
    t = t.join(has, key, "left").where(F.coalesce("is_debate", F.col("_has").isNull()))
    t = t.join(df.select(key, F.col(text).alias("_t")), key)
    body = F.btrim(F.regexp_replace(F.substring(F.col("_t"), F.col("stop") + 1, F.coalesce(F.col("_end"), F.length("_t")) - F.col("stop")), r"\s+", " "))
    t = t.withColumn("body", body).withColumn("words", F.regexp_count("body", F.lit(r"\S+"))).where(F.col("words") >= least_words)
    n = F.row_number().over(Window.partitionBy(key).orderBy("at"))
    country = F.when(F.col("kind") == "delegate", F.col("country")).otherwise(F.col("of"))
    return t.select(key, n.alias("n"), F.btrim("name").alias("name"), country.alias("country"), F.nullif(F.regexp_extract("lang", SPOKEN, 1), F.lit("")).alias("language"), F.when(F.col("kind") == "head", F.initcap("speaker")).alias("heading"), "words", "body")


def agenda_state(text: Column, bold: Column, all_bold: Column, tail: int = 15) -> Column:
    """debate, summit or other where a heading opens that business, else null; a heading is bold but for a short tail."""
    low = F.lower(text)
    heading = all_bold | (F.length(text) - F.length(bold) <= tail)
    out = F.when(bold == "", None).when(low.startswith("general debate") | (low.startswith("agenda item") & F.substring(low, 1, 200).contains("general debate")), "debate")
    return out.when(heading & low.rlike("summit|high-level|commemorat"), "summit").when(low.startswith("agenda item"), "other")


#: A label at a block's start: a name with notes in brackets, before a colon.
OPENING = r"(?s)^(.{2,200}?(?:\([^)]*\)\s*)*):\s*"


def split_label(text: Column, bold: Column, all_bold: Column) -> tuple[Column, Column]:
    """Label and words of a block that opens a speaker's turn: bold at its start, not throughout, and labelled; null label and the whole text else."""
    label = F.regexp_extract(text, OPENING, 1)
    opens = ~all_bold & (bold != "") & (label != "") & text.startswith(F.substring(bold, 1, 10))
    return F.when(opens, F.btrim(label)), F.when(opens, F.regexp_replace(text, OPENING, "")).otherwise(text)


def verbatim_turns(blocks: DataFrame, key: str) -> DataFrame:
    """key, n, label, language, kind, heading, introduction, text of each turn from a meeting's blocks (key, seq, text, bold, all_bold, italic).

    Agenda headings set the business, "Address by" headings resume the debate, labels open turns, the chair's words introduce the
    next speaker, unlabelled blocks continue a turn, stage directions do not. All states are carried by windows over the blocks' order.
    """
    t, b = F.col("text"), F.coalesce(F.col("bold"), F.lit(""))
    w = Window.partitionBy(key).orderBy("seq")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    d = blocks.withColumn("_state", agenda_state(t, b, F.col("all_bold")))
    address = F.col("_state").isNull() & F.col("all_bold") & t.startswith("Address by")
    d = d.withColumn("_address", address)
    last = F.last(F.when(F.col("_state").isNotNull(), F.col("_state")), True).over(run)
    d = d.withColumn("_set", last).withColumn("_business", F.last(F.when(F.col("_state").isNotNull(), F.col("_state")).when(F.col("_address") & (F.coalesce(F.col("_set"), F.lit("debate")) != "summit"), F.lit("debate")), True).over(run))
    label, said = split_label(t, b, F.col("all_bold"))
    d = d.withColumn("_label", F.when(F.col("_state").isNull(), label)).withColumn("_chair", F.coalesce(F.col("_label").rlike(PRESIDING), F.lit(False)))
    breaks = F.col("_state").isNotNull() | F.col("all_bold") | F.col("_label").isNotNull()
    d = d.withColumn("_turn", F.sum(breaks.cast("int")).over(run)).withColumn("_said", F.when(F.col("_label").isNotNull(), said).otherwise(t))
    d = d.withColumn("_reply", F.max(F.col("_chair") & F.lower("_said").contains("right of reply")).over(run))
    # a heading or introduction counts for the first speaker after it only
    speaker = F.col("_label").isNotNull() & ~F.col("_chair")
    d = d.withColumn("_speaker", F.sum(speaker.cast("int")).over(run))
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("_h", F.last(F.when(F.col("_address"), F.struct("text", "_speaker")), True).over(before)).withColumn("_i", F.last(F.when(F.col("_chair"), F.struct(F.col("_said").alias("text"), "_speaker")), True).over(before))
    fresh = lambda c: F.when(F.col(f"{c}._speaker") == F.col("_speaker") - 1, F.col(f"{c}.text"))
    heads = d.where(speaker & ~F.coalesce(F.col("_business").isin("summit", "other"), F.lit(False))).select(key, "_turn", "seq", "_label", "_reply", fresh("_h").alias("heading"), fresh("_i").alias("introduction"))
    texts = d.where(~(F.col("italic") & (b == ""))).groupBy(key, "_turn").agg(F.array_sort(F.collect_list(F.struct("seq", "_said"))).alias("parts"))
    j = heads.join(texts, [key, "_turn"])
    said = F.array_join(F.transform("parts", lambda p: p["_said"]), "\n\n")
    note = F.regexp_extract("_label", r"(?i)\((?:spoke in|interpretation from) ([^;)]+)", 1)
    kind = F.when(F.col("_reply") | F.substring(said, 1, 400).rlike(RIGHT_OF_REPLY), "right_of_reply").otherwise("general_debate")
    n = F.row_number().over(Window.partitionBy(key).orderBy("seq"))
    return j.select(key, n.alias("n"), F.btrim(F.regexp_replace("_label", r"(?i)\((?:spoke in|interpretation from) [^)]*\)", "")).alias("label"), F.coalesce(F.nullif(F.lower(note), F.lit("")), F.lit("english")).alias("language"), kind.alias("kind"), "heading", "introduction", said.alias("text"))


def richer_reading(readings: DataFrame, key: str, reading: str) -> DataFrame:
    """The turns of the reading that finds more of them, or more words in as many, for each meeting."""
    s = readings.groupBy(key, reading).agg(F.count(F.lit(1)).alias("n"), F.sum("words").alias("w"))
    best = s.groupBy(key).agg(F.max_by(reading, F.struct("n", "w", reading)).alias(reading))
    return readings.join(best, [key, reading])


def reading_order(lines: DataFrame, key: str, *, share: float = 0.5) -> DataFrame:
    """key, seq, text: lines (key, page, x0, x1, y, width, text) in reading order, two columns band by band between full-width lines; pages mostly full-width go top to bottom."""
    mid = F.col("width") / 2
    d = lines.withColumn("_span", (F.col("x0") < mid - 20) & (F.col("x1") > mid + 20))
    p = Window.partitionBy(key, "page")
    d = d.withColumn("_one", F.sum(F.when(F.col("_span"), F.length("text")).otherwise(0)).over(p) > share * F.sum(F.length("text")).over(p))
    d = d.withColumn("_band", F.sum(F.col("_span").cast("int")).over(p.orderBy("y", F.desc("_span")).rowsBetween(Window.unboundedPreceding, 0)))
    column = F.when(F.col("_one") | F.col("_span"), 0).when(F.col("x0") < mid, 1).otherwise(2)
    band = F.when(F.col("_one"), 0).otherwise(F.col("_band"))
    order = Window.partitionBy(key).orderBy("page", band, column, F.round("y"), "x0")
    return d.select(key, F.row_number().over(order).alias("seq"), "text")


def original_language(df: DataFrame, languages: Column, floor: Column, official: Column) -> Column:
    """The language a speech was given in: a floor file's; unknown for several others than English; that one; unknown for English
    alone where it is not official; English; without files, English if official, else the first official one."""
    others = F.array_except(F.array_distinct(F.filter(languages, lambda x: x.isNotNull())), F.array(F.lit("en")))
    has_en, en_official = F.array_contains(languages, "en"), F.array_contains(official, "en")
    return (
        F.when(floor.isNotNull(), floor).when(F.size(others) > 1, F.lit(None)).when(F.size(others) == 1, F.get(others, 0))
        .when(has_en & ~en_official, F.lit(None)).when(has_en, "en").when(en_official, "en").otherwise(F.get(official, 0))
    )
