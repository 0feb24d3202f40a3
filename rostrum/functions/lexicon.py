"""Word lists: flags, counts and rates of named patterns, each compiled once into one set of expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .strings import word_count

# --- Fixed values: the word lists of political speech that the analyses use unless others are given. ---
ISSUES = {
    "Ukraine": r"\bukrain",
    "Gaza or Palestine": r"\bgaza\b|\bpalestin",
    "Gaza": r"\bgaza\b",
    "Palestinian statehood": r"two-state|palestinian state|state of palestine|recogni[sz]\w*\s+(of\s+)?(the\s+)?(state\s+of\s+)?palestin",
    "Iran and the Gulf war": r"\biran\b|\biranian|persian gulf|gulf war|\bhormuz",
    "Sudan": r"(?<!south )\bsudan\b",
    "Haiti": r"\bhaiti",
    "Climate change": r"climate|global warming|sea[- ]level",
    "Artificial intelligence": r"(?i:artificial intelligence)|\bAI\b",
    "Security Council reform": r"reform of the security council|security council reform|reform(ing)? the security council",
    "Debt": r"\bdebt\b",
    "Nuclear weapons": r"nuclear weapon|non-proliferation|nuclear disarmament",
    "Terrorism": r"terroris",
    "Migration and refugees": r"\bmigra|\brefugee",
    "Sanctions": r"sanction|unilateral coercive",
    "Colonialism and reparations": r"colonial|reparat",
    "The next Secretary-General": r"(next|new|future) secretary-general|woman secretary-general|female secretary-general|selection of the secretary-general",
    "Taiwan": r"\btaiwan",
}
CASE_SENSITIVE = ("Artificial intelligence",)
MARKERS = {
    "Multipolar": r"multipolar",
    "Rules-based order": r"rules-based",
    "Great power(s)": r"great powers?\b",
    "Spheres of influence": r"spheres? of influence",
    "Hegemony": r"hegemon",
    "Double standards": r"double standard",
    "Global South": r"global south",
    "Unilateral sanctions": r"unilateral coercive|sanction",
    "Reparations": r"reparat",
    "Security Council veto": r"\bveto",
    "Nuclear": r"\bnuclear",
}
TONES = {
    "Alarm": r"warns?|raises? alarm|sounds? alarm|blasts?|slams?|denounces?|condemns?|rejects?|accuses?|calls? out|renounces?|confronts?",
    "Appeal": r"urges?|urging|calls? for|demands?|stresses|pushes|advocates?|proposes?",
    "Showcase": r"hails?|touts?|highlights?|spotlights?|champions?|pledges?|pledging|announces?|welcomes?|reaffirms?|defends?|prioritizes?|lays out|spells out|credits?|backs?|casts itself|speaks up|joins?|stands firm|underlines?|cites?|anchors?|showing|rising|reaches|is back|poised|affirms",
}
NO_VERB = "Statement, no verb"
FRAMES = {
    "Realism": ("power", "security", "threat", "deter", "military", "armed forces", r"arms\b", "weapon", "defen[cs]e", r"force\b", "strateg", "balance of power", "great power", "national interest", "territor", r"war\b", r"wars\b"),
    "Liberal institutionalism": ("cooperat", "multilateral", "institution", "international law", "rules-based", "rule of law", "trade", "interdependen", "partnership", "treat(y|ies)", "charter", "agreement", "reform", "governance", "democra"),
    "Constructivism": ("identit", r"norm\b", r"norms\b", "values", "dignity", "cultur", "civili[sz]ation", "histor", "shared", "solidarity", "humanity", "belong", "memory", "narrative", "moral"),
    "Critical and postcolonial": ("colonial", "imperial", "global south", "inequalit", "injustice", "justice", "reparat", "exploit", "hegemon", "sanction", "unilateral coercive", "debt", "marginali", "domination", "north and south"),
}
CHARTER_OR_LAW = r"(?iu)\bcharter\b|international law"
SALUTATION = r"(?iu)madam president|mr\.? president|excellencies"
# --- End of fixed values. ---


def patterns(lists: Mapping[str, str | tuple[str, ...]], case_sensitive: tuple[str, ...] = ()) -> dict[str, str]:
    """One pattern a name: a tuple of prefixes is an alternation at a word's start; case is ignored but for the names given."""
    out = {}
    for name, p in lists.items():
        body = p if isinstance(p, str) else r"\b(?:" + "|".join(p) + ")"
        out[name] = body if name in case_sensitive else f"(?iu){body}"
    return out


def flags(text: Column, pats: Mapping[str, str]) -> Column:
    """The names whose pattern a text has, in the list's order."""
    hits = F.array(*[F.struct(F.lit(n).alias("name"), text.rlike(p).alias("hit")) for n, p in pats.items()])
    return F.transform(F.filter(hits, lambda x: x["hit"]), lambda x: x["name"])


def flag_columns(text: Column, pats: Mapping[str, str]) -> dict[str, Column]:
    return {n: text.rlike(p) for n, p in pats.items()}


def counts(text: Column, pats: Mapping[str, str]) -> dict[str, Column]:
    return {n: F.regexp_count(text, F.lit(p)) for n, p in pats.items()}


def rates(text: Column, pats: Mapping[str, str], per: int = 1000, digits: int = 2) -> dict[str, Column]:
    """Matches per so many words, a text without words counting as one word."""
    words = F.greatest(word_count(text), F.lit(1))
    return {n: F.round(per * c / words, digits) for n, c in counts(text, pats).items()}


def headline(text: Column, tones: Mapping[str, str] = TONES) -> tuple[Column, Column]:
    """The tone of a headline's first verb and that verb in lower case; NO_VERB and null without one."""
    bounded = {n: rf"(?i)\b(?:{p})\b" for n, p in tones.items()}
    any_verb = r"(?i)\b(?:" + "|".join(tones.values()) + r")\b"
    verb = F.lower(F.regexp_extract(text, any_verb, 0))
    return first_family(text, bounded, NO_VERB), F.nullif(verb, F.lit(""))


def first_family(text: Column, families: Mapping[str, str], default: str | None = None) -> Column:
    """The name whose pattern matches earliest; ties go to the first name in the alphabet."""
    at = F.array(*[F.struct(F.regexp_instr(text, F.lit(p)).alias("at"), F.lit(n).alias("name")) for n, p in families.items()])
    found = F.filter(at, lambda x: x["at"] > 0)
    return F.when(F.size(found) > 0, F.array_min(found)["name"]).otherwise(F.lit(default))
