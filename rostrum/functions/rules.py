"""Ordered rules: the first pattern that matches decides."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .strings import collapse

# --- Fixed values: ranks of office by title, narrower titles before the broader ones that they contain. ---
ROLES = (
    ("un_official", r"secretary-general|president of the general assembly"),
    ("regional_organisation", r"president of the european (council|commission)|chair(person)? of the african union commission"),
    ("other_official", r"head of (the )?administration of the president|chief of staff"),
    ("junior_minister", r"vice[- ]minister|deputy minister|state secretary|secretary of state for|minister of state(?! and for foreign)|parliamentary secretary"),
    ("deputy_head", r"vice[- ]president|deputy prime minister|vice prime minister|first deputy|crown prince|vice[- ]chair"),
    ("head_of_government", r"prime minister|taoiseach|president of the government|president of the council of ministers|chairman of the council of ministers|head of (the )?govern?ment|chancellor|premier\b|chief adviser|chief executive"),
    ("head_of_state", r"\bpresident\b|head of state|\bking\b|\bqueen\b|\bamir\b|\bemir\b|emperor|sultan|grand duke|prince\b|c?h?airman of the presidency|member of the presidency|chair of the presidential council|chairman of the presidential council|chairman of the assembly presidium|governor-general|captain regent"),
    ("foreign_minister", r"foreign affairs|foreign minister|external affairs|external relations|international relations|european and international affairs|foreign relations|relations with states"),
    ("other_minister", r"\bminister\b"),
    ("diplomat", r"permanent representative|ambassador|charg[ée] d'affaires|head of (the )?delegation|chair(man)? of (the )?delegation|un representative|^delegation$"),
)
OVERRIDES = {("holy-see", "secretary of state"): "head_of_government"}
ROLE_GROUPS = {
    "head_of_state": "head_of_state_or_government",
    "head_of_government": "head_of_state_or_government",
    "deputy_head": "deputy_head",
    "foreign_minister": "foreign_minister",
    "junior_minister": "other_minister",
    "other_minister": "other_minister",
    "diplomat": "diplomat",
    "other_official": "other",
    "regional_organisation": "not_a_state",
    "un_official": "not_a_state",
    "unclassified": "unclassified",
}
# --- End of fixed values. ---


def classify(text: Column, rules: Iterable[tuple[str, str]], default: str | None = None) -> Column:
    """The name of the first rule whose pattern the text has."""
    out = None
    for name, pattern in rules:
        hit = text.rlike(pattern)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def role(title: Column, slug: Column | None = None) -> Column:
    """The rank of office of a title; delegations whose titles read differently come first, a missing title is unclassified."""
    t = collapse(F.lower(title))
    found = classify(t, ROLES, "unclassified")
    if slug is not None:
        for (s, given), name in OVERRIDES.items():
            found = F.when((slug == s) & (t == given), name).otherwise(found)
    return F.when(t.isNull() | (t == ""), "unclassified").otherwise(found)


def lookup(value: Column, table: Mapping[str, str], default: str | None = None) -> Column:
    """A value by a small fixed table."""
    out = None
    for k, v in table.items():
        out = F.when(value == k, v) if out is None else out.when(value == k, v)
    return out.otherwise(F.lit(default))


def role_group(name: Column) -> Column:
    return lookup(name, ROLE_GROUPS)
