"""Scalar text functions as Column expressions."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A separator that cannot occur in a text that was split.
CUT = "\u0001"


def let(value: Column, use) -> Column:
    """use(value) with value worked out once: as a lambda's variable it is not put in again wherever it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def collapse(text: Column) -> Column:
    """White space to single blanks, none at the ends."""
    return F.btrim(F.regexp_replace(text, r"(?U)\s+", " "))


@lru_cache(maxsize=1)
def folding() -> tuple[str, str, str]:
    """Letters beyond ASCII whose decomposition is one ASCII letter, those letters, and the other marks and letters up to U+024F."""
    plain, letters, other = [], [], []
    for code in range(0x80, 0x250):
        c = chr(code)
        base = unicodedata.normalize("NFKD", c).encode("ascii", "ignore").decode()
        if len(base) == 1:
            plain.append(base)
            letters.append(c)
        else:
            other.append(c)
    return "".join(letters), "".join(plain), "".join(other)


def fold_accents(text: Column) -> Column:
    """Latin letters without their accents; other characters beyond ASCII become nothing. Stays in the JVM, unlike a Unicode normaliser."""
    letters, plain, _ = folding()
    return F.regexp_replace(F.translate(text, letters, plain), r"[^\x00-\x7F]", "")


def normalise_name(name: Column) -> Column:
    """A name for comparison: apostrophes made alike, accents off, lower case, letters, blanks, hyphens and apostrophes only."""
    straight = F.translate(name, "’`", "''")
    return collapse(F.regexp_replace(F.lower(fold_accents(straight)), "[^a-z' -]", " "))


def slugify(text: Column) -> Column:
    """Lower case, & as "and", other runs than letters and digits as one hyphen, none at the ends."""
    return F.btrim(F.regexp_replace(F.replace(F.lower(text), F.lit("&"), F.lit("and")), "[^a-z0-9]+", "-"), F.lit("-"))


#: Second labels under which sites of a country are registered.
SHARED_SECOND = ("co", "com", "org", "net", "gov", "gob", "ac", "edu")


def site(host: Column, shared: tuple[str, ...] = SHARED_SECOND) -> Column:
    """The registrable part of a host name: its last two labels, or three if the last but one is shared."""
    labels = F.split(F.regexp_replace(F.lower(host), r"^www\.", ""), r"\.")
    n = F.size(labels)
    keep = F.when((n > 2) & F.element_at(labels, -2).isin(*shared), 3).otherwise(2)
    return F.array_join(F.slice(labels, F.greatest(n - keep + 1, F.lit(1)), keep), ".")


def strip_honorific(name: Column, pattern: str) -> Column:
    """A name without the prefix that the pattern matches, what follows a bracket, and blanks or colons at the ends."""
    return F.btrim(F.split(F.regexp_replace(name, f"^(?:{pattern})", ""), r"\(")[0], F.lit(" :"))


#: What separates sentences: white space after an end mark, before a capital or an opening quote.
SENTENCE = r"(?<=[.!?])\s+(?=[A-Z\"“])"
#: The same, not after a title, also at bullets.
SENTENCE_TITLES = r"(?<!\bMr\.)(?<!\bMs\.)(?<!\bDr\.)(?<!\bSt\.)(?<!Mrs\.)(?<!H\.E\.)(?<=[.!?])\s+(?=[A-Z\"“‘(])|\s*[•●▪]\s*"


def sentences(text: Column, pattern: str = SENTENCE) -> Column:
    """The sentences of a text, blank ones left out."""
    return F.filter(F.split(text, pattern, -1), lambda s: F.btrim(s) != "")


def chunks(items: Column, size: int) -> Column:
    """Neighbouring items of an array joined by blanks, so many at a time."""
    starts = lambda x: F.filter(F.sequence(F.lit(1), F.greatest(F.size(x), F.lit(1)), F.lit(size)), lambda i: i <= F.size(x))
    # the items are worked out once, not for every chunk
    return let(items, lambda x: F.transform(starts(x), lambda i: F.array_join(F.slice(x, i, size), " ")))


def word_count(text: Column) -> Column:
    """Runs of characters between white space. Each with the white space around it becomes one character, so that no array of words is made."""
    t = F.coalesce(text, F.lit(""))
    return F.when(t.rlike(r"\S"), F.length(F.regexp_replace(t, r"\s*+\S++\s*+", "x"))).otherwise(F.lit(0))


URL = r"https?://\S+|www\.\S+"
#: Letters in a row, with apostrophes or hyphens inside.
TOKEN = r"\p{L}+(?:[-'’]\p{L}+)*"
CONTRACTION = r"['’](?:s|t|re|ve|ll|d|m)$"


def raw_tokens(text: Column) -> Column:
    """Lower-case words without addresses, in order; contractions and short and common words are among them."""
    plain = F.when(text.rlike(URL), F.regexp_replace(text, URL, " ")).otherwise(text)
    return F.regexp_extract_all(F.lower(plain), F.lit(TOKEN), F.lit(0))


def keeps(token: Column, stop: list[str] | tuple[str, ...] = (), least: int = 3) -> Column:
    """Whether a word counts: long enough, no contraction, not stopped."""
    return (F.length(token) >= least) & ~token.rlike(CONTRACTION) & (~token.isin(*stop) if stop else F.lit(True))


def word_tokens(text: Column, stop: list[str] | tuple[str, ...] = (), least: int = 3) -> Column:
    """Lower-case words of some letters at least, without addresses, contractions and stop words, in order."""
    return F.filter(raw_tokens(text), lambda w: keeps(w, stop, least))


def is_menu(text: Column, share: float = 0.6) -> Column:
    """No sentence marks, and most words begin with a capital or no letter."""
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    big = F.filter(words, lambda w: ~w.rlike(r"^\p{L}") | w.rlike(r"^\p{Lu}"))
    return ~text.rlike(r"[.!?,:;”\"]") & (F.size(big) >= share * F.size(words))


_DAY = r"(20\d\d-\d\d-\d\d)"
#: Where a page says when it was published, first place first.
PUBLISHED = (
    ("property", "article:published_time"),
    ("property", "og:published_time"),
    ("name", "pubdate"),
    ("itemprop", "datePublished"),
)


def published(html: Column) -> Column:
    """The publication date (yyyy-mm-dd) of a page: the first of its meta tags that has one, then its structured data, then a time tag."""
    found = []
    for attr, value in PUBLISHED:
        v = re.escape(value)
        found.append(F.regexp_extract(html, rf"(?is)<meta[^>]*{attr}=[\"']{v}[\"'][^>]*content=[\"'][^\"']*?{_DAY}", 1))
        found.append(F.regexp_extract(html, rf"(?is)<meta[^>]*content=[\"'][^\"']*?{_DAY}[^\"']*[\"'][^>]*{attr}=[\"']{v}[\"']", 1))
    found.append(F.regexp_extract(html, rf"\"datePublished\"\s*:\s*\"{_DAY}", 1))
    found.append(F.regexp_extract(html, rf"(?is)<time[^>]*datetime=[\"'][^\"']*?{_DAY}", 1))
    return F.coalesce(*[F.nullif(x, F.lit("")) for x in found])


def escape_markdown(text: Column) -> Column:
    """Backslashes before characters that Markdown reads as marks, at a line's start only where they are read there."""
    inner = F.regexp_replace(text, r"([\\`*_\[\]<>])", r"\\$1")
    return F.regexp_replace(inner, r"(?m)^(\s*)(#{1,6}\s|[-+]\s|\d+\.\s)", r"$1\\$2")


def yaml_scalar(text: Column) -> Column:
    """A double-quoted YAML string, or null."""
    quoted = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    return F.when(text.isNull(), "null").otherwise(F.concat(F.lit('"'), quoted, F.lit('"')))


def ordinal(n: Column) -> Column:
    """1st, 2nd, 3rd, 4th, 11th, 21st, ..."""
    teen = (n % 100).between(11, 13)
    end = F.when(~teen & (n % 10 == 1), "st").when(~teen & (n % 10 == 2), "nd").when(~teen & (n % 10 == 3), "rd").otherwise("th")
    return F.concat(n.cast("string"), end)


def straight_quotes(text: Column) -> Column:
    return F.translate(text, "‘’“”", "''\"\"")


def readable_pattern(pattern: Column) -> Column:
    """A word-list pattern as a reader would write it: no word ends, of a class its first letter, of two endings the first."""
    plain = F.regexp_replace(F.replace(pattern, F.lit("\\b"), F.lit("")), r"\[(\w)\w*\]", "$1")
    return F.regexp_replace(plain, r"\((\w+)\|\w+\)", "$1")


#: What marks a brand as an online one, a word or the end of an address.
ONLINE_ENDS = ("com", "co", "net", "org", "be", "de", "fr", "es", "it", "nl", "ch", "at", "ie", "uk", "au", "jp", "kr", "in", "sg", "my", "id", "ph", "th", "tw", "hk", "ke", "ng", "za", "ma", "br", "ar", "cl", "co", "mx", "pe", "ca", "cz", "hu", "pl", "sk", "ro", "rs", "gr", "fi", "no", "se", "dk", "pt", "tr", "bg", "hr", "si", "info", "tv")
ONLINE = rf"(?i)online|\.(?:{'|'.join(ONLINE_ENDS)})\b"


def is_online(brand: Column) -> Column:
    """Whether a brand's name says that it is online or gives a web address."""
    return brand.rlike(ONLINE)


def percent(share: Column) -> Column:
    """A share as a whole percentage."""
    return F.concat(F.round(share * 100).cast("long").cast("string"), F.lit("%"))


def excerpt(text: Column, start: Column, end: Column, words: int = 40) -> Column:
    """About so many words around characters start to end (from 0), widened to whole words: text, and whether either end is cut."""
    before = F.filter(F.split(F.substring(text, F.lit(1), start), r"\s+"), lambda w: w != "")
    match = F.substring(text, start + 1, end - start)
    after = F.filter(F.split(F.substring(text, end + 1, F.length(text)), r"\s+"), lambda w: w != "")
    half = words // 2
    # a word that the match begins or ends inside belongs to the match
    glue_left = F.when(F.substring(text, start, F.lit(1)).rlike(r"^\S$") & (start > 0), "").otherwise(" ")
    glue_right = F.when(F.substring(text, end + 1, F.lit(1)).rlike(r"^\S$"), "").otherwise(" ")
    left = F.slice(before, F.greatest(F.size(before) - half + 1, F.lit(1)), half)
    right = F.slice(after, 1, half)
    return F.struct(
        F.btrim(F.concat(F.array_join(left, " "), glue_left, match, glue_right, F.array_join(right, " "))).alias("text"),
        (F.size(before) > half).alias("cut_start"),
        (F.size(after) > half).alias("cut_end"),
    )


#: Words by which French and English are told apart.
FRENCH = ("le", "la", "les", "des", "et", "est", "dans", "pour", "que", "qui", "une", "du", "au", "sur", "pas", "par", "nous", "ce")
ENGLISH = ("the", "of", "and", "to", "in", "that", "is", "for", "which", "this", "we", "be", "it", "by", "on", "are")


def french_or_english(text: Column) -> Column:
    """fr if a text has strictly more of the French function words, else en."""
    words = F.split(F.lower(text), r"[^\p{L}]+")
    count = lambda known: F.size(F.filter(words, lambda w: w.isin(*known)))
    return F.when(count(FRENCH) > count(ENGLISH), "fr").otherwise("en")


def refine_cyrillic(text: Column, given: Column) -> Column:
    """Tajik, Kazakh or Kyrgyz where a text has over twenty of the letters that only they have, else the language given."""
    n = lambda letters: F.length(text) - F.length(F.translate(text, letters, ""))
    return F.when(n("ҷӣӯҳҲҶӢӮ") > 20, "tg").when(n("әіұӘІҰ") > 20, "kk").when(n("өүңӨҮҢ") > 20, "ky").otherwise(given)


def meeting_symbol(session: Column, meeting: Column, first_numbered: int = 31) -> Column:
    """A/<session>/PV.<meeting> from the session that first numbers its own meetings, A/PV.<meeting> before."""
    own = F.concat(F.lit("A/"), session.cast("string"), F.lit("/PV."), meeting.cast("string"))
    return F.when(session >= first_numbered, own).otherwise(F.concat(F.lit("A/PV."), meeting.cast("string")))


#: Fixed value: a meeting's own date names its weekday.
MEETING_DATE = r"(?i)(?:monday|tuesday|wednesday|thursday|friday|saturday|sunday)\s*,?\s*(\d{1,2})\s+(january|february|march|april|may|june|july|august|september|october|november|december)\s*,?\s+(19\d\d|20\d\d)"


def meeting_date(text: Column) -> Column:
    """The first valid "Weekday, D Month YYYY" of a text."""
    day, month, year = (F.regexp_extract_all(text, F.lit(MEETING_DATE), F.lit(i)) for i in (1, 2, 3))
    parts = F.transform(F.arrays_zip(day.alias("d"), month.alias("m"), year.alias("y")), lambda x: F.try_to_date(F.concat_ws(" ", F.lpad(x["d"], 2, "0"), F.initcap(F.lower(x["m"])), x["y"]), "dd MMMM yyyy"))
    return F.get(F.filter(parts, lambda d: d.isNotNull()), 0)


def session_year(session: Column) -> Column:
    return session + 1945


#: Shares of characters that say whether a text layer is fit to use.
def letter_share(text: Column) -> Column:
    solid = F.regexp_count(text, F.lit(r"\S"))
    return F.regexp_count(text, F.lit(r"[\p{L}\p{M}]")) / F.nullif(solid, F.lit(0))


def misordered_mark_share(text: Column) -> Column:
    """Combining marks that follow no letter or mark, as a share of characters."""
    return F.regexp_count(text, F.lit(r"(?<![\p{L}\p{M}])\p{M}")) / F.nullif(F.length(text), F.lit(0))


def mixed_script_share(text: Column, least: int = 50) -> Column:
    """Words of other scripts that also hold Latin letters, as a share of words of other scripts; 0 below a least number of them."""
    words = F.regexp_extract_all(text, F.lit(r"[\p{L}\p{M}]+"), F.lit(0))
    foreign = F.filter(words, lambda w: w.rlike(r"[\p{L}&&[^\p{IsLatin}]]"))
    mixed = F.filter(foreign, lambda w: w.rlike(r"\p{IsLatin}"))
    return F.when(F.size(foreign) < least, F.lit(0.0)).otherwise(F.size(mixed) / F.size(foreign))


def usable_layer(text: Column) -> Column:
    """Whether a text layer is long enough, mostly letters, with marks in order and scripts apart."""
    return (F.length(text) >= 300) & (letter_share(text) >= 0.6) & (misordered_mark_share(text) <= 0.01) & (mixed_script_share(text) <= 0.01)
