"""Personal data: base spans by pattern, and spans that boosted trees select from generous candidates. DataFrame functions only.

Spans are found without leaving the row: what stands between a pattern's matches (split) and the matches themselves give
every offset by a running sum. Base spans are the documented patterns with their tests. Candidates come from looser
patterns of the same kinds, and from card or phone numbers inside runs of digits that fail the base tests as a whole;
they may overlap. Gradient-boosted trees of depth two score each by its format and context; a span whose calibrated
probability reaches its kind's threshold and that overlaps no base span is added, the likelier one first.

The trees are trained here, on examples that this module makes by rule from a fixed seed: well-formed personal data of each
kind in contexts that name it or not, and look-alikes (versions, sums, dates, ratios, order numbers, prose). Two thirds fit
the trees, one third fits the calibration and chooses thresholds of at least PRECISION. Features are Spark expressions, so
training and scoring see the same ones; the trees become nested CASE expressions.
"""

from __future__ import annotations

import json
import random

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
#: Examples that are made, rounds and learning rate of the boosting, least precision of a kind's threshold on held-out examples.
EXAMPLES, ROUNDS, RATE, PRECISION = 2400, 40, 0.3, 0.97
#: Characters of context on either side of a candidate.
CONTEXT = 24

#: The base patterns. Lookbehinds and possessive quantifiers keep a match's meaning and make its search linear.
LOCAL = r"[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
OCTET = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
IPV4 = rf"^{OCTET}(?:\.{OCTET}){{3}}$"

#: The generators of candidates: looser forms of each kind.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?(?:\(at\)|\[at\]|\{at\}) ?[A-Za-z0-9-]{1,63}+(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]{2,63}+)++",
    "ip": r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3})(?![0-9])",
    "phone": r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?|00[0-9]{1,3}[ .-])?\(?[0-9]{2,4}\)?[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])",
}
#: Words whose presence just before a candidate speaks for its kind.
HINTS = {
    "email": r"(?i)(?:mail|contact|write|kontakt|correo|courriel)",
    "ip": r"(?i)(?:\bip\b|host|server|addr|client|from)",
    "card": r"(?i)(?:card|visa|master|amex|karte|carte|tarjeta|pay)",
    "phone": r"(?i)(?:tel|phone|call|fax|mobil|\+|fon|\bring|\bdial|\bsms|\bwhatsapp)",
}


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of 1 to 19 digits passes the Luhn test."""
    back = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(back, i + 1, F.lit(1)).cast("int")
        twice = d * 2
        return total + F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def _valid(kind: str, text: Column) -> Column:
    if kind == "ip":
        return text.rlike(IPV4)
    if kind in ("card", "phone"):
        d = _digits(text)
        low, high = (13, 19) if kind == "card" else (9, 15)
        fits = (F.length(d) >= low) & (F.length(d) <= high)
        return F.when(fits, luhn(d) if kind == "card" else F.lit(True)).otherwise(F.lit(False))
    return F.lit(True)


SPAN = "array<struct<k:int,s:int,e:int,m:string>>"


def matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def place(text: Column, got: Column, kind: str, pattern: str, keep) -> Column:
    """Of a pattern's matches, those that keep accepts: kind number, start, end (code points, end exclusive), match."""
    k = KINDS.index(kind)
    none = F.array().cast(SPAN)

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["gap"])
        end = start + F.length(x["match"])
        span = F.struct(F.lit(k).alias("k"), start.alias("s"), end.alias("e"), x["match"].alias("m"))
        return F.struct(end.alias("at"), F.when(keep(x["match"]), F.concat(state["out"], F.array(span))).otherwise(state["out"]).alias("out"))

    def join(state: Column, b: Column) -> Column:
        moved = F.transform(b["out"], lambda x: F.struct(x["k"].alias("k"), (x["s"] + state["at"]).alias("s"), (x["e"] + state["at"]).alias("e"), x["m"].alias("m")))
        return F.struct((state["at"] + b["at"]).alias("at"), F.concat(state["out"], moved).alias("out"))

    begin = F.struct(F.lit(0).alias("at"), none.alias("out"))
    gaps = F.slice(F.split(text, pattern, -1), 1, F.size(got))
    pairs = F.arrays_zip(gaps.alias("gap"), got.alias("match"))
    # offsets within blocks first, so that no long array is copied for every span
    local = F.transform(blocks(pairs), lambda b: F.aggregate(b, begin, step))
    spans = F.aggregate(local, begin, join, lambda s: s["out"])
    return F.when(F.size(got) > 0, spans).otherwise(none)


#: Spans of a block.
BLOCK = 256


def let(value: Column, use) -> Column:
    """use(value) with value worked out once."""
    return F.get(F.transform(F.array(value), use), 0)


def blocks(items: Column) -> Column:
    """An array cut into arrays of BLOCK items, the last of what is left; none for an empty one."""
    cut = lambda xs: F.transform(F.sequence(F.lit(0), F.floor(F.greatest(F.size(xs) - 1, F.lit(0)) / BLOCK).cast("int")), lambda i: F.slice(xs, i * BLOCK + 1, F.lit(BLOCK)))
    return F.filter(let(items, cut), lambda b: F.size(b) > 0)


def meets(a: Column, b: Column) -> Column:
    return (a["s"] < b["e"]) & (b["s"] < a["e"])


def indexed(spans: Column) -> Column:
    """Spans in order of place, in blocks with the places that each covers, so that a search passes over most of them."""
    placed = F.array_sort(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["k"].alias("k"))))
    return F.transform(blocks(placed), lambda b: F.struct(F.get(b, 0)["s"].alias("s"), F.array_max(F.transform(b, lambda x: x["e"])).alias("e"), b.alias("spans")))


def meets_any(a: Column, index: Column, but_itself: bool = False) -> Column:
    """Whether a span meets any of an index's, itself left out if it is one of them."""
    other = lambda b: meets(a, b) & ~((a["s"] == b["s"]) & (a["e"] == b["e"]) & (a["k"] == b["k"])) if but_itself else meets(a, b)
    return F.exists(index, lambda k: meets(a, k) & F.exists(k["spans"], other))


FEATURES = ("kind", "digits", "length", "groups", "luhn", "valid", "lead", "plus", "parens", "colons", "hint", "sign_before", "letter_touches", "long_run", "distinct", "letters", "tail")


def features(x: Column) -> list[Column]:
    """Numbers that describe a candidate: struct of k, m (match), l and r (context on its left and right)."""
    m, d = x["m"], _digits(x["m"])
    n = F.length(d)
    hint = F.lit(False)
    valid = F.lit(False)
    for k, kind in enumerate(KINDS):
        hint = F.when(x["k"] == k, x["l"].rlike(HINTS[kind])).otherwise(hint)
        if kind in ("ip", "card", "phone"):
            valid = F.when(x["k"] == k, _valid(kind, m)).otherwise(valid)
    num = lambda c: c.cast("double")
    return [
        num(x["k"]), num(n), num(F.length(m)), num(F.regexp_count(m, F.lit("[0-9A-Za-z]+"))),
        num(F.when((n >= 12) & (n <= 19), luhn(d)).otherwise(F.lit(False))), num(valid),
        num(F.when(n > 0, F.substring(d, 1, 1).cast("int")).otherwise(F.lit(-1))),
        num(m.startswith("+")), num(m.contains("(")), num(F.regexp_count(m, F.lit(":"))), num(hint),
        num(x["l"].rlike(r"[#$€£=v/][ ]?$")), num(x["l"].rlike(r"\p{L}$") | x["r"].rlike(r"^\p{L}")),
        num(x["l"].rlike(r"[0-9][ .-]?$") | x["r"].rlike(r"^[ .-]?[0-9]")), num(F.size(F.array_distinct(F.split(d, "")))),
        num(F.regexp_count(m, F.lit("[A-Za-z]"))), num(F.length(F.regexp_extract(m, "[A-Za-z0-9]+$", 0))),
    ]


def _examples(seed: int = 7) -> list[tuple[int, str, str, str, int]]:
    """(kind, match, left, right, label): personal data and look-alikes, made by rule."""
    r = random.Random(seed)
    n = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    word = lambda: "".join(r.choice("abcdefghilmnoprstu") for _ in range(r.randint(2, 9)))

    def card(good: bool) -> str:
        d = r.choice("3456") + n(14)
        total = sum(int(c) if i % 2 else (2 * int(c) - 9 * (int(c) > 4)) for i, c in enumerate(reversed(d)))
        last = (10 - total % 10) % 10
        return d + str(last if good else (last + r.randint(1, 9)) % 10)

    hints = {0: "mail me:", 1: "from host", 2: "card no.", 3: "tel."}
    out = []
    for _ in range(EXAMPLES):
        k, good, told = r.randint(0, 3), r.random() < 0.5, r.random() < 0.4
        left = f"{word()} {word()} {hints[k] if told else word()} "
        right = f" {word()} {word()}"
        if k == 0:
            at, dot = r.choice((" (at) ", "(at)", " [at] ", "[at]")), r.choice((".", " (dot) ", " [dot] "))
            end = r.choice(("com", "org", "net", "de", "fr", "info")) if good else word() + word()[:3]
            m = f"{word()}{r.choice(('', '.' + n(2), '_' + word()))}{at}{word()}{dot}{end}"
        elif k == 1:
            m = ":".join(r.choice(("2001", "fe80", "0db8", "85a3", "1f", "0", "8a2e")) for _ in range(8)) if good else ":".join(n(2) for _ in range(r.randint(4, 6)))
        elif k == 2:
            m = card(good)
            if r.random() < 0.3:
                m = r.choice(" -").join(m[i : i + 4] for i in range(0, 16, 4))
            if not good and r.random() < 0.3:
                m = n(r.randint(13, 19))
        elif good:
            m = r.choice((f"({n(3)}) 555-{n(4)}", f"+1 ({n(3)}) {n(3)}-{n(4)}", f"{r.choice('23456789')}{n(2)}{(x := r.choice('-. '))}{n(3)}{x}{n(4)}", f"+{n(2)} {n(3)} {n(3)} {n(4)}", f"0049 {n(3)} {n(4)} {n(4)}", f"0{n(2)} {n(4)} {n(4)}"))
            if not m.startswith(("+", "(")) and r.random() < 0.75:
                left = f"{word()} {word()} {r.choice(('tel.', 'call', 'ring us on', 'dial'))} "
        else:
            m = r.choice((f"{n(2)}.{n(3)}.{n(3)}", f"{n(4)} {n(4)} {n(4)}", f"{n(4)}-{n(3)}-{n(3)}", f"{n(2)} {n(3)} {n(3)}", f"{r.choice('123456789')}{n(3)}-{n(3)}-{n(4)}", f"{n(2)}.{n(3)}.{n(4)}"))
            if r.random() < 0.3:
                right = r.choice("abcx") + right
            left = f"{word()} {word()} {r.choice(('$', '#', '= ', 'v', 'no ', 'sum '))}"
        if r.random() < 0.15 and k in (2, 3):
            right = f" {n(3)}{right}"
        out.append((k, m, left[-CONTEXT:], right[:CONTEXT], int(good)))
    return out


Tree = tuple[int, float, tuple, tuple]


def _fit_tree(x: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int):
    """A regression tree on gradients and their weights: (feature, cut, left, right), or a leaf's value."""
    value = RATE * float(g.sum() / (h.sum() + 1.0))
    if not depth or len(g) < 20:
        return value
    best = (1e-6, 0, 0.0)
    whole = g.sum() ** 2 / (h.sum() + 1.0)
    for f in range(x.shape[1]):
        for cut in np.unique(np.quantile(x[:, f], np.linspace(0.05, 0.95, 15))):
            left = x[:, f] <= cut
            if left.all() or not left.any():
                continue
            gain = g[left].sum() ** 2 / (h[left].sum() + 1.0) + g[~left].sum() ** 2 / (h[~left].sum() + 1.0) - whole
            if gain > best[0]:
                best = (float(gain), f, float(cut))
    if not best[1] and best[0] <= 1e-6:
        return value
    _, f, cut = best
    left = x[:, f] <= cut
    return (f, cut, _fit_tree(x[left], g[left], h[left], depth - 1), _fit_tree(x[~left], g[~left], h[~left], depth - 1))


def _apply(tree, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    f, cut, left, right = tree
    return np.where(x[:, f] <= cut, _apply(left, x), _apply(right, x))


def _sigmoid(z):
    return 1 / (1 + np.exp(-z))


class Model:
    """Boosted trees, their calibration (a, b) and the threshold of each kind."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        fit = np.arange(len(y)) % 3 != 0
        z, self.trees = np.zeros(len(y)), []
        for _ in range(ROUNDS):
            p = _sigmoid(z[fit])
            tree = _fit_tree(x[fit], y[fit] - p, p * (1 - p), 2)
            self.trees.append(tree)
            z += _apply(tree, x)
        a, b = 1.0, 0.0
        held_z, held_y = z[~fit], y[~fit]
        for _ in range(200):  # Platt's scaling by gradient steps
            e = held_y - _sigmoid(a * held_z + b)
            a, b = a + 0.1 * float((e * held_z).mean()), b + 0.1 * float(e.mean())
        self.a, self.b = a, b
        p, kinds = _sigmoid(a * held_z + b), x[~fit][:, 0]
        self.thresholds = []
        for k in range(len(KINDS)):
            mine = kinds == k
            cuts = [c for c in np.arange(0.5, 0.96, 0.05) if held_y[mine & (p >= c)].sum() >= PRECISION * max(1, (mine & (p >= c)).sum())]
            self.thresholds.append(float(min(cuts, default=0.95)))

    def probability(self, values: list[Column]) -> Column:
        def walk(tree) -> Column:
            if not isinstance(tree, tuple):
                return F.lit(tree)
            f, cut, left, right = tree
            return F.when(values[f] <= cut, walk(left)).otherwise(walk(right))

        z = F.lit(0.0)
        for t in self.trees:
            z = z + walk(t)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-(z * self.a + self.b)))


_MODELS: dict[str, Model] = {}


def model(spark: SparkSession) -> Model:
    """The trained model, made once a session; EXAMPLES rows are collected for it."""
    key = spark.sparkContext.applicationId
    if key not in _MODELS:
        rows = [dict(zip("kmlry", e)) for e in _examples()]
        made = spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(rows)), "array<struct<k:int,m:string,l:string,r:string,y:int>>")).alias("x"))
        got = made.select(F.array(*features(F.col("x"))).alias("f"), F.col("x.y").alias("y")).collect()
        _MODELS.clear()
        _MODELS[key] = Model(np.array([r.f for r in got], float), np.array([r.y for r in got], float))
    return _MODELS[key]


def _with_spans(docs: DataFrame, text: Column) -> DataFrame:
    """docs with the columns _text, _base and _added (spans)."""
    trained = model(docs.sparkSession)
    d = docs.withColumn("_text", text)
    # each step is a projection of its own, so that no pattern is searched twice
    d = d.withColumns({f"_got_{k}": matches(F.col("_text"), BASE[k]) for k in KINDS} | {f"_maybe_{k}": matches(F.col("_text"), LOOSE[k]) for k in KINDS})
    d = d.withColumns({f"_{k}": place(F.col("_text"), F.col(f"_got_{k}"), k, BASE[k], lambda m, k=k: _valid(k, m)) for k in KINDS} | {f"_loose_{k}": place(F.col("_text"), F.col(f"_maybe_{k}"), k, LOOSE[k], lambda m: F.lit(True)) for k in KINDS})
    d = d.withColumns({"_base": F.concat(*[F.col(f"_{k}") for k in KINDS]), "_loose": F.concat(*[F.col(f"_loose_{k}") for k in KINDS])})
    d = d.withColumn("_new", F.when(F.size("_loose") > 0, let(indexed(F.col("_base")), lambda held: F.filter("_loose", lambda a: ~meets_any(a, held)))).otherwise(F.array().cast(SPAN)))
    context = lambda a: F.struct(a["k"].alias("k"), a["s"].alias("s"), a["e"].alias("e"), a["m"].alias("m"), F.substring(F.col("_text"), F.greatest(a["s"] - CONTEXT, F.lit(0)) + 1, F.least(a["s"], F.lit(CONTEXT))).alias("l"), F.substring(F.col("_text"), a["e"] + 1, F.lit(CONTEXT)).alias("r"))
    d = d.withColumn("_seen", F.transform("_new", context))
    d = d.withColumn("_values", F.transform("_seen", lambda a: F.array(*features(a))))
    d = d.withColumn("_p", F.transform("_values", lambda v: trained.probability([F.get(v, F.lit(i)) for i in range(len(FEATURES))])))
    limit = lambda k: F.get(F.array(*[F.lit(t) for t in trained.thresholds]), k)
    likely = F.filter(F.arrays_zip(F.col("_new").alias("a"), F.col("_p").alias("p")), lambda x: x["p"] >= limit(x["a"]["k"]))
    d = d.withColumn("_likely", F.when(F.size("_new") > 0, likely).otherwise(F.array().cast(f"array<struct<a:{SPAN[6:-1]},p:double>>")))
    alone = lambda held: F.transform("_likely", lambda x: F.struct(x["a"].alias("a"), x["p"].alias("p"), (~meets_any(x["a"], held, True)).alias("alone")))
    d = d.withColumn("_told", let(indexed(F.transform("_likely", lambda x: x["a"])), alone))
    # of those that meet others, the likelier comes first; the position breaks the tie of what starts alike: a longer candidate comes first
    ranked = F.array_sort(F.transform(F.filter("_told", lambda x: ~x["alone"]), lambda x: F.struct((-x["p"]).alias("q"), x["a"]["s"].alias("s"), (-x["a"]["e"]).alias("t"), x["a"].alias("a"))))
    none = F.array().cast(SPAN)
    won = F.aggregate(ranked, none, lambda out, x: F.when(F.exists(out, lambda b: meets(x["a"], b)), out).otherwise(F.concat(out, F.array(x["a"]))))
    free = F.transform(F.filter("_told", lambda x: x["alone"]), lambda x: x["a"])
    return d.withColumn("_added", F.when(F.size("_likely") > 0, F.concat(free, won)).otherwise(none))


def _listed(spans: Column) -> Column:
    name = lambda x: F.get(F.array(*[F.lit(k) for k in KINDS]), x["k"])
    return F.array_join(F.transform(spans, lambda x: F.concat(name(x), F.lit(":"), x["s"].cast("string"), F.lit(":"), x["e"].cast("string"))), ",")


def spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans, n_added.

    A null text counts as empty and has no spans. Repeated rows and null ids give a row each; an empty table gives none.
    Spans are in code points, ends exclusive, by kind and start; base spans of one kind never overlap, those of two kinds
    may, and an added one overlaps none. Other columns of docs are not read.
    """
    d = _with_spans(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")), F.col("text"))
    counts = [F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in KINDS]
    whole = F.array_sort(F.concat("_base", "_added"))
    return d.select("doc_id", *counts, F.sha2(_listed(F.col("_base")), 256).alias("base_sha256"), _listed(whole).alias("spans"), F.size("_added").cast("long").alias("n_added"))


def redact(docs: DataFrame, *, text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """docs, same columns, with every span of the text replaced by its kind in brackets, as [EMAIL]; overlapping spans give one mark.

    A text without spans stays as it is, null or not. chars_col, if docs has it, is set to the new text's length where the text changed.
    """
    columns = docs.columns
    d = _with_spans(docs.withColumns({f"_own_{i}": F.col(f"`{c}`") for i, c in enumerate(columns)}).select(*[f"_own_{i}" for i in range(len(columns))]), F.coalesce(F.col(f"_own_{columns.index(text_col)}"), F.lit("")))
    by_place = F.array_sort(F.transform(F.concat("_base", "_added"), lambda x: F.struct(x["s"].alias("s"), (-x["e"]).alias("t"), x["k"].alias("k"))))
    d = d.withColumn("_places", by_place)
    mark = lambda k: F.concat(F.lit("["), F.upper(F.get(F.array(*[F.lit(x) for x in KINDS]), k)), F.lit("]"))

    def step(state: Column, x: Column) -> Column:
        end = -x["t"]
        piece = F.concat(F.substring(F.col("_text"), state["at"] + 1, F.greatest(x["s"] - state["at"], F.lit(0))), F.when(x["s"] >= state["at"], mark(x["k"])).otherwise(F.lit("")))
        return F.struct(F.greatest(state["at"], end).alias("at"), F.concat(state["out"], piece).alias("out"))

    new = F.aggregate("_places", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda s: F.concat(s["out"], F.substring(F.col("_text"), s["at"] + 1, F.length("_text"))))
    changed = F.size("_places") > 0
    d = d.withColumn("_clean", F.when(changed, new))
    out = []
    for i, c in enumerate(columns):
        own = F.col(f"_own_{i}")
        if c == text_col:
            own = F.coalesce("_clean", own)
        elif c == chars_col:
            own = F.when(changed, F.length("_clean").cast(docs.schema[c].dataType)).otherwise(own)
        out.append(own.alias(c))
    return d.select(*out)
