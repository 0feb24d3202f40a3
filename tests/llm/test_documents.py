"""Near duplicates, contamination, personal data and quality against brute force and planted cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from rostrum.llm import decontam, graph, jaccard, nra, pii, ranker

from .conftest import TEXTS, prose


# --- Jaccard join ---


def brute_components(rows, k, percent):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        n = min(k, len(w))
        sets.append(frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if w else frozenset())
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if (a and b and 100 * len(a & b) >= percent * len(a | b)) or (rows[i][0] is not None and rows[i][0] == rows[j][0]):
                up[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[root(i)] = min(d, low.get(root(i), d))
    return sorted(str((d, len(s), low.get(root(i)))) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def near_copies(seed, groups=6, size=7):
    r = random.Random(seed)
    rows, shared = [], prose(99, 30)
    for g in range(groups):
        base = prose(seed * 100 + g, r.choice((12, 40, 90))).split()
        for _ in range(size):
            w = list(base)
            for _ in range(r.randrange(4)):
                w[r.randrange(len(w))] = f"edit{r.randrange(9)}"
            rows.append((len(rows), " ".join(w) + (" " + shared if r.random() < 0.4 else "")))
    return rows


@pytest.mark.parametrize(("k", "percent", "chunk", "frequent"), [(4, 85, 256, 4), (5, 80, 3, 2), (3, 60, 2, 1000)])
def test_components_against_brute_force(spark, k, percent, chunk, frequent):
    rows = near_copies(k)
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), k=k, percent=percent, chunk=chunk, frequent=frequent).collect()
    assert sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in got) == brute_components(rows, k, percent)


def test_components_of_odd_rows(docs, no_docs):
    got = jaccard.jaccard_components(docs, k=4, percent=85).collect()
    want = brute_components([(i, t) for i, t in TEXTS if i is not None], 4, 85)
    assert sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in got if r.doc_id is not None) == want
    assert sorted(str(r.component_id) for r in got if r.doc_id is None) == ["1", "None"]
    assert jaccard.jaccard_components(no_docs).count() == 0


def test_deduplicate_keeps_columns_and_one_of_each_group(docs):
    kept = jaccard.deduplicate(docs, k=4, percent=85)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 1 in ids and 2 not in ids and 9 not in ids and {5, 6, 7, 8}.issubset(ids)


def test_deduplicate_of_repeated_rows_and_empty_tables(spark, docs, no_docs):
    text = prose(1, 60)
    d = spark.createDataFrame([(1, text, "a"), (1, text, "a"), (2, text, "b"), (3, prose(3, 60), "c"), (3, prose(4, 60), "d"), (None, text, "e"), (5, None, "f")], "doc_id long, text string, gone_id string")
    kept = jaccard.deduplicate(d)
    assert kept.columns == d.columns and sorted(r.gone_id for r in kept.collect()) == ["a", "a", "c", "d", "e", "f"]
    assert jaccard.deduplicate(no_docs).count() == 0 and jaccard.deduplicate(no_docs).columns == docs.columns


@pytest.mark.parametrize("labels", [False, True])
def test_search_connects_all_that_links(labels):
    rows = near_copies(9, groups=3, size=40)
    sets = [jaccard.shingles(t, 5) for _, t in rows]
    known = [i % 11 if labels and i % 2 else None for i in range(len(sets))]
    links = jaccard.search(sets, known, 80)
    up = {i: i for i in range(len(sets))}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        inter = len(np.intersect1d(sets[a], sets[b]))
        assert 100 * inter >= 80 * (len(sets[a]) + len(sets[b]) - inter) and root(a) != root(b)
        up[root(a)] = root(b)
    assert links
    for label in set(known) - {None}:
        same = [i for i in range(len(sets)) if known[i] == label]
        for i in same[1:]:
            up[root(i)] = root(same[0])
    for i in range(len(sets)):
        for j in range(i):
            inter = len(np.intersect1d(sets[i], sets[j]))
            if len(sets[i]) and 100 * inter >= 80 * (len(sets[i]) + len(sets[j]) - inter):
                assert root(i) == root(j)


def test_divide_skip_counts():
    r = random.Random(2)
    for _ in range(200):
        lists = [sorted(r.sample(range(30), r.randrange(0, 20))) for _ in range(r.randrange(1, 12))]
        need = r.randrange(1, 8)
        c = Counter(x for s in lists for x in s)
        assert sorted(jaccard.divide_skip(lists, need)) == sorted((x, n) for x, n in c.items() if n >= need)


def test_graph_components(spark, monkeypatch):
    monkeypatch.setattr(graph, "BROADCAST_ROWS", 0)
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (7, 7), (200, 199)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 103: 100, 199: 199, 200: 199}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- decontamination ---

ITEMS = [(1, prose(1, 60)), (2, "ONE two"), (3, None), (4, ""), (20, prose(4, 12)), (None, prose(10, 15)), (5, prose(1, 60))]


def brute_hits(rows, items):
    word, low = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), {c: c + 32 for c in range(65, 91)}
    windows = defaultdict(set)
    for i, t in items:
        w = word.findall((t or "").translate(low))
        for k in range(max(1, len(w) - 9)) if w else ():
            windows[tuple(w[k : k + 10])].add(i)
    out = []
    for d, t in rows:
        w, hit, found = word.findall((t or "").translate(low)), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])] - {None}
        names = ",".join(sorted(map(str, found)))
        out.append(str((d, len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit))))
    return sorted(out)


@pytest.mark.parametrize("part", [200_000, 7])
def test_hits_against_brute_force(spark, docs, no_docs, part):
    items = spark.createDataFrame([(*x, "c") for x in ITEMS], "item_id long, text string, window string")
    got = decontam.hits(docs, items, part_windows=part).collect()
    assert sorted(str(tuple(r)) for r in got) == brute_hits(TEXTS, ITEMS)
    assert decontam.hits(no_docs, items).count() == 0
    assert decontam.hits(docs, items.where("false")).where("contaminated").count() == 0


def test_parts_keep_rows_of_one_id_apart(spark):
    items = [(1, prose(1, 30)), (2, prose(3, 20))]
    rows = [(None, prose(1, 30)), (None, prose(50, 30)), (7, prose(3, 20)), (7, prose(60, 20)), (7, prose(3, 20)), (8, None), (8, "")]
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = brute_hits(rows, items)
    assert sum("True" in x for x in want) == 3
    assert sorted(str(tuple(r)) for r in decontam.hits(docs, bench, part_windows=7).collect()) == want


@pytest.mark.parametrize("part", [1, 3, 7])
def test_the_number_of_passes_changes_nothing(spark, part):
    items = [(1, prose(1, 20)), (2, prose(2, 12)), (3, "short item")]
    same = prose(70, 10) + " "
    rows = [(7, same + prose(1, 20)), (7, same + prose(71, 20)), (None, same + prose(1, 20)), (None, same + prose(72, 20)), (8, prose(1, 20)), (9, prose(2, 12) + " and a short item"), (10, None), (10, ""), (8, prose(1, 20))]
    docs = spark.createDataFrame([(i, t, f"x{k}") for k, (i, t) in enumerate(rows)], "doc_id long, text string, row string").selectExpr("*", "1 AS spans")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert sorted(str(tuple(r)) for r in decontam.hits(docs, bench, part_windows=part).collect()) == brute_hits(rows, items)
    for mode in ("documents", "spans"):
        whole, cut = (decontam.decontaminate(docs, bench, remove=mode, part_windows=n) for n in (200_000, part))
        assert whole.columns == cut.columns == docs.columns
        assert sorted(map(str, whole.collect())) == sorted(map(str, cut.collect()))
    left = {r.row: r.text for r in cut.collect()}
    assert left["x4"] == "" and left["x0"] == same and left["x1"] == rows[1][1] and left["x6"] is None


def test_empty_tables_stay_empty(spark, docs, no_docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    for mode in ("documents", "spans"):
        for part in (200_000, 3):
            assert decontam.decontaminate(no_docs, items, remove=mode, part_windows=part).count() == 0
        assert decontam.decontaminate(docs, items.where("false"), remove=mode).count() == len(TEXTS)
    assert pii.redact(no_docs).count() == 0


def test_decontaminate(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = decontam.decontaminate(docs, items)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= {5, 6, 7, 11, 13, 14} and kept.where("doc_id IN (1, 4, 8)").count() == 0
    spans = {r.doc_id: r.text for r in decontam.decontaminate(docs, items, remove="spans").collect()}
    assert len(spans) == len({i for i, _ in TEXTS}) and spans[8].strip() == "" and spans[5] is None and spans[3].endswith("changed")
    with pytest.raises(ValueError):
        decontam.decontaminate(docs, items, remove="words")


# --- personal data ---


def luhn(d):
    return sum(int(c) if i % 2 == 0 else 2 * int(c) - 9 * (int(c) > 4) for i, c in enumerate(reversed(d))) % 10 == 0


def brute_base(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 13 <= len(d := re.sub("[ -]", "", m[0])) <= 19 and luhn(d)]
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def odd_pii(n):
    r = random.Random(5)
    bits = ["a@b.c", "x.y@z-1.org.", "@", ".", "-", " ", "+1 (212) 555-0100", "+", "4111111111111111", "4111 1111 1111 1111", "10.0.0.1", "256.1.1.1", "001.02.3.4.5.6.7.8", "é", "😀", "\n", "7", "42", "_", "%", "@@", "a@b", "(", ")", "user", "1.2"]
    return ["".join(r.choice(bits) for _ in range(14)) for _ in range(n)]


def test_base_spans_against_brute_force(spark, docs, no_docs):
    texts = odd_pii(600) + [t for _, t in TEXTS] + ["9" * 20_000 + " " + "1-" * 9000 + "2", "a." * 20_000 + "@" + "b." * 5000 + "c"]
    rows = {r.doc_id: r for r in pii.spans(spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, _base string")).collect()}
    for i, t in enumerate(texts):
        base, r = brute_base(t or ""), rows[i]
        named = [f"{k}:{a}:{b}" for k, a, b in base]
        assert r.base_sha256 == hashlib.sha256(",".join(named).encode()).hexdigest(), repr(t)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == x for x, *_ in base) for k in pii.KINDS)
        assert set(named) <= set(r.spans.split(","))
    assert pii.spans(docs).count() == len(TEXTS) and pii.spans(no_docs).count() == 0


def test_added_spans(spark):
    texts = ["write to jane.doe (at) example (dot) org now", "card 555-3296 4524132264652876 was used", "call tel. 212-555-0100 today", "version 12.345.678 of v1", "sum 1234 5678 9012 in all", "on 12:30 to 12:45", "plain words only"]
    rows = pii.spans(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    added = [r.spans for r in rows]
    assert added[0].startswith("email:9:") and "card:14:30" not in added[3]
    assert [bool(a) for a in added[3:]] == [False] * 4


def luhn_card(r, first):
    d = first + "".join(r.choice("0123456789") for _ in range(14))
    return next(d + c for c in "0123456789" if luhn(d + c))


def planted(each):
    """Personal data in forms and contexts that the trees were not trained on, and look-alikes: (kind or None, text, start, end)."""
    r = random.Random(77)
    n = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    words = "the report was sent to our office before noon and nobody answered until friday because of weather in town".split()
    said = lambda k: " ".join(r.choice(words) for _ in range(k))
    name, site, end = (lambda: r.choice(["anna", "j.smith", "maria_lopez", "k99", "o-brien"])), (lambda: r.choice(["example", "uni-bonn", "mail.firm", "post.gov"])), (lambda: r.choice(["org", "de", "co.uk", "net", "io"]))
    forms = {
        "email": [lambda: f"{name()} (at) {site()}.{end()}", lambda: f"{name()}[at]{site()}.{end()}", lambda: f"{name()} [at] acme [dot] {r.choice(['org', 'com', 'de'])}", lambda: f"{name()} {{at}} {site()}.{end()}"],
        "ip": [lambda: ":".join(f"{r.randrange(65536):x}" for _ in range(8)), lambda: f"2001:db8:{r.randrange(1, 9999):x}:{r.randrange(1, 9999):x}:0:0:0:{r.randrange(1, 99):x}"],
        "card": [lambda: f"{n(3)}-{n(4)} {luhn_card(r, r.choice('345'))}"],
        "phone": [lambda: f"({n(3)}) 555-{n(4)}", lambda: f"{r.randrange(201, 989)}-{n(3)}-{n(4)}", lambda: f"{r.randrange(201, 989)}.{n(3)}.{n(4)}", lambda: f"020 {n(4)} {n(4)}", lambda: f"0044 {n(3)} {n(3)} {n(4)}"],
    }
    before = {"email": ["reach me under", "write to", "contact:", "his address is"], "ip": ["server", "traffic from", "host"], "card": ["paid with card", "visa"], "phone": ["call", "tel.", "phone:", "fax", "ring us on", "mobile"]}
    alike = [
        lambda: f"version {r.randrange(9)}.{n(2)}.{n(3)}.{n(4)}x", lambda: f"order {n(4)} {n(4)} {n(4)}", lambda: f"on 2024-0{r.randrange(1, 9)}-1{r.randrange(9)} at 12:30:45", lambda: f"pages {n(3)}-{n(3)}", lambda: "ratio 16:9:4:3 and 10:20:30",
        lambda: f"ISBN 978-{n(1)}-{n(4)}-{n(4)}-{n(1)}", lambda: f"$ {n(3)} {n(3)} {n(4)} in all", lambda: "meet at noon [at the office].", lambda: f"part no. {n(4)}-{n(3)}-{n(4)}",
    ]
    out = []
    for kind, fs in forms.items():
        for f in fs:
            for _ in range(each):
                x = f()
                t = f"{said(5)} {r.choice(before[kind]) if r.random() < 0.7 else said(2)} {x} {said(5)}."
                out.append((kind, t, t.index(x), t.index(x) + len(x)))
    return out + [(None, f"{said(5)} {f()} {said(5)}.", 0, 0) for f in alike for _ in range(each)]


def test_recall_and_precision_on_other_forms(spark):
    cases = planted(40)
    got = {r.doc_id: r for r in pii.spans(spark.createDataFrame([(i, c[1]) for i, c in enumerate(cases)], "doc_id long, text string")).collect()}
    spans_of = lambda i: [x.split(":") for x in got[i].spans.split(",") if x]
    hit = [any(int(e) > a and int(s) < b for _, s, e in spans_of(i)) for i, (k, _, a, b) in enumerate(cases) if k]
    wrong = [got[i].n_added for i, (k, *_) in enumerate(cases) if not k]
    assert np.mean(hit) >= 0.9 and sum(wrong) <= 0.02 * len(wrong)


def brute_added(text, trained, base):
    """The added spans by plain Python: all matches of the loose patterns that meet no base span, scored by the trees, the likelier first."""
    out = []
    for k, kind in enumerate(pii.KINDS):
        for m in re.finditer(pii.LOOSE[kind], text):
            a, b = m.span()
            if any(a < e and s < b for _, s, e in base):
                continue
            x, l, r = m[0], text[max(0, a - pii.CONTEXT) : a], text[b : b + pii.CONTEXT]
            d = re.sub("[^0-9]", "", x)
            letter = lambda c: bool(c) and c.isalpha()
            valid = {"ip": re.fullmatch(r"(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2}))(?:\.(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2}))){3}", x) is not None, "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15, "email": False}[kind]
            f = [
                k, len(d), len(x), len(re.findall("[0-9A-Za-z]+", x)), 12 <= len(d) <= 19 and luhn(d), valid, int(d[0]) if d else -1, x.startswith("+"), "(" in x, x.count(":"), bool(re.search(pii.HINTS[kind], l)),
                bool(re.search(r"[#$€£=v/][ ]?$", l)), letter(l[-1:]) or letter(r[:1]), bool(re.search(r"[0-9][ .-]?$", l) or re.search(r"^[ .-]?[0-9]", r)), max(1, len(set(d))), len(re.findall("[A-Za-z]", x)), len(re.search("[A-Za-z0-9]*$", x)[0]),
            ]
            v = np.array([f], float)
            p = pii._sigmoid(trained.a * sum(pii._apply(t, v)[0] for t in trained.trees) + trained.b)
            if p >= trained.thresholds[k]:
                out.append((-p, a, -b, kind))
    kept = []
    for _, a, b, kind in sorted(out):
        if not any(a < e and s < -b for _, s, e in kept):
            kept.append((kind, a, -b))
    return kept


def test_added_spans_against_brute_force(spark):
    texts = [c[1] for c in planted(6)] + [f"{a[1]} {b[1]}" for a, b in zip(planted(3), planted(3)[::-1])] + [t for t in odd_pii(200)] + [" ".join(c[1] for c in planted(8))]
    trained = pii.model(spark)
    rows = {r.doc_id: r for r in pii.spans(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    some = 0
    for i, t in enumerate(texts):
        base = brute_base(t)
        added = brute_added(t, trained, base)
        some += len(added)
        want = sorted((pii.KINDS.index(k), a, b) for k, a, b in base + added)
        assert rows[i].spans == ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in want), repr(t)
    assert some > 100


def test_spans_beyond_a_block(spark):
    t = " ".join(f"a{i}@x.org or tel. 212-555-{i % 10000:04d}" for i in range(3 * pii.BLOCK))
    r = pii.spans(spark.createDataFrame([(1, t)], "doc_id long, text string")).first()
    got = [x.split(":") for x in r.spans.split(",")]
    assert r.n_email == 3 * pii.BLOCK and all(t[int(a) : int(b)] == f"a{i}@x.org" for i, (k, a, b) in enumerate(x for x in got if x[0] == "email"))
    assert r.n_added == 3 * pii.BLOCK and all(t[int(a) : int(b)] == f"212-555-{i % 10000:04d}" for i, (k, a, b) in enumerate(x for x in got if x[0] == "phone"))


def test_redact(docs):
    out = {r.doc_id: r for r in pii.redact(docs).collect()}
    assert out[14].text == "mail [EMAIL] or [IP], card [CARD], tel [PHONE]." and out[14].n_chars == len(out[14].text)
    assert out[5].text is None and out[1].text == dict(TEXTS)[1] and pii.redact(docs).columns == docs.columns


# --- quality ---


def test_quality_tells_prose_from_junk(spark):
    rows, labels = [], []
    for i in range(400):
        good = i % 3 > 0
        t = prose(i, 50) + "." if good else " ".join(w.upper() + "!!" for w in prose(i, 50).split())
        rows.append((i, t, "en", 1.0))
        labels.append((i, int(good), 0))
    d, l = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in ranker.quality(d, l).collect()}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in got)
    held = [i for i in got if got[i].held_out]
    assert np.mean([got[i].predicted == (i % 3 > 0) for i in held]) > 0.97
    assert all((got[i].score >= 0.7) == bool(got[i].predicted) and 0 <= got[i].score <= 1 for i in got)
    again = {r.doc_id: r.score for r in ranker.quality(d.repartition(3), l.repartition(5)).collect()}
    assert all(abs(again[i] - got[i].score) < 1e-9 for i in got)


def brute_features(text):
    """The ranker's features, worked out character by character and word by word."""
    raw = list((text or "").encode())
    words = bytes(raw).split()
    if not words:
        return [float(n == "empty") for n in ranker.NAMES]
    symbols = set(b"#$%&*+/<=>@[\\]^_`{|}~")
    n = max(1, sum(c not in b" \n" for c in raw))
    k = len(words)
    letters = max(1, n - sum(c in symbols or c in b"0123456789!?.,;:'\"()-" for c in raw))
    upper, lower = sum(65 <= c <= 90 for c in raw) / letters, sum(97 <= c <= 122 for c in raw) / letters
    lines = [x for x in bytes(raw).split(b"\n") if x.strip()]
    badness = [sum(c in symbols or c == 33 for c in x) / len(x) + max(0, sum(65 <= c <= 90 for c in x) / len(x) - 0.3) for x in lines]
    stops = sum(bytes(raw[i : i + 2]) in (b". ", b".\n") for i in range(len(raw)))
    return [
        min(1, 10 * sum(c in symbols and c != 124 for c in raw) / n), min(1, 10 * sum(c == 124 for c in raw) / n), min(1, 10 * sum(c == 33 for c in raw) / n),
        upper, sum(48 <= c <= 57 for c in raw) / n, sum(len(x) for x, b in zip(lines, badness) if b > 0.03) / len(raw),
        min(1, 5 * max([b for x, b in zip(lines, badness) if len(x) >= 40], default=0)), 1 - len(set(lines)) / len(lines), sum(words[i] == words[i + 1] for i in range(k - 1)) / k,
        max(0, 1 - len(set(words)) / min(k, 40 + k**0.85)), sum(chr(w[-1]) in ".,;:" or w[-1] >= 128 or chr(w[-1]).isalpha() for w in words) / k,
        min(1, n / k / 20), sum(len(w) > 20 for w in words) / k, 1 / (1 + k / 10), min(1, 5 * stops / k), 0, min(1, np.log(1 + k) / 12), max(0, 0.6 - lower),
    ]


def brute_scores(rows, labels):
    """Bradley-Terry scores by plain gradient ascent on all pairs."""
    x = np.array([brute_features(t) for _, t in rows], float)
    at = {i: k for k, (i, _) in enumerate(rows)}
    train = [(at[i], q) for i, q in labels if i in at and zlib.crc32(str(i).encode()) % 4 != 2]
    sample, y = x[[k for k, _ in train]], np.array([q for _, q in train])
    mean, scale = sample.mean(axis=0), sample.std(axis=0) + 1e-9
    z = (sample - mean) / scale
    d = np.array([g - b for g in z[y == 1] for b in z[y == 0]])
    w = np.zeros(x.shape[1])
    rate = 1 / (np.linalg.eigvalsh(d.T @ d / len(d)).max() / 4 + ranker.RIDGE)
    for _ in range(60_000):
        step = d.T @ (1 - 1 / (1 + np.exp(-d @ w))) / len(d) - ranker.RIDGE * w
        w += rate * step
        if np.abs(step).max() < 1e-10:
            break
    s = z @ w
    places = np.linspace(0.002, 0.998, 499)
    best = max(range(499), key=lambda i: (round(((s >= np.quantile(s, places[i])) == (y == 1)).mean() + 1e-9 * (s[y == 1] >= np.quantile(s, places[i])).mean(), 12), -i))
    c = np.quantile(s, places[best])
    cut = (s[s < c].max(initial=s.min()) + s[s >= c].min(initial=s.max())) / 2
    all_s = ((x - mean) / scale) @ w
    return 1 / (1 + np.exp(-((all_s - cut) / s[y == 1].std() + np.log(7 / 3))))


def test_scores_against_brute_force(spark):
    r = random.Random(8)
    rows = [(i, t) for i, t in TEXTS if i is not None and i not in (10, 12)] + [(12, prose(4, 80))]
    for i in range(100, 190):
        good = r.random() < 0.6
        t = prose(i, r.randrange(5, 60)) + "."
        if not good and r.random() < 0.8:
            t = r.choice((t.upper(), t.replace(" ", " $ "), (t + "\n") * 4, t.replace(" ", " | ") + "!!"))
        rows.append((i, t))
    labels = [(i, int(r.random() < 0.1 or not set(t or "") & set("$|!\n")) if t else 0) for i, t in rows]
    got = {x.doc_id: x.score for x in ranker.quality(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")).collect()}
    for (i, _), want in zip(rows, brute_scores(rows, labels)):
        assert abs(got[i] - want) < 2e-4, (i, got[i], want)


def test_all_labelled_rows_and_all_pairs_are_learnt_from(spark):
    r = random.Random(12)
    rows = []
    for i in range(8340):
        t = f"w{i} " + prose(i, r.randrange(3, 9)) + "."
        rows.append((i, t.replace(" ", " $ ", r.randrange(4)).upper() if i < 40 or r.random() < 0.05 else t))
    x, y = np.array([ranker.features(t) for _, t in rows]), np.array([int(i >= 40) for i, _ in rows])
    z = (x - x.mean(axis=0)) / (x.std(axis=0) + 1e-9)
    d = (z[y == 1][:, None] - z[y == 0][None, :]).reshape(-1, z.shape[1])
    w = np.zeros(z.shape[1])
    for _ in range(12):
        p = 1 / (1 + np.exp(-d @ w))
        w += np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d / len(d) + ranker.RIDGE * np.eye(len(w)), d.T @ (1 - p) / len(d) - ranker.RIDGE * w)
    s = z @ w
    cuts = np.quantile(s, np.linspace(0.002, 0.998, 499))
    c = cuts[np.argmax([((s >= c) == (y == 1)).mean() + 1e-9 * (s[y == 1] >= c).mean() for c in cuts])]
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(list(enumerate(y.tolist())), "doc_id long, quality int")
    for size in (ranker.BLOCK, 500):
        got = ranker.train(docs.repartition(3), labels, block=size)
        assert np.abs(got.w - w).max() < 1e-6 and abs(got.slope * s[y == 1].std() - 1) < 1e-6
        assert abs(got.cut - (s[s < c].max() + s[s >= c].min()) / 2) < 1e-5
    again = ranker.train(docs.repartition(7), labels.repartition(5), block=500)
    assert (again.w == got.w).all() and (again.cut, again.slope) == (got.cut, got.slope)


def test_a_long_line_is_one_line():
    line = "abc " * 65_536
    assert ranker.features(line) == pytest.approx(brute_features(line)) and ranker.features(line)[ranker.NAMES.index("repeated_lines")] == 0


def test_repeated_ids_are_one_example(spark):
    d = spark.createDataFrame([(i, prose(i, 20)) for i in range(12)] + [(1, prose(99, 20))] * 300, "doc_id long, text string")
    l = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, quality int")
    once = spark.createDataFrame([(i, prose(i, 20)) for i in range(12)] + [(1, prose(99, 20))], "doc_id long, text string")
    assert (ranker.train(d, l).w == ranker.train(once, l).w).all()


def test_keep_good_of_odd_rows(spark, docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (4, 1), (10, 1), (13, 0), (6, 0), (14, 0)], "doc_id long, quality int")
    ranks = ranker.train(docs, labels)
    kept = ranker.keep_good(docs, ranks)
    want = [i for i, t in TEXTS if ranks.scores(np.array([ranker.features(t)]))[0] >= 0.7]
    assert kept.columns == docs.columns and sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(map(str, want)) and len(want) not in (0, len(TEXTS))
    assert ranker.keep_good(no_docs, ranks).count() == 0


def test_labels_of_held_out_rows_are_not_used(spark):
    rows = [(i, prose(i, 20), int(i % 2)) for i in range(60)]
    d = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    l = spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int")
    flipped = spark.createDataFrame([(i, 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q) for i, _, q in rows], "doc_id long, quality int")
    a, b = ({r.doc_id: r.score for r in ranker.quality(d, x).collect()} for x in (l, flipped))
    assert a == b


def test_quality_of_odd_rows(spark, docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (4, 1), (13, 0), (None, 0), (8, None), (9, 7)], "doc_id long, quality int")
    got = ranker.quality(docs, labels).collect()
    assert len(got) == len(TEXTS) and all(0 <= r.score <= 1 for r in got)
    assert ranker.quality(no_docs, labels).count() == 0
    assert {r.score for r in ranker.quality(docs, labels.where("false")).collect()} == {ranker.quality(docs, labels.where("false")).first().score}


# --- top k ---


def test_top_k_against_brute_force(spark):
    r = np.random.default_rng(4)
    rows = [(i, [float(x) for x in r.normal(size=8)], "c", 1) for i in range(300)]
    rows += [(300, None, "c", 1), (301, [1.0, None] * 4, "c", 1), (302, [float("nan")] * 8, "c", 1), (303, [float("inf")] * 8, "c", 1), (305, [], "c", 1), (None, [1.0] * 8, "c", 1), (310, [1.0, 2.0], "c", 1), (20, rows[20][1], "c", 1)] + [(320 + i, [0.5] * 8, "c", 1) for i in range(41)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank string, score int")
    x = {i: np.floor(np.array(v) * 64) for i, v, *_ in rows if i is not None and v and len(v) == 8 and None not in v and np.isfinite(v).all()}
    want = []
    for q in [i for i in x if i % 20 == 0]:
        best = sorted((-int(x[q] @ x[c]), c) for c in x if c != q)[:20]
        want += [(q, k + 1, c, -s) for k, (s, c) in enumerate(best)]
    for sizes in ({}, {"query_block": 4, "candidate_block": 90}):
        got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in nra.top_k(df, **sizes).collect()]
        assert sorted(got) == sorted(want)
    assert nra.top_k(df.where("false")).count() == 0


class Counted(nra.Lists):
    """Lists that note which places are read; nothing else of the vectors is kept."""

    def __init__(self, x):
        super().__init__(x)
        self.reads = []

    def lowest(self, a, b):
        self.reads.append(("lowest", a, b))
        return super().lowest(a, b)

    def highest(self, a, b):
        self.reads.append(("highest", a, b))
        return super().highest(a, b)


@pytest.mark.parametrize("alike", [True, False])
def test_lists_are_read_in_order_and_no_further_than_needed(alike):
    r = np.random.default_rng(0)
    x = np.rint(r.pareto(2, size=(2000, 1)) * 90 * alike + r.normal(size=(2000, 6)) * 9)
    q = np.rint(np.abs(r.normal(size=(3, 6))) * 5 + 1) if alike else np.rint(r.normal(size=(3, 6)) * 5)
    lists = Counted(x)
    i, j, s, depth = nra.search(q, np.full(3, -1), lists, np.arange(2000), 20)
    for n in range(3):
        best = np.sort(x @ q[n])[-20:]
        assert sorted(s[i == n])[-20:] == best.tolist() and (s[i == n] == x[j[i == n]] @ q[n]).all()
    for side in ("lowest", "highest"):
        places = [(a, b) for name, a, b in lists.reads if name == side][1:]  # the first states the list's far end
        assert places[0][0] == 0 and all(b == c for (_, b), (c, _) in zip(places, places[1:]))
        assert places[-1][1] == round(depth.max() * 2000)
    assert not alike or depth.max() <= 0.25
    # a query is done only when its members' scores are read, and not a step later
    for n in range(3):
        steps = [d for d in nra.DEPTHS if d < depth[n]]
        early = nra.search(q[n : n + 1], np.full(1, -1), nra.Lists(x), np.arange(2000), 20, depths=tuple(steps))
        assert len(early[0]) == 0


def test_ties_at_the_last_place_and_rows_of_one_id(spark):
    rows = [(0, [1.0, 0.0])] + [(100 + i, [2.0, float(i)]) for i in range(5)] + [(200 - i, [1.0, 0.5]) for i in range(40)]
    rows += [(300, [3.0, float(i)]) for i in range(30)] + [(300, [0.5, 0.0]), (301, [2.0, 0.0]), (301, [-1.0, 0.0])]
    got = nra.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=20, candidate_block=64).where("query_id = 0").orderBy("rank").collect()
    want = [(300, 3 * 64 * 64)] + [(i, 2 * 64 * 64) for i in (100, 101, 102, 103, 104, 301)] + [(161 + i, 64 * 64) for i in range(13)]
    assert [(r.vec_id, r.score) for r in got] == want


def test_copies_of_the_queries_never_pass_the_driver(spark):
    r = np.random.default_rng(6)
    df = spark.createDataFrame([(i, [float(x) for x in r.normal(size=4)]) for i in range(300)], "vec_id long, embedding array<double>")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        out = nra.top_k(df, candidate_block=100)
        assert out.count() == 300
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    # three blocks of candidates are three places, for each of which the queries are copied
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan and "xxhash64(ids#" in plan and ", 42), 3) AS salt" in plan
