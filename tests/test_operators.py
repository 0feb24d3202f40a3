"""Operators on small frames whose answers are worked out by hand or by plain Python."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rostrum.operators import aggregates, attention, checks, cleaning, entities, history, network, relational, sequences, stats, textmining, topics, turns, wording
from rostrum.functions import strings as S


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()] if order else sorted(tuple(r) for r in df.collect())


# --- relational ---


def test_fusion_takes_the_first_source_that_has_a_field(spark):
    a = spark.createDataFrame([(1, "a1", None), (2, None, "x")], "k int, name string, lang string")
    b = spark.createDataFrame([(1, "b1", "en"), (3, "b3", None)], "k int, name string, lang string")
    got = rows(relational.fuse({"a": a, "b": b}, ["k"], {"name": [("a", "name"), ("b", "name")], "lang": [("b", "lang"), ("a", "lang")]}), "k")
    assert got == [(1, "a1", "a", "en", "b", True, True), (2, None, None, "x", "a", True, False), (3, "b3", "b", None, None, False, True)]


def test_as_of_is_strict_within_reach_and_deterministic(spark):
    left = spark.createDataFrame([(1, 5), (1, 10), (2, 3)], "k int, at int")
    right = spark.createDataFrame([(1, 5, "same"), (1, 4, "b"), (1, 4, "a"), (2, -100, "far")], "k int, at2 int, v string")
    got = rows(relational.as_of(left, right, ["k"], "at", "at2", ["v"], within=50, order=["v"]), "k", "at")
    assert got == [(1, 5, "b"), (1, 10, "same"), (2, 3, None)]
    loose = rows(relational.as_of(left, right, ["k"], "at", "at2", ["v"], strict=False, order=["v"]), "k", "at")
    assert loose == [(1, 5, "same"), (1, 10, "same"), (2, 3, "far")]


def walk(spark, *days, autumn=2):
    return spark.createDataFrame([(1, n, d, s, n >= autumn) for n, d, s in days], "k int, n int, debate boolean, special boolean, autumn boolean")


def test_debate_span_drops_a_stray_mention(spark):
    days = [(n, n in (3, 14, 15, 17, 18), n == 16) for n in range(1, 40)]
    assert [r[1] for r in rows(relational.debate_span(walk(spark, *days), ["k"]), "n")] == [14, 15, 17, 18]


def test_debate_span_keeps_a_last_small_island(spark):
    days = [(n, n == 5, False) for n in range(1, 9)]
    assert [r[1] for r in rows(relational.debate_span(walk(spark, *days), ["k"]), "n")] == [5]


def test_running_end(spark):
    m = spark.createDataFrame([(1, n, 60 if n < 3 else 0, True) for n in range(1, 9)], "k int, n int, speeches int, found boolean")
    assert [r.n for r in relational.running_end(m, ["k"]).orderBy("n").collect()] == [1, 2, 3, 4]


def test_round_robin_and_transitions(spark):
    d = spark.createDataFrame([("k", g, i) for g, i in (("a", 1), ("a", 2), ("a", 3), ("b", 4), ("c", 5))], "k string, g string, i int")
    assert [r.i for r in relational.round_robin(d, ["k"], "g", [F.col("i")], 4).orderBy("pick").collect()] == [1, 4, 5, 2]
    t = spark.createDataFrame([(1, 2020, "x"), (1, 2021, "y"), (1, 2023, "x")], "k int, y int, s string")
    assert rows(relational.transitions(t, ["k"], "y", "s")) == [("x", "y", 1)]


# --- histories ---


def test_scd2_batch(spark):
    cols = "k string, v string, note string, valid_from string, valid_to string, is_current boolean, last_checked string"
    h = spark.createDataFrame([("a", "1", "n", "d1", None, True, "d1"), ("b", "1", "n", "d1", None, True, "d1"), ("c", "1", None, "d1", None, True, "d1"), ("b", "0", None, "d0", "d1", False, "d1")], cols)
    b = spark.createDataFrame([("a", "1", None), ("b", "2", "m"), ("d", None, "z"), ("b", "2", "m")], "k string, v string, note string")
    got = rows(history.apply_batch(h, b, "k", ["v"], F.lit("d2"), ["note"]), "k", "valid_from")
    assert got == [
        ("a", "1", "n", "d1", None, True, "d2"), ("b", "0", None, "d0", "d1", False, "d1"), ("b", "1", "n", "d1", "d2", False, "d1"), ("b", "2", "m", "d2", None, True, "d2"),
        ("c", "1", None, "d1", None, True, "d1"), ("d", None, "z", "d2", None, True, "d2"),
    ]


def test_history_from_log_never_overlaps(spark):
    log = spark.createDataFrame([(1, t, v) for t, v in enumerate("aabbbacca")], "k int, t int, v string")
    got = rows(history.from_log(log, "k", "t", ["v"]), "valid_from")
    assert [(r[1], r[2], r[3]) for r in got] == [("a", 0, 2), ("b", 2, 5), ("a", 5, 6), ("c", 6, 8), ("a", 8, None)]


# --- aggregates and attention ---


def test_gini(spark):
    d = spark.createDataFrame([(x,) for x in (1.0, 1.0, 1.0, 1.0)], "v double")
    assert abs(aggregates.lorenz(d, "v").first().gini) < 1e-12
    e = spark.createDataFrame([(x,) for x in (0.0, 0.0, 0.0, 8.0)], "v double")
    assert aggregates.lorenz(e, "v").first().gini == pytest.approx(0.75)


def test_panel_and_attention(spark):
    o = spark.createDataFrame([("x", "o1", 30.0, 5, 1), ("x", "o2", 10.0, 900, 1), ("x", "o3", None, 99, 9), ("y", "o4", None, 10, 1), ("y", "o5", None, 10, 2)], "country string, outlet string, reach double, words int, reports int")
    p = attention.panel(o)
    assert rows(p.select("outlet", "weight", "rule")) == [("o1", 0.75, "reach"), ("o2", 0.25, "reach"), ("o5", 1.0, "most words")]
    m = spark.createDataFrame([("o1", "A", 6), ("o1", "B", 2), ("o2", "B", 4), ("o5", "A", 30), ("o5", "y", 5)], "outlet string, subject string, n int")
    own = spark.createDataFrame([("y", "y")], "country string, subject string")
    v = attention.country_views(m, p, own)
    assert rows(v) == [("x", "A", 0.5625, 12), ("x", "B", 0.4375, 12), ("y", "A", 1.0, 30)]
    a = dict(rows(attention.attention(v)))
    assert a == {"A": 0.78125, "B": 0.21875} and sum(a.values()) == 1


def test_share_is_null_unless_enough_is_known(spark):
    d = spark.createDataFrame([(1, "a"), (1, None), (1, None), (2, "a"), (2, "b")], "y int, r string")
    got = rows(aggregates.share_if_known(d, ["y"], F.col("r") == "a", F.col("r").isNotNull()), "y")
    assert got == [(1, None, 3), (2, 0.5, 2)]


# --- text mining ---


def test_tfidf_rows_have_length_one_and_cosine_pairs_lose_none(spark):
    r = np.random.default_rng(3)
    texts = [[f"w{j}" for j in r.integers(0, 25, 12)] for _ in range(60)]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc int, w array<string>")
    w = textmining.tfidf(d, "doc", F.col("w"), min_df=1, max_df=1.0)
    full = {}
    for x in w.collect():
        full.setdefault(x.doc, {})[x.token] = x.weight
    assert all(math.isclose(sum(v * v for v in row.values()), 1) for row in full.values())
    want = {(a, b) for a in full for b in full if a < b and sum(v * full[b].get(t, 0) for t, v in full[a].items()) >= 0.5}
    assert {(x.a, x.b) for x in textmining.cosine_pairs(w, "doc", 0.5).collect()} == want and want


def test_pairs_and_nearest_over_several_blocks(spark):
    """All pairs and each row's nearest, over blocks, dense and other columns and laid-out parts that are small, equal brute force; copies tie, the larger id first."""
    from rostrum.operators import blocks

    r = np.random.default_rng(5)
    x = r.random((47, 40)) * (r.random((47, 40)) < 0.2)
    x[30:34] = x[3]
    x[:, 0] += 0.05
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    entries = [(f"d{i:03}", f"t{j}", float(x[i, j])) for i in range(47) for j in range(40) if x[i, j]]
    w = spark.createDataFrame(entries, "doc string, token string, weight double").repartition(3)
    s = x @ x.T
    sizes = {"rows": 5, "dense": 4}
    got = {(p.a, p.b): p.similarity for p in blocks.pairs_at_least(w, "doc", 0.3, **sizes).collect()}
    want = {(f"d{i:03}", f"d{j:03}"): s[i, j] for i in range(47) for j in range(i + 1, 47) if s[i, j] >= 0.3}
    assert got.keys() == want.keys() and len(want) > 20 and all(abs(got[k] - want[k]) < 1e-12 for k in want)
    order = Window.partitionBy("doc").orderBy(F.desc(F.round("similarity", 9)), F.desc("other"))
    near = blocks.nearest_rows(w, "doc", 0.3, 3, **sizes).withColumn("place", F.row_number().over(order)).where("place <= 3")
    best = {f"d{i:03}": [f"d{j:03}" for j in sorted((j for j in range(47) if j != i and s[i, j] >= 0.3), key=lambda j: (-round(s[i, j], 9), -j))[:3]] for i in range(47)}
    assert {(n.doc, n.place): n.other for n in near.collect()} == {(d, k + 1): o for d, others in best.items() for k, o in enumerate(others)}
    held, _ = blocks.packed(w, "doc", **sizes)
    a, b = (blocks.Loaded(y, held.dense) for y in held.blocks[:2])
    assert np.allclose(blocks.product(a, b, products=3), s[:5, 5:10]) and np.allclose(blocks.product(a, a), s[:5, :5])
    i, j, v = blocks.reaching(a, b, 0.2, products=3)
    assert set(zip(i, j)) == set(zip(*np.nonzero(s[:5, 5:10] >= 0.2))) and np.allclose(v, s[:5, 5:10][i, j])


def test_pairs_of_nothing(spark):
    w = spark.createDataFrame([], "doc long, token string, weight double")
    assert textmining.cosine_pairs(w, "doc", 0.5).count() == textmining.nearest(w, "doc", 0.5).count() == 0


def test_shingle_agreement(spark):
    d = spark.createDataFrame([("a b c d e f", "b c d e f g h"), ("a b", "a b c d e f"), (None, "x")], "x string, y string")
    assert [r[0] for r in d.select(textmining.shingle_agreement(F.col("x"), F.col("y"))).collect()] == [0.5, None, None]


def test_evidence_is_an_exact_part(spark):
    text = "Climate. " + "We act now on the warming seas together with all. " + "x " * 200 + "Then climate again."
    r = textmining.first_evidence(spark.createDataFrame([(1, text), (2, "none here")], "i int, t string"), "i", F.col("t"), "(?i)climate", S.SENTENCE).collect()
    assert len(r) == 1 and r[0].text in text and r[0].text.startswith("Climate. We act") and not r[0].cut_start


def test_names_and_mentions(spark):
    n = spark.createDataFrame([("Bolivia (Plurinational State of)", "BOL"), ("Guinea", "GIN"), ("Papua New Guinea", "PNG"), ("Nowhere", "")], "name string, code string")
    table = entities.name_table(n, spark.createDataFrame([("Turkey", "TUR"), ("guinea", "OLD")], "name string, code string"))
    assert dict(rows(table)) == {"bolivia plurinational state of": "BOL", "plurinational state of bolivia": "BOL", "bolivia": "BOL", "guinea": "GIN", "papua new guinea": "PNG", "turkey": "TUR"}
    t = spark.createDataFrame([(1, "President of the Plurinational State of Bolivia"), (2, "Papua New Guinea"), (3, "Guinea and more"), (4, None)], "i int, t string")
    assert [(r.i, r.code) for r in entities.resolve_suffix(t, "i", "t", table).orderBy("i").collect()] == [(1, "BOL"), (2, "PNG"), (3, None), (4, None)]
    assert [(r.i, r.code) for r in entities.find_within(t, "i", "t", table).orderBy("i").collect()] == [(1, "BOL"), (2, "PNG"), (3, "GIN"), (4, None)]
    m = entities.mentions(spark.createDataFrame([(1, "Papua New  Guinea, the Gulf of Guinea, Guinea-Bissau and GUINEA.")], "i int, t string"), "i", F.col("t"), {"Guinea": "GIN", "Papua New Guinea": "PNG", "gulf of guinea": ""})
    assert rows(m) == [(1, "GIN", 1), (1, "PNG", 1)]


def test_delivered_and_shared_passage(spark):
    d = spark.createDataFrame([("we want peace now", "[Auto]\nWe want peace, friends", "en"), ("", "x", "en"), ("和平", "和平！", "zh")], "f string, s string, l string")
    assert rows(sequences.delivered(d, "f", "s", "l").select("delivered", "unscripted")) == [(0.0, 0.0), (0.75, 0.25), (1.0, 0.0)]
    p = sequences.shared_passage(spark.createDataFrame([("so We, the peoples of all lands!", "then we the peoples met")], "a string, b string"), "a", "b").first()
    assert (p.passage, p.n_words) == ("We, the peoples", 3)


def test_cleaning(spark):
    d = spark.createDataFrame([
        ("Header\nPlease check against delivery\nWe are in a well-\nknown place with co­oper‐\nation here.\n2\nHeader\nNext one starts.\nHeader\nnot this", "statement"),
        ("Title line\n[Auto-generated]\nThe Assembly will hear an address.\nDear friends,\nwe meet.\n" + "And more.\n" * 9 + "I thank the President for his statement.", "transcript"), (None, "statement")], "t string, k string")
    got = [r.clean for r in cleaning.clean(d, "t", "k").collect()]
    assert got[0] == "We are in a well-known place with co­operation here.\n\nNext one starts. not this"
    assert got[1] == "Dear friends, we meet." + "\n\nAnd more." * 9 and got[2] == ""


# --- networks and statistics ---


def two_groups(spark):
    e = [(a, b) for g in (0, 6) for a, b in ((0, 1), (1, 2), (2, 3), (3, 4), (4, 5), (5, 0))for a, b in [(a + g, b + g)]] + [(0, 6)]
    return spark.createDataFrame([(a, b, 1) for a, b in e], "src long, dst long, weight long"), spark.createDataFrame([(i, "x" if i < 6 else "y") for i in range(12)], "node long, label string")


def test_same_label_share_and_homophily(spark):
    e, l = two_groups(spark)
    assert network.same_label_share(e, l).first().share == pytest.approx(12 / 13)
    h = network.homophily(e, l, draws=200).first()
    assert h.observed == pytest.approx(12 / 13) and h.ratio > 1.5 and h.p < 0.01
    assert network.homophily(e, l, draws=200).first() == h


def test_communities_and_modularity(spark):
    e, _ = two_groups(spark)
    u = network.undirected(e)
    c = network.communities(u)
    q = network.modularity(u, c).first().modularity
    assert 0.3 < q < 1 and c.count() == 12


def test_betweenness_of_a_path(spark):
    e = spark.createDataFrame([(0, 1), (1, 2), (2, 3)], "src long, dst long")
    got = dict(rows(network.betweenness(e, spark.createDataFrame([(9,)], "node long")).select("node", F.round("betweenness", 6))))
    assert got == {0: 0.0, 1: round(2 / 12, 6), 2: round(2 / 12, 6), 3: 0.0, 9: 0.0}


def test_degrees_mutual_rand(spark):
    e = network.clean_edges(spark.createDataFrame([(1, 2), (2, 1), (1, 1), (1, 3), (1, 3)], "a int, b int"), "a", "b")
    assert rows(e) == [(1, 2, 1), (1, 3, 2), (2, 1, 1)] and rows(network.mutual_pairs(e)) == [(1, 2)]
    assert rows(network.degrees(e)) == [(1, 1, 2), (2, 1, 1), (3, 1, 0)]
    d = spark.createDataFrame([(i, i % 2, (i % 2) * 7) for i in range(8)], "i int, a int, b int")
    assert network.rand_index(d, "a", "b").first().ari == 1.0


def test_exact_tests():
    assert stats.fisher_p(8, 2, 1, 5) == pytest.approx(0.034965, abs=1e-6)
    assert stats.binomial_p(7, 10, 0.5) == pytest.approx(0.34375)
    assert stats.chi2_tail(3.841459, 1) == pytest.approx(0.05, abs=1e-6) and stats.chi2_tail(18.307, 10) == pytest.approx(0.05, abs=1e-4)


def test_chi_square_with_yates(spark):
    d = spark.createDataFrame([(a, b) for a, b, n in ((0, 0, 10), (0, 1, 20), (1, 0, 30), (1, 1, 5)) for _ in range(n)], "a int, b int")
    r = stats.chi_square(d, "a", "b").first()
    assert (r.dof, r.n) == (1, 65) and r.chi2 == pytest.approx(16.5785, abs=1e-3) and r.p < 0.001


def test_bootstrap_is_stable(spark):
    d = spark.createDataFrame([("g", i, float(i % 10)) for i in range(400)], "g string, i long, v double")
    a, b = (stats.bootstrap_mean(x, ["g"], "i", "v", draws=100).first() for x in (d, d.repartition(7)))
    assert a == b and a.low < a.mean < a.high


def test_topics_and_blocs():
    x = np.kron(np.eye(3), np.ones((5, 4))) + 0.01
    w, h = topics.nmf(x, 3)
    assert np.abs(x - w @ h).max() < 0.1 and len({tuple((w[i] == w[i].max()).tolist()) for i in (0, 5, 10)}) == 3
    labels = topics.ward(x + np.random.default_rng(0).normal(0, 0.01, x.shape), 3)
    assert [sorted(np.flatnonzero(labels == k).tolist()) for k in range(3)] == [list(range(5)), list(range(5, 10)), list(range(10, 15))]
    assert topics.assign_labels([["sea", "ice"], ["war", "army"], ["x", "y", "z"]], {"Peace": ["war"], "Climate": ["ice", "sea"]}) == ["Climate", "Peace", "x, y, z"]


# --- wording ---

SAID = [
    ("Russia must end its war of aggression against Ukraine.", "blames Russia or calls it aggression"), ("We call for peace in Ukraine.", "names Ukraine but blames no one"), ("The Kyiv regime glorifies neo-Nazis in Ukraine.", "uses Russia's framing"),
    ("The war between Russia and Ukraine must end.", "names Ukraine but blames no one"), ("The so-called special military operation in Ukraine is a Russian invasion.", "blames Russia or calls it aggression"), ("Our seas are rising.", "does not mention Ukraine"),
]
GAZA = [
    ("What happens in Gaza is genocide.", "calls it genocide"), ("Israel has killed thousands in Gaza.", "criticises Israel's conduct"), ("We condemn the attack by Hamas. Gaza suffers.", "blames Hamas or defends Israel"),
    ("We condemn the attack by Hamas. Israel has killed civilians in Gaza.", "criticises both sides"), ("We want a ceasefire in Gaza.", "blames neither side"), ("Our seas are rising.", "does not mention Gaza or Palestine"),
    ("The Holocaust was a genocide. We pray for Gaza.", "blames neither side"), ("Israelis were killed by Hamas. Gaza must be rebuilt.", "blames neither side"),
]


def test_two_wars(spark):
    d = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(SAID)], "i int, t string")
    assert [r["class"] for r in wording.ukraine(d, "i", "t").orderBy("i").collect()] == [c for _, c in SAID]
    g = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(GAZA)], "i int, t string")
    got = wording.gaza(g, "i", "t").orderBy("i").collect()
    assert [r["class"] for r in got] == [c for _, c in GAZA]
    assert all(r.evidence in t for r, (t, _) in zip(got, GAZA))


def test_passages_and_draws(spark):
    d = spark.createDataFrame([(1, "A one. B two. C Gaza. D four. E five. F six. G seven. H Gaza.")], "i int, t string")
    assert wording.passage(d, "i", F.col("t"), "Gaza", 1).first().passage == "B two.\n>> C Gaza.\nD four.\n...\nG seven.\n>> H Gaza."
    pool, seen = spark.range(50), spark.range(10)
    a = {r.id for r in wording.draw(pool, seen, ["id"], 20).collect()}
    assert len(a) == 20 and min(a) >= 10 and a == {r.id for r in wording.draw(pool.repartition(3), seen, ["id"], 20).collect()}


# --- turns ---


def test_scanned_turns(spark):
    body = "word " * 30
    text = (
        f"AGENDA ITEM 9\nGeneral debate\nThe PRESIDENT: I call on Spain.\nMr. LOPEZ (Spain) (interpretation from Spanish): {body}\nADDRESS BY MR. JOHN DOE, PRESIDENT OF PERU\nPresident DOE (interpretation from Spanish): {body}\n"
        f"AGENDA ITEM 12\nBudget (continued)\nMr. SMITH (Canada): {body}\nThe meeting rose at 1 p.m."
    )
    got = turns.scanned_turns(spark.createDataFrame([(1, text), (2, f"\nMr. A (Chad): {body}")], "m int, t string"), "m", "t", least_words=20).orderBy("m", "n").collect()
    assert [(r.m, r.n, r.name, r.country) for r in got] == [(1, 1, "Mr. LOPEZ", "Spain"), (1, 2, "President DOE", "PERU"), (2, 1, "Mr. A", "Chad")]
    assert got[0].language == "Spanish" and got[1].heading == "Mr. John Doe" and got[0].words >= 30


def test_verbatim_turns(spark):
    b = [
        ("General debate", "General debate", True, False), ("The President: I now give the floor to Mr. X of Morocco.", "The President", False, False), ("Mr. X (Morocco) (spoke in French): Hello all.", "Mr. X", False, False), ("More words.", None, False, False),
        ("Mr. X was escorted from the Hall.", None, False, True), ("Agenda item 7", "Agenda item 7", True, False), ("Mr. Y (Chad): Not this.", "Mr. Y", False, False), ("Address by Mr. Z, President of Peru", "Address by Mr. Z, President of Peru", True, False), ("President Z: Thanks.", "President Z", False, False),
        ("The President: We turn to the right of reply.", "The President", False, False), ("Mr. W (India): I reply.", "Mr. W", False, False),
    ]
    d = spark.createDataFrame([(1, i, *x) for i, x in enumerate(b)], "m int, seq int, text string, bold string, all_bold boolean, italic boolean")
    got = turns.verbatim_turns(d, "m").orderBy("n").collect()
    assert [(r.label, r.language, r.kind, r.text) for r in got] == [
        ("Mr. X (Morocco)", "french", "general_debate", "Hello all.\n\nMore words."), ("President Z", "english", "general_debate", "Thanks."), ("Mr. W (India)", "english", "right_of_reply", "I reply."),
    ]
    assert "Morocco" in got[0].introduction and got[1].heading.startswith("Address by") and got[1].introduction is None


def test_reading_order(spark):
    lines = [(1, 1, 10.0, 40.0, 10.0, "L1"), (1, 1, 60.0, 90.0, 10.0, "R1"), (1, 1, 10.0, 40.0, 20.0, "L2"), (1, 1, 10.0, 90.0, 30.0, "wide"), (1, 1, 60.0, 90.0, 40.0, "R2"), (1, 1, 10.0, 40.0, 40.0, "L3")]
    d = spark.createDataFrame([(*x[:5], 100.0, x[5]) for x in lines], "k int, page int, x0 double, x1 double, y double, width double, text string")
    assert [r.text for r in turns.reading_order(d, "k", share=0.5).orderBy("seq").collect()] == ["L1", "L2", "R1", "wide", "L3", "R2"]


def test_checks(spark):
    q, s = spark.createDataFrame([(1, "peace"), (1, "war")], "i int, q string"), spark.createDataFrame([(1, "we want peace")], "i int, t string")
    assert [r.q for r in checks.missing_quotes(q, s, "i", "q", "t").collect()] == ["war"]
    checks.assert_empty(spark.range(0), "nothing")
    with pytest.raises(AssertionError):
        checks.assert_empty(spark.range(1), "something")


# --- cleaning and factors against plain versions ---


def brute_clean(text, kind):
    """The cleaned text, line after line."""
    search = lambda p, x: re.search(p, x) is not None
    t = re.sub(r"(?ms)\A.*?^‏?\[.*?\][^\S\n]*$", "", text or "", count=1) if kind == "transcript" else text or ""
    lines = [x.strip(" \t‏") for x in t.replace("\r", "").split("\n")]
    if kind == "transcript":
        start = max((i + 1 for i, x in enumerate(lines[:10]) if search(cleaning.PRESIDING, x)), default=0)
        lines = lines[start:]
        while lines and (not lines[-1] or search(cleaning.PRESIDING, lines[-1])):
            lines.pop()
        if lines:
            lines[-1] = re.sub(cleaning.CLOSING, "", lines[-1])
    elif kind == "statement":
        lines = [x for x in lines if not x or len(x) >= 80 or lines.count(x) < 3]
    lines = [x for x in lines if not search(cleaning.PAGE_MARK, x) and not search(cleaning.DELIVERY_NOTE, x)]
    paragraphs, last, blank = [], "", False
    for x in lines:
        if not x:
            blank = True
            continue
        ends = search(r"[.!?:;\"”’»)\]]$|[。！？]$", last)
        if last and ends and (blank or x[0].isupper() or not x[0].isalpha()) or not paragraphs:
            paragraphs.append([x])
        else:
            paragraphs[-1].append(x)
        last, blank = x, False
    out = []
    for p in paragraphs:
        j = re.sub("(?<=[^\\W\\d_])[‐­]\n(?=[a-zà-ÿ])", "", "\n".join(p))
        j = re.sub("(?<=[^\\W\\d_]-)\n", "", j)
        out.append(re.sub(r"[ \t]+", " ", j.replace("\n", " ")))
    return "\n\n".join(out).strip(" ")


def test_clean_against_a_plain_version(spark):
    r = random.Random(4)
    pool = ["", "", "Mr. President, we meet today.", "and so on", "Page 3 of 9", "- 12 -", "Check against delivery", "Statement by the Minister", "The end of well-", "known things", "an inter‐", "national order", "Thank you.", "(b) a point", "We hope that", "it will hold.", "The Assembly will now hear an address.", "x" * 90, "Then he said:", "“Yes.”", "\ttabs  and blanks \t"]
    rows = []
    for i in range(300):
        n = r.randrange(0, 30)
        body = "\n".join(r.choice(pool) for _ in range(n))
        kind = ("statement", "transcript", "other")[i % 3]
        rows.append((i, "Heading\n[Translated]\n" + body if kind == "transcript" and i % 2 else body, kind))
    rows += [(900, None, "statement"), (901, "", "transcript"), (902, None, None)]
    got = {x.i: x.clean for x in cleaning.clean(spark.createDataFrame(rows, "i int, t string, k string"), "t", "k").collect()}
    for i, t, k in rows:
        assert got[i] == brute_clean(t, k), (k, t)


def test_sparse_factors_settle_near_the_best_error():
    r = np.random.default_rng(2)
    true = r.random((60, 4)) * (r.random((60, 4)) < 0.4)
    x = (true @ (r.random((4, 200)) * (r.random((4, 200)) < 0.3))) + (r.random((60, 200)) < 0.01) * 0.1
    u, s, vt = np.linalg.svd(x, full_matrices=False)
    gu, gs, gvt = topics.leading(topics.Sparse.of(x), 4)
    assert np.allclose(gs, s[:4], rtol=1e-6) and np.allclose(np.abs((gu * u[:, :4]).sum(axis=0)), 1, atol=1e-4)
    w, h = topics.nmf(x, 4)
    assert (w >= 0).all() and (h >= 0).all()
    best = np.sqrt((s[4:] ** 2).sum())
    assert np.linalg.norm(x - w @ h) <= 1.25 * best


def test_words_are_counted(spark):
    texts = ["", " \n\t ", "one", " two words ", "a b c", "x  y\n\nz.", None, "w " * 5000, "é-è ’s \t end"]
    got = {r.i: r.n for r in spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", S.word_count(F.col("t")).alias("n")).collect()}
    assert got == {i: len(re.findall(r"[^ \t\n\x0b\f\r]+", t or "")) for i, t in enumerate(texts)}


def test_lowest_and_highest_places(spark):
    from rostrum.functions import numbers

    r = random.Random(1)
    values = [r.randrange(40) / 4 for _ in range(333)] + [None] * 3
    d = spark.createDataFrame([(v,) for v in values], "v double")
    got = {x.v: x.spread_v for x in numbers.spread(d, "v").collect()}
    ordered = sorted(v for v in values if v is not None)
    low, high = ordered[int(len(ordered) * (1 - 0.97))], ordered[int(len(ordered) * 0.97) - 1]
    assert all(abs(got[v] - min(1, max(0, (v - low) / (high - low)))) < 1e-12 for v in ordered)

def test_numbers_round_as_sql_does(spark):
    import duckdb

    from rostrum.functions import numbers

    # what is just below a half may shift to one; -0.04 keeps its sign
    values = [17.85, 53.35, 2.5, -2.25, -0.04, 0.0, *(float(np.nextafter(i / 20, 0)) for i in range(1, 400)), *(w / s for w in range(1, 60) for s in range(1, 60))]
    d = spark.createDataFrame(list(enumerate(values)), "i int, v double").orderBy("i")
    got, plain = ([str(r[0]) for r in d.select(c).collect()] for c in (numbers.rounded(F.col("v"), 1), F.round("v", 1)))
    assert got == [str(duckdb.execute("SELECT round(?::DOUBLE, 1)", [v]).fetchone()[0]) for v in values] and got != plain


def test_a_name_ends_before_a_line_with_a_title(spark):
    text = "Mr. User (Spain) (translated from Spanish): One two three four five. Queen sails on.\nMr. Assistant (Spain) (translated from Spanish): Six seven eight nine ten.\nMr.\nLong\nName (Peru): One two three four five."
    got = turns.scanned_turns(spark.createDataFrame([(1, text)], "k int, t string"), "k", "t", least_words=5).orderBy("n").collect()
    assert [r.name for r in got] == ["Mr. User", "Mr. Assistant", "Mr.\nLong\nName"] and got[0].body.endswith("Queen sails on.")


def test_evidence_and_chunks_split_a_long_text_once(spark):
    """A text of 20,000 sentences takes seconds; split again for every sentence, it took hours."""
    import time

    n = 20_000
    text = "Nothing is said here at all. " * (n - 1) + "Here is that word at last."
    d = spark.createDataFrame([(1, text), (2, None), (3, "None.")], "i int, t string")
    began = time.time()
    r = textmining.first_evidence(d, "i", F.col("t"), r"(?iu)\bthat\b", S.SENTENCE).collect()
    c = d.select(F.size(S.chunks(S.sentences(F.col("t")), 3)).alias("n")).where("n > 0").collect()
    assert [x.text for x in r] == ["Here is that word at last."] and [x.n for x in c] == [-(-n // 3), 1] and time.time() - began < 60


def test_factors_in_blocks_equal_those_in_memory(spark, monkeypatch):
    """Topics of a table larger than a block, and than what the driver once held at most."""
    from rostrum.operators import factors

    r = np.random.default_rng(2)
    x = (r.random((60, 4)) * (r.random((60, 4)) < 0.4)) @ (r.random((4, 90)) * (r.random((4, 90)) < 0.3)) + (r.random((60, 90)) < 0.02) * 0.1
    entries = [(i, f"t{j:02}", float(x[i, j])) for i in range(60) for j in range(90) if x[i, j]]
    weights = spark.createDataFrame(entries, "doc long, token string, weight double").repartition(3)
    w, h = topics.nmf(x[x.any(axis=1)][:, x.any(axis=0)], 3, rounds=20)
    monkeypatch.setattr(factors, "SLICE", 32)
    monkeypatch.setattr(topics, "HELD", 100)
    whole = factors.factors
    monkeypatch.setattr(factors, "factors", lambda *a: whole(*a, rounds=20, rows=17))
    made = factors.factors(weights, "doc", 3)
    left, right = (np.concatenate([factors.load(u)["x"] for u in f]) for f in (made.left, made.right))
    assert len(made.rows.blocks) > 3 and np.allclose(left @ right.T.sum(axis=1), w @ h.sum(axis=1), rtol=1e-3, atol=1e-4)
    shares, terms = topics.topics(weights, "doc", k=3, terms=4)
    got = {}
    for s in shares.collect():
        got.setdefault(s.doc, {})[s.topic] = s.share
    want = w / w.sum(axis=1, keepdims=True)
    assert np.allclose([[got[d][t] for t in range(3)] for d in sorted(got)], want, atol=2e-3)
    names = [f"t{j:02}" for j in np.flatnonzero(x.any(axis=0))]
    assert [set(t.terms) for t in terms.orderBy("topic").collect()] == [{names[i] for i in np.argsort(-h[j])[:4]} for j in range(3)]


def test_tokens_are_counted_within_rows(spark):
    d = spark.createDataFrame([(1, ["b", "a", "b"]), (2, []), (3, None), (4, ["c"])], "i int, w array<string>")
    counts = textmining.token_counts(d, "i", F.col("w"))
    assert rows(counts) == [(1, "a", 1), (1, "b", 2), (4, "c", 1)]
    assert "Exchange" not in counts._jdf.queryExecution().executedPlan().toString()
    twice = d.union(spark.createDataFrame([(1, ["b", "z"])], "i int, w array<string>"))
    assert rows(textmining.token_counts(twice, "i", F.col("w"))) == [(1, "a", 1), (1, "b", 3), (1, "z", 1), (4, "c", 1)]
    assert [tuple(r) for r in textmining.common(twice, "i", F.col("w"), 2).collect()] == [("b", 3, 1), ("a", 1, 1)]
    plan = textmining.tfidf(d, "i", F.col("w"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 2, plan
