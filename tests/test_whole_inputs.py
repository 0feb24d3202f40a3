"""Queries that once took part of their input, against brute force over all of it."""

import hashlib
import re

import pytest

from rostrum.operators import sequences, topics
from rostrum.plans import analysis, relational, reports, text


@pytest.fixture
def tables(spark, tmp_path):
    """Writes tables into a folder as the driver's are."""

    def write(**frames):
        for name, (rows, schema) in frames.items():
            spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write


LONG = " ".join(f"w{i}" for i in range(120))
ITEMS = [(1, "one two three four five, six seven"), (2, "Small part"), (3, LONG), (4, "alpha beta gamma delta epsilon zeta eta"), (5, "x"), (6, "ab  cd ef")]
DOCS = [(1, "nothing of it"), (2, f"before {LONG} after"), (3, LONG[:-1] + "z"), (50, "bone two three four five, six sevenths"), (51, "a Small part, One Two three four five!"), (52, "ab  cd ef ab  cd ef"), (53, "alpha beta gamma delta"), (54, ""), (55, "zab  cd efx")]


def test_quotes_are_looked_for_whole_in_all_documents(tables, spark):
    sf = tables(documents=(DOCS, "doc_id long, text string"), benchmark=(ITEMS, "item_id long, text string"))
    got = {r.item_id: r.quoted_by for r in reports.d16_context_quotes(spark, sf).collect()}
    assert got == {i: sum(q in t for _, t in DOCS) for i, q in ITEMS}
    assert got[1] == got[2] == got[3] == 1 and got[6] == 2


def test_quotes_of_null_items_and_documents(spark):
    items, docs = spark.createDataFrame([(1, None)], "i long, text string"), spark.createDataFrame([(None,)], "text string")
    assert [tuple(r) for r in sequences.quoted_by(items, docs, "i").collect()] == [(1, 0)]


def test_shared_passages_of_all_documents(tables, spark):
    sf = tables(documents=(DOCS, "doc_id long, text string"), benchmark=(ITEMS, "item_id long, text string"))
    bare = lambda t: [re.sub(r"\W+", "", w).lower() for w in t.split()]
    want = {}
    for d, t in DOCS:
        for i, q in ITEMS:
            x, y = bare(t), bare(q)
            runs = lambda w: {tuple(w[a:b]) for a in range(len(w)) for b in range(a + 1, len(w) + 1)}
            most = max(map(len, runs(x) & runs(y)), default=0)
            if most >= min(sequences.RUN, len(y)):
                want[d, i] = most
    got = {(r.doc_id, r.item_id): r.n_words for r in analysis.t9_shared_passage(spark, sf).collect()}
    assert got == want and got[51, 1] == 5 and got[2, 3] == 120


def test_tokens_of_whole_documents_by_language(tables, spark):
    rows = [(1, "Word " * 500, "en"), (2, "日本語。" * 200, "ja"), (3, None, "fr"), (4, "إسلام", "ar")]
    sf = tables(documents=([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, n_chars long"))
    got = {r.doc_id: (r.n_tokens, r.tokens_sha256) for r in reports.f13_tokens_by_language(spark, sf).collect()}
    want = {1: ["word"] * 500, 2: list("日本語") * 200, 3: [], 4: list("اسلام")}
    assert got == {k: (len(w), hashlib.sha256(" ".join(w).encode()).hexdigest()) for k, w in want.items()}


def test_every_quote_is_checked_to_its_end(tables, spark):
    same = "s" * 60
    sf = tables(documents=([(1, same + "a"), (2, same + "b"), (3, same + "b" + "c"), (4, "d")], "doc_id long, text string"))
    assert sorted(r.doc_id for r in text.j15_quote_containment(spark, sf).collect()) == [1, 3]


def test_outer_join_of_all_documents(tables, spark):
    sf = tables(documents=([(i, "en") for i in range(7)], "doc_id long, lang string"), labels=([(3, 1), (4, 0), (9, 1)], "doc_id long, quality int"))
    got = {r.doc_id: r.origin for r in relational.j1_outer_indicator(spark, sf).collect()}
    assert got == {0: "left_only", 1: "left_only", 2: "left_only", 3: "both", 4: "both", 5: "left_only", 6: "left_only", 9: "right_only"}


def test_themes_follow_weights_and_keep_all_items(spark):
    rows = [(f"{side}{i}", t, 0.99 if (t == "x") == (side == "a") else 0.1) for side in "ab" for i in range(6) for t in ("x", "y")]
    rows += [(r[0], f"own{r[0]}", 0.05) for r in rows[::2]]
    w = spark.createDataFrame(rows, "item string, token string, weight double")
    got = {r.item: r.theme for r in topics.themes(w, "item", parts=2, k=2).collect()}
    assert len(got) == 12 and len({got[f"a{i}"] for i in range(6)}) == len({got[f"b{i}"] for i in range(6)}) == 1 and got["a0"] != got["b0"]
    more = w.select("item").union(spark.createDataFrame([("none",)], "item string"))
    assert topics.themes(w, "item", items=more, parts=2, k=2).count() == 13
