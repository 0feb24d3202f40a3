import random

import pytest

WORDS = "the of and to in is that it was for on are with as his they at be this from have or by one had not but what all were".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(40)) for _ in range(n))


#: Null and empty texts, ties, repeated rows, a very long text, odd characters; ids null and repeated.
TEXTS = [
    (1, prose(1, 60)), (2, prose(1, 60)), (3, prose(1, 59) + " changed"), (4, prose(4, 80)), (5, None), (6, ""), (7, " \n\t "), (8, "one two"),
    (9, "one two"), (10, prose(10, 30_000)), (11, "Ünïcödé ΣΑΣ ﬁne İstanbul e\u0301 <|endoftext|> tail\u2003wide\x1cunit"), (None, prose(1, 60)), (None, None),
    (12, prose(4, 80)), (12, prose(4, 80)), (13, "a" * 5000 + " " * 700 + "\n" * 300), (14, "mail x.y@site.example.org or 10.0.0.1, card 4111 1111 1111 1111, tel +1 (212) 555-0100."),
]


@pytest.fixture(scope="session")
def docs(spark):
    rows = [(i, t, "en", f"src{(i or 0) % 3}", len(t or ""), "x", 1, "y", 2.0) for i, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, value string, h long, _text string, score double")


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.where("false")
