import hashlib
import io
import re

import pytest
from pyspark.sql import functions as F

from rostrum.llm import urlfilter, warc

LONG = "<html>" + "x" * 3_000_000 + "é</html>"
PAGES = [(5, "http://a.org/x", "same " * 40), (3, "http://b.org/x", "same " * 40), (9, None, "same " * 40), (1, "http://c/\r\nEvil: 1", None), (2, "u", ""), (4, "v", "short"), (6, "w", "short"), (7, "z", LONG), (8, "z", LONG), (None, "n", "same " * 40), (10, "q", "\r\n\r\nWARC/1.1\r\n\r\n" * 20)]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, "clash", "clash") for p in PAGES], "page_id long, url string, html string, digest string, first_id string")


def test_archives_round_trip(pages):
    rows = warc.records(warc.read_chunks(warc.write_archives(pages), payload=False)).collect()
    assert len(rows) == len(PAGES)
    html = {i: h or "" for i, _, h in PAGES}
    first = {}
    for i, h in sorted((i, h) for i, h in html.items() if i is not None and len(h.encode()) >= 100):
        first.setdefault(h, i)
    for r in rows:
        raw = html[r.page_id].encode()
        want = first.get(html[r.page_id])
        want = None if want == r.page_id else want
        assert (r.payload_bytes, r.payload_digest, r.refers_to, r.record_type) == (len(raw), hashlib.sha256(raw).hexdigest(), want, "response" if want is None else "revisit")


def test_chunks_carry_digests_and_bytes(pages):
    rows = warc.read_chunks(warc.write_archives(pages)).where("page_id = 7").orderBy("chunk_no").collect()
    raw, done = LONG.encode(), 0
    assert len(rows) == 3
    for r in rows:
        assert bytes(r.chunk) == raw[done : done + r.chunk_bytes] and r.chunk_bytes <= warc.CHUNK
        done += r.chunk_bytes
        assert r.digest == hashlib.sha256(raw[:done]).hexdigest()
    assert done == len(raw) and [r["last"] for r in rows] == [False, False, True]


def test_many_copies_join_by_shuffle(pages, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_ROWS", 0)
    assert warc.records(warc.read_chunks(warc.write_archives(pages), payload=False)).where("record_type = 'revisit'").count() == 4


def test_a_broken_payload_is_found():
    import zlib

    head, http = warc._head(1, "u", "response", None, hashlib.sha256(b"other").hexdigest(), 5)
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    raw = z.compress(head + http + b"hello" + b"\r\n\r\n") + z.flush()
    with pytest.raises(ValueError):
        list(warc.chunks_of(io.BytesIO(raw)))
    with pytest.raises(EOFError):
        list(warc.chunks_of(io.BytesIO(raw[:-12])))


def test_no_pages(pages):
    assert warc.read_chunks(warc.write_archives(pages.where("false"))).count() == 0


RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"), ("com", "", "block"), ("a.com", "", "allow"), ("a.com", "", "block"), (None, "/", "block"), ("net", None, "block")]
URLS = ["http://x.example.org/es/1", "HTTP://Example.ORG/es/", "http://example.org/en/12?q=/es/", "http://notexample.org/es/", "http://org", "http://org?x", "https://a.b.com/fr/1#f", "ftp://com/de/", None, "", "no scheme", "a://b://c/d", "http://example.org/en/2", "http://deep.a.com/x", "http://com", "http://é.org/ü", "://x.org/p", "http://x.org\n/y"]


def brute(url, rules):
    host = path = ""
    if url and "://" in url:
        m = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S)
        host, path = "".join(c.lower() if c.isascii() else c for c in m[1]), m[2]
    fit = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules if None not in (h, p) and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best[3] if best else None, best[4] if best else "allow"


@pytest.mark.parametrize("rules", [RULES, RULES[:5], []])
def test_urls_against_brute_force(spark, rules):
    given = [(i % 15, u) for i, u in enumerate(URLS * 2)]
    p = spark.createDataFrame([(i, u, "c", "k") for i, u in given], "page_id long, url string, host string, key string")
    r = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = sorted(map(str, ((x.page_id, x.host, x.path, x.rule, x.verdict) for x in urlfilter.judge(p, r).collect())))
    assert got == sorted(str((i, *brute(u, rules))) for i, u in given)
    assert urlfilter.judge(p.where("false"), r).count() == 0


def test_the_filter_has_every_key(spark):
    keys = spark.range(3000).selectExpr("concat('k', id) AS key")
    b = urlfilter.BlockedBloom(keys, "key")
    assert keys.where(~b.may_have(F.col("key"))).count() == 0
    assert spark.range(3000).selectExpr("concat('other', id) AS key").where(b.may_have(F.col("key"))).count() < 300


def test_the_filter_grows_with_the_list(spark):
    keys = spark.range(200_000).selectExpr("concat('site', id, '.org/') AS key")
    b = urlfilter.BlockedBloom(keys, "key")
    assert keys.where(~b.may_have(F.col("key"))).count() == 0
    wrong = spark.range(200_000).selectExpr("concat('other', id, '.org/') AS key").where(b.may_have(F.col("key"))).count()
    assert wrong < 0.02 * 200_000


def test_only_possible_hits_are_shuffled(spark, monkeypatch):
    monkeypatch.setattr(urlfilter, "BROADCAST_RULES", 0)
    p = spark.createDataFrame([(i, f"http://{'a.com' if i % 50 == 0 else f'h{i}.net'}/x") for i in range(2000)], "page_id long, url string")
    r = spark.createDataFrame([("a.com", "/", "block")], "host string, path string, verdict string")
    got = urlfilter.judge(p, r)
    assert got.where("verdict = 'block' AND rule = 'a.com/'").count() == 40 and got.count() == 2000
