"""Tokenizers: counts, byte-level BPE and Re-Pair shards against the libraries themselves."""

import base64
import hashlib
import json
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from rostrum.llm import bytebpe, repair, tokencount

from .conftest import TEXTS, prose

JSON, RANKS, WORDS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_multi_50k.tiktoken"), P.path("word_bpe_49k.json")


def odd_texts(n: int) -> list[str]:
    r = random.Random(3)
    pool = [chr(i) for i in [*range(0, 0x250), 0x85, 0xA0, 0x1680, 0x2028, 0x3000, 0xFEFF, 0x661, 0x2160, 0x4E00, 0x1F600, 0x301, 0x327, 0x3A3]] + [" "] * 80 + ["\n"] * 30 + ["'s"] * 9 + ["a", "b", "e", "aa"] * 40 + ["<|endoftext|>"] * 4
    return ["".join(r.choice(pool) for _ in range(30)) for _ in range(n)] + ["", "a" * 3000, " " * 2000, "ab" * 600, "é" * 300]


def test_counts_equal_the_library(spark, docs, no_docs):
    lib = Tokenizer.from_file(JSON)
    c = tokencount.HeapCounter(JSON)
    for t in odd_texts(400):
        assert c.text(t) == len(lib.encode(t, add_special_tokens=False).ids), repr(t)
    got = sorted((r.doc_id or -1, r.n_bytes, r.n_tokens, r.over_limit) for r in tokencount.token_counts(docs, JSON).collect())
    want = sorted((i or -1, len((t or "").encode()), n := len(lib.encode(t or "", add_special_tokens=False).ids), n > 1024) for i, t in TEXTS)
    assert got == want
    assert tokencount.token_counts(no_docs, JSON).count() == 0


def _tiktoken():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe_equals_the_library(spark, docs, no_docs):
    enc, c = _tiktoken(), bytebpe.Coder(RANKS)
    texts = odd_texts(400)
    ids = c.encode(texts)
    assert [x.tolist() for x in ids] == [enc.encode_ordinary(t) for t in texts]
    assert c.decode(ids) == [t.encode() for t in texts]
    got = {}
    for r in bytebpe.digests(docs, RANKS).collect():
        got.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_sha256, r.decoded_sha256))
    for i, t in TEXTS:
        want = enc.encode_ordinary(t or "")
        assert (len(want), hashlib.sha256(",".join(map(str, want)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) in got[i]
    assert sum(map(len, got.values())) == len(TEXTS)
    assert bytebpe.digests(no_docs, RANKS).count() == 0


def test_encode_then_decode_tables(spark, docs):
    back = bytebpe.decode(bytebpe.encode(docs, RANKS), RANKS)
    assert sorted(bytes(r["bytes"]) for r in back.collect()) == sorted((t or "").encode() for _, t in TEXTS)


def test_memory_can_be_forgotten():
    enc, c = _tiktoken(), bytebpe.Coder(RANKS)
    c.memory = 10
    for t in ("one two three four five six seven eight nine ten eleven twelve", "thirteen fourteen one two", "again one"):
        assert c.encode([t])[0].tolist() == enc.encode_ordinary(t)


@pytest.fixture(scope="module")
def manifest(docs):
    return repair.write_shards(docs, WORDS, end_id=2, partitions=3)


def test_shards_hold_all_ids_in_order(docs, manifest):
    lib = Tokenizer.from_file(WORDS)
    rows = repair.read_shards(manifest, ids=True).orderBy("start", "n_tokens").collect()
    assert len(rows) == len(TEXTS)
    start, last = 0, -1
    for r in rows:
        assert r.start == start and (r.doc_id or -1) >= last
        start, last = start + r.n_tokens, r.doc_id or -1
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    want = sorted((i or -1, lib.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in TEXTS)
    assert sorted((r.doc_id or -1, r.ids) for r in rows) == want


def test_shards_read_parts_of_documents(manifest):
    for m in manifest.collect():
        s = repair.Shard(m.uri)
        for i in range(s.head["n_docs"]):
            whole = s.document(i).tolist()
            for a, b in ((0, 1), (0, len(whole)), (len(whole) // 3, len(whole) // 2 + 1)):
                assert s.tokens(i, a, b).tolist() == whole[a:b]
        assert (s.lengths >= 2).all()


def test_segments_equal_the_whole_text(tmp_path):
    lib, texts = Tokenizer.from_file(WORDS), odd_texts(300)
    w = repair.Writer(f"file://{tmp_path}", WORDS, 2, lib.get_vocab_size(), 0)
    w.add(list(range(len(texts))), pa.array(texts))
    s = repair.Shard(w.flush()["uri"])
    assert [s.document(i).tolist() for i in range(len(texts))] == [x.ids + [2] for x in lib.encode_batch(texts, add_special_tokens=False)]


def test_grammar_expands_to_its_input():
    r = np.random.default_rng(1)
    sizes = r.integers(0, 9, 500)
    flat = r.integers(0, 6, sizes.sum()).astype(np.int32)
    short, now, rules = repair.grammar(flat, sizes, np.full(500, 3.0), 6)
    table = [[i] for i in range(6)]
    for a, b in rules.tolist():
        table.append(table[a] + table[b])
    assert [x for s in short.tolist() for x in table[s]] == flat.tolist()
    assert len(rules) and now.sum() == len(short) < len(flat)


def test_no_documents_make_no_shards(no_docs):
    m = repair.write_shards(no_docs, WORDS, end_id=2, partitions=2)
    assert m.count() == 0 and repair.read_shards(m).count() == 0


def _frequent(flat, sizes, weights):
    """Occurrences of the most frequent pair within segments; of a run of one symbol, every other pair."""
    count, at = Counter(), 0
    for n, w in zip(sizes.tolist(), weights.tolist()):
        last, s = None, flat[at : at + n].tolist()
        for i, p in enumerate(zip(s, s[1:])):
            if last == (i - 1, p):
                continue
            count[p] += w
            last = (i, p)
        at += n
    return max(count.values(), default=0)


def _expanded(symbol, rules, base):
    return [symbol] if symbol < base else [x for side in rules[symbol - base].tolist() for x in _expanded(side, rules, base)]


@pytest.mark.parametrize("case", ["once", "run", "mixed"])
def test_grammar_leaves_no_frequent_pair(case):
    rng = np.random.default_rng(5)
    if case == "once":  # a pair of segments that occur once each
        parts = [[100 + i, 7, 8, 300 + i] for i in range(repair.MIN_PAIR)]
    elif case == "run":  # more doublings than six rounds make
        parts = [[3] * 4096]
    else:
        parts = [rng.integers(0, 5, int(n)).tolist() for n in rng.integers(0, 60, 300)]
    weights = np.ones(len(parts)) if case != "mixed" else rng.integers(1, 4, len(parts)).astype(float)
    sizes = np.array([len(p) for p in parts])
    flat, now, rules = repair.grammar(np.concatenate([np.array(p, np.int32) for p in parts]), sizes, weights, 1000)
    assert len(rules) and _frequent(flat, now, weights) < repair.MIN_PAIR
    ends = np.cumsum(now)
    assert [[x for s in flat[e - n : e].tolist() for x in _expanded(s, rules, 1000)] for e, n in zip(ends, now)] == parts


def _strict(parts, least, base):
    """Plain Re-Pair: the most frequent pair alone, again and again; the symbols that are left, and the number of rules."""
    parts, made = [list(p) for p in parts], base
    while True:
        count = Counter()
        for p in parts:
            i, last = 0, None
            for i, pair in enumerate(zip(p, p[1:])):
                if last == (i - 1, pair):
                    continue
                count[pair] += 1
                last = (i, pair)
        if not count or max(count.values()) < least:
            return sum(map(len, parts)), made - base
        best = max(count, key=lambda x: (count[x], -x[0], -x[1]))
        for p in parts:
            i = 0
            while i + 1 < len(p):
                if (p[i], p[i + 1]) == best:
                    p[i : i + 2] = [made]
                i += 1
        made += 1


def test_grammar_is_about_as_small_as_strict_re_pair():
    rng = np.random.default_rng(3)
    phrases = [rng.integers(0, 40, int(n)).tolist() for n in rng.integers(2, 9, 30)]
    parts = [sum((phrases[int(i)] if rng.random() < 0.8 else [int(rng.integers(0, 40))] for i in rng.zipf(1.3, 60) % 30), []) for _ in range(40)]
    sizes = np.array([len(p) for p in parts])
    flat, now, rules = repair.grammar(np.concatenate([np.array(p, np.int32) for p in parts]), sizes, None, 1000)
    left, made = _strict(parts, repair.MIN_PAIR, 1000)
    assert len(flat) + 2 * len(rules) <= 1.05 * (left + 2 * made)
    ends = np.cumsum(now)
    assert [[x for s in flat[e - n : e].tolist() for x in _expanded(s, rules, 1000)] for e, n in zip(ends, now)] == parts


def test_pairs_reach_across_words_and_many_shards_hold_all(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(repair, "SHARD_TOKENS", 3000)
    lib, phrase = Tokenizer.from_file(WORDS), "the quick brown fox jumps over the lazy dog and runs away from it all"
    texts = [f"{prose(i, 30)} {phrase} {prose(i + 500, 10)}" for i in range(120)]
    w, rows = repair.Writer(f"file://{tmp_path}", WORDS, 2, lib.get_vocab_size(), 0), []
    for at in range(0, 120, 10):
        w.add(list(range(at, at + 10)), pa.array(texts[at : at + 10]))
        if w.full():
            rows.append(w.flush())
    if w.ids:
        rows.append(w.flush())
    assert len(rows) > 2
    at = 0
    for r in rows:
        s = repair.Shard(r["uri"])
        per_doc = np.diff(s.symbol_ends)
        every = s.symbols(0, s.head["n_docs"])
        assert _frequent(every, per_doc, np.ones(len(per_doc))) < repair.MIN_PAIR
        if s.head["n_docs"] >= repair.MIN_PAIR:  # the whole phrase is one symbol
            assert s.lengths.max() >= len(lib.encode(phrase, add_special_tokens=False).ids)
        for i in range(s.head["n_docs"]):
            assert s.document(i).tolist() == lib.encode(texts[at], add_special_tokens=False).ids + [2] and s.doc_ids[i] == at
            at += 1
    assert at == 120


def test_symbols_beyond_sixteen_bits_are_read_back(tmp_path):
    lib = Tokenizer.from_file(WORDS)
    w = repair.Writer(f"file://{tmp_path}", WORDS, 2, 70_000, 0)  # rules begin above 2**16
    texts = [prose(i % 7, 50) for i in range(200)]
    w.add(list(range(200)), pa.array(texts))
    s = repair.Shard(w.flush()["uri"])
    assert s.head["high"] >= 1 and len(s.lengths) and (s.symbols(0, 200) >= 70_000).any()
    for i in (0, 3, 199):
        assert s.document(i).tolist() == lib.encode(texts[i], add_special_tokens=False).ids + [2]


def test_a_document_is_read_without_the_others(tmp_path):
    w = repair.Writer(f"file://{tmp_path}", WORDS, 2, Tokenizer.from_file(WORDS).get_vocab_size(), 0)
    w.add(list(range(300)), pa.array([prose(i, 80) for i in range(300)]))
    s = repair.Shard(w.flush()["uri"])
    read = []
    real = s._bytes
    s._bytes = lambda a, b: (read.append(b - a), real(a, b))[1]
    s.document(150)
    assert sum(read) < 0.02 * 2 * s.head["n_symbols"]


def test_tokenizers_that_need_more_are_refused(spark, docs, tmp_path):
    spec = json.load(open(P.path("byte_bpe_50k.json"), encoding="utf-8"))
    for change in ({"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": spec["pre_tokenizer"] | {"add_prefix_space": True}}, {"model": spec["model"] | {"dropout": 0.1}}):
        with pytest.raises(ValueError):
            tokencount.check(spec | change)
    tokencount.check(spec)
    with pytest.raises(ValueError):
        repair.Segments(P.path("byte_bpe_50k.json"))
