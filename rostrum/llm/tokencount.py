"""Token counts by heap-and-linked-list byte-pair merging.

A piece of text starts as one symbol a byte, in a doubly linked list. A heap holds the rank and place of every adjacent
pair that can merge; the lowest is popped, merged, and the pairs with its new neighbours are pushed. Stale entries are
known by their rank, which no longer fits the place. The count is the number of symbols less the number of merges, so
no identifiers are made. Pieces repeat, so each worker counts a piece once as long as its bounded memory of pieces lasts.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_map, held

#: Pieces, and the length of a piece in characters, that a worker remembers; longer or later pieces are counted anew.
MEMORY, MEMORY_CHARS = 600_000, 64

#: The pattern that byte-level tokenizers split text by before they merge.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary: printable Latin-1 as it is, the others from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def check(spec: dict) -> None:
    """Raise unless a tokenizer file asks for just what is done here: byte-level pieces by PATTERN, plain merges, special strings taken as they stand."""
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    wrong = [k for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
    wrong += [k for k in ("normalizer", "truncation", "padding") if spec.get(k)]
    wrong += ["model"] * (model.get("type") != "BPE") + ["pre_tokenizer"] * (before.get("type") != "ByteLevel" or before.get("add_prefix_space", True) or not before.get("use_regex", True))
    wrong += [t["content"] for t in spec.get("added_tokens", []) if any(t.get(k) for k in ("single_word", "lstrip", "rstrip", "normalized"))]
    if wrong:
        raise ValueError(f"this tokenizer file is not counted rightly here, because of: {', '.join(wrong)}")


class HeapCounter:
    """Counts tokens by a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        check(spec)
        model = spec["model"]
        vocab = model["vocab"]
        self.width = max(vocab.values()).bit_length() + 1
        self.first = [vocab[c] for c in byte_letters()]
        self.merges: dict[int, int] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[vocab[a] << self.width | vocab[b]] = rank << self.width | vocab[a + b]
        self.specials = [t["content"] for t in spec.get("added_tokens", [])]
        self.special = regex.compile("|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True)))) if self.specials else None
        self.pieces = regex.compile(PATTERN)
        self.known: dict[str, int] = {}

    def piece(self, text: str) -> int:
        """Tokens of one piece."""
        first, get, width = self.first, self.merges.get, self.width
        ids = [first[b] for b in text.encode()]
        n = left = len(ids)
        if n < 2:
            return n
        low = (1 << width) - 1
        bits = n.bit_length()
        heap, now = [], [-1] * n
        for i in range(n - 1):
            m = get(ids[i] << width | ids[i + 1])
            if m is not None:
                now[i] = m
                heap.append(m << bits | i)
        heapq.heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        places = (1 << bits) - 1
        while heap:
            e = heapq.heappop(heap)
            i, m = e & places, e >> bits
            if now[i] != m:
                continue
            j = after[i]
            k = after[j]
            ids[i] = made = m & low
            now[j] = now[i] = -1
            after[i] = k
            left -= 1
            if k < n:
                before[k] = i
                m = get(made << width | ids[k])
                if m is not None:
                    now[i] = m
                    heapq.heappush(heap, m << bits | i)
            h = before[i]
            if h >= 0:
                m = get(ids[h] << width | made)
                if m is None:
                    now[h] = -1
                else:
                    now[h] = m
                    heapq.heappush(heap, m << bits | h)
        return left

    def plain(self, text: str) -> int:
        """Tokens of a text without special strings."""
        known, total = self.known, 0
        for p in self.pieces.findall(text):
            n = known.get(p)
            if n is None:
                n = self.piece(p)
                if len(p) <= MEMORY_CHARS:
                    if len(known) >= MEMORY:
                        known.clear()
                    known[p] = n
            total += n
        return total

    def text(self, text: str) -> int:
        """Tokens of a text; each special string in it is one token, as the library's default has it."""
        if self.special is None or not any(s in text for s in self.specials):
            return self.plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self.plain, parts))


@lru_cache(maxsize=2)
def counter(path: str) -> HeapCounter:
    return HeapCounter(path)


held(__name__, counter.cache_clear)


def _count(batches: Iterator[pa.RecordBatch], *, path: str, limit: int) -> Iterator[pa.RecordBatch]:
    c = counter(path)
    for b in batches:
        texts = [x or "" for x in b.column(1).to_pylist()]
        n = [c.text(x) for x in texts]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([len(x.encode()) for x in texts], pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
            names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
        )


def token_counts(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024) -> DataFrame:
    """One row per input row: doc_id, n_bytes (UTF-8), n_tokens, over_limit.

    A null text counts as empty: 0 bytes, 0 tokens. Repeated rows and null ids give a row each; an empty table gives none.
    A file that asks for a normaliser, a prefix blank, other pieces or other merging raises an error. Other columns of docs are not read, so their names cannot clash. Long texts are split into pieces as they stand;
    a piece of n bytes takes n log n steps.
    """
    cols = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])
    return arrow_map(cols, _count, schema, path=tokenizer, limit=limit)
