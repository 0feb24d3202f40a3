"""Benchmark decontamination: a broadcast set of the benchmark's word windows, scanned over every document.

Words are runs of ASCII letters, digits and all characters beyond ASCII, after A-Z are lower-cased. The benchmark's
windows are given to each task with the numbers of their words; a document's words are numbered by the same small
vocabulary, its windows are hashed by a polynomial in one pass of array operations, hashes that the set has are verified word by
word, and the words of verified windows are marked. The set is broadcast in parts of a fixed number of windows, one pass
over the documents a part, and each pass is written before the next, so no task holds more than one part whatever the
benchmark's size. Several passes meet by a number that each row is given beforehand.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, arrow_schema, struct, unused, written

#: Consecutive words of a window, and windows that a pass broadcasts at most (about 200 bytes each).
WINDOW, PART_WINDOWS = 10, 200_000

#: Fixed value: what is a word, once A-Z are lower-cased.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[str]:
    return WORD.findall(text.translate(LOWER)) if text else []


def _windows(batches: Iterator[pa.RecordBatch], *, window: int) -> Iterator[pa.RecordBatch]:
    """(window, item) rows of the benchmark: the window's words joined by blanks."""
    for b in batches:
        rows = []
        for item, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            w = words(text)
            rows += [(" ".join(w[i : i + window]), item) for i in range(max(1, len(w) - window + 1))] if w else []
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64())], names=["window", "item_id"])


class Windows:
    """A part of the benchmark's windows, ready for search."""

    def __init__(self, rows: list[tuple[str, list]]):
        self.vocab: dict[str, int] = {}
        self.items: dict[tuple[int, ...], list] = {}
        by_size: dict[int, list[tuple[int, ...]]] = defaultdict(list)
        for text, items in rows:
            key = tuple(self.vocab.setdefault(w, len(self.vocab) + 1) for w in text.split(" "))
            self.items[key] = items
            by_size[len(key)].append(key)
        self.hashes = {n: np.unique(_hashes(np.array(keys, np.uint64).reshape(-1), n)[::n]) for n, keys in by_size.items()}

    def scan(self, text: str) -> tuple[int, list[tuple[int, int]], set]:
        """Words in all, hit runs of words (start, end) one after the other, and the items whose windows occur."""
        w = words(text)
        get = self.vocab.get
        ids = np.fromiter(map(get, w, repeat(0)), np.uint64, len(w))
        runs, items = [], set()
        for n, known in self.hashes.items():
            if len(w) < n or not len(known):
                continue
            h = _hashes(ids, n)
            at = np.searchsorted(known, h)
            at[at == len(known)] = 0
            for i in np.flatnonzero(known[at] == h).tolist():
                found = self.items.get(tuple(ids[i : i + n].tolist()))
                if found is not None:
                    runs.append((i, i + n))
                    items.update(found)
        return len(w), _joined(runs), items


def _hashes(ids: np.ndarray, n: int) -> np.ndarray:
    """A hash of every n neighbours."""
    out = np.zeros(len(ids) - n + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            out = out * FACTOR + (ids[k : len(ids) - n + 1 + k] + np.uint64(1))
    return out


FOUND = "n_words long, spans array<long>, items array<long>, had_items boolean"


def _scan(batches: Iterator[pa.RecordBatch], *, rows, drop: str | None, text_at: int, only_hits: bool = False) -> Iterator[pa.RecordBatch]:
    part = Windows(rows.value)
    for b in batches:
        texts = b.column(text_at).to_pylist()
        found = [part.scan(t or "") for t in texts]
        if drop == "spans":
            yield _put(b, text_at, [_without(t, f[1]) for t, f in zip(texts, found)])
        elif drop == "documents":
            yield b.filter(pa.array([not f[1] for f in found], pa.bool_()))
        else:
            more = [[f[0] for f in found], [[x for run in f[1] for x in run] for f in found], [[x for x in f[2] if x is not None] for f in found], [bool(f[2]) for f in found]]
            kept = [c for i, c in enumerate(b.columns) if i != text_at]
            names = [n for i, n in enumerate(b.schema.names) if i != text_at]
            out = pa.RecordBatch.from_arrays([*kept, *(pa.array(v, t) for v, t in zip(more, arrow_schema(FOUND).types))], names=[*names, *arrow_schema(FOUND).names])
            yield out.filter(pa.array([bool(f[1]) for f in found], pa.bool_())) if only_hits else out


def _cut(batches: Iterator[pa.RecordBatch], *, text_at: int) -> Iterator[pa.RecordBatch]:
    """The rows' texts without the runs of words in the last column, which goes."""
    for b in batches:
        runs = [_joined(list(zip(s[::2], s[1::2]))) if s else [] for s in b.column(b.num_columns - 1).to_pylist()]
        rest = pa.RecordBatch.from_arrays(b.columns[:-1], names=b.schema.names[:-1])
        yield _put(rest, text_at, [_without(t, r) for t, r in zip(b.column(text_at).to_pylist(), runs)])


def _put(b: pa.RecordBatch, at: int, texts: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(b.columns)], names=b.schema.names)


def _joined(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs in order, those that touch or overlap made one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _without(text: str | None, runs: list[tuple[int, int]]) -> str | None:
    """The text without the hit runs of words; what stands between its other words stays."""
    if not runs:
        return text
    places = [m.span() for m in WORD.finditer(text.translate(LOWER))]
    out, at = [], 0
    for a, b in runs:
        out.append(text[at : places[a][0]])
        at = places[b - 1][1]
    return "".join(out) + text[at:]


def benchmark_windows(benchmark: DataFrame, *, window: int = WINDOW, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct windows of the benchmark with their items, in a written table."""
    b = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(text_col).alias("text"))
    rows = arrow_map(b, _windows, struct("window string, item_id long"), window=window)
    return written(rows.groupBy("window").agg(F.collect_set("item_id").alias("items")), "benchmark-windows")


def parts(windows: DataFrame, size: int = PART_WINDOWS) -> int:
    """Into how many parts of about that many windows each the benchmark goes; at least one, which may be empty."""
    return max(1, -(-windows.count() // size))


def sent(windows: DataFrame, k: int = 0, n: int = 1):
    """Part k of n of the windows, broadcast."""
    mine = windows if n == 1 else windows.where(F.pmod(F.xxhash64("window"), F.lit(n)) == k)
    return windows.sparkSession.sparkContext.broadcast([(r.window, r.items) for r in mine.toLocalIterator()])


def _numbered(docs: DataFrame, name: str) -> DataFrame:
    """docs with a number for every row, in a written table, so that the number stays the row's own in every pass."""
    return written(docs.select(F.monotonically_increasing_id().alias(name), *[F.col(f"`{c}`") for c in docs.columns]), "numbered")


def _passes(rows: DataFrame, windows: DataFrame, n: int) -> DataFrame:
    """Hits over n passes of rows (key columns, text last): a row each. The first pass gives every row, later ones only those with hits; they meet by the keys."""
    keys = rows.columns[:-1]
    found = None
    for k in range(n):
        part = sent(windows, k, n)
        schema = struct(", ".join(f"{c} long" for c in keys) + ", " + FOUND)
        one = written(arrow_map(rows, _scan, schema, rows=part, drop=None, text_at=len(keys), only_hits=k > 0), "window-hits")
        part.destroy()
        found = one if found is None else found.unionByName(one)
    return found.groupBy(*keys).agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items")
    )


def hits(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, part_windows: int = PART_WINDOWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A document or item without text has no words and no hits; an item of fewer words than a window is one window of its
    own length. Items of a null id make words hit but are not counted; an id that several items share counts once. Repeated documents
    give a row each, as do rows of one id or of a null id, whatever the number of passes; an empty table gives none, an empty benchmark no hits. Other columns are not read.
    """
    windows = benchmark_windows(benchmark, window=window)
    n = parts(windows, part_windows)
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    if n == 1:
        merged = arrow_map(d, _scan, struct("doc_id long, " + FOUND), rows=sent(windows), drop=None, text_at=1)
    else:
        merged = _passes(_numbered(d, "row"), windows, n)
    pairs = F.array_sort(F.transform(F.sequence(F.lit(0), F.greatest(F.size("spans") - 2, F.lit(0)), F.lit(2)), lambda i: F.struct(F.get("spans", i).alias("a"), F.get("spans", i + 1).alias("b"))))
    covered = F.aggregate(pairs, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")), lambda s, p: F.struct((s.n + F.greatest(p.b - F.greatest(p.a, s.end), F.lit(0))).alias("n"), F.greatest(s.end, p.b).alias("end")), lambda s: s.n)
    n_hit = F.when(F.size("spans") > 0, covered).otherwise(F.lit(0).cast("long"))
    names = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return merged.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(names, 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, remove: str = "documents", window: int = WINDOW, part_windows: int = PART_WINDOWS, text_col: str = "text") -> DataFrame:
    """docs, all columns, without the documents that hold a window ("documents") or without the words of windows ("spans").

    Rows without text stay as they are. Spans are found over the whole benchmark before any is removed, so that the result
    does not depend on the number of passes.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove is documents or spans, not {remove}")
    at = docs.columns.index(text_col)
    windows = benchmark_windows(benchmark, window=window)
    n = parts(windows, part_windows)
    if n == 1:
        return arrow_map(docs, _scan, docs.schema, rows=sent(windows), drop=remove, text_at=at)
    row, spans = unused(docs, "row"), unused(docs, "spans")
    numbered = _numbered(docs, row)
    found = _passes(numbered.select(F.col(f"`{row}`").alias("row"), F.col(f"`{text_col}`").alias("text")), windows, n).where(F.size("spans") > 0)
    found = found.select(F.col("row").alias(row), F.col("spans").alias(spans))
    if remove == "documents":
        return numbered.join(found, row, "left_anti").drop(row)
    rows = numbered.join(found, row, "left").drop(row)
    return arrow_map(rows, _cut, docs.schema, text_at=at)
