"""Token-id shards compressed by Re-Pair, with random access.

Documents are dealt by ranges of doc_id, so shard after shard holds them in ascending order. A shard's texts are cut at
ASCII white space, which the tokenizer drops and never merges across; each distinct segment is encoded once by the
tokenizers library. Re-Pair then works on the shard: round after round the frequent adjacent pairs become nonterminals, until no pair
within a document occurs MIN_PAIR times. It does so first on the distinct segments, each weighted by its occurrences, which is Re-Pair on
what words share, and then on the documents themselves, where pairs reach across segments but not across documents. Neither the rounds nor the symbols
are limited. Where pairs of a round overlap, the more frequent one wins, and the loser is counted anew in the next round. Rules, the length that each
expands to, and the documents' symbols go to one file.

File, little-endian: 8 bytes b"RSTPAIR2"; uint32 length of a JSON head; the head (n_docs, n_tokens, n_symbols, n_rules,
base, high: bits of a symbol above 16); then arrays: left and right side of each rule (uint32), its expansion length (int64), doc_id
(int64) and whether it is null (uint8), end of each document in symbols and in tokens (int64), the lower 16 bits of all symbols (uint16), and for each
higher bit, lowest first, that bit of all symbols, eight a byte. Symbols from base on are rules.
A reader loads the rules and the documents' ends, seeks a document's symbols, and expands these alone.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from struct import pack, unpack_from

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Atomic, Numbering, arrow_map, arrow_schema, gather, held, scratch, split_uri, struct, written

MAGIC = b"RSTPAIR2"
#: A shard is closed after so many tokens. A pair becomes a rule if it occurs so often.
SHARD_TOKENS, MIN_PAIR = 8_000_000, 16


@lru_cache(maxsize=2)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


#: Segments that a worker remembers from shard to shard, before it starts anew.
MEMORY = 800_000
#: Bits of the table of counts by hash, which tells most rare pairs before any sorting.
HASH_BITS = 20
#: Words of Latin letters up to U+024F, which stay letters when the tokenizer normalises them; the dotted capital I does not.
PLAIN = r"^[A-Za-zªµºÀ-ÖØ-öø-įı-ɏ]+$"
MARKED = PLAIN.removesuffix("$") + r"[!-/:-@\[-`{-~]$"


@lru_cache(maxsize=2)
def word_ends(path: str) -> np.ndarray:
    """Whether each id ends a word."""
    suffix = json.load(open(path, encoding="utf-8"))["model"].get("end_of_word_suffix") or "\0"
    vocab = tokenizer(path).get_vocab()
    out = np.zeros(max(vocab.values()) + 1, bool)
    out[[i for w, i in vocab.items() if w.endswith(suffix)]] = True
    return out


class Segments:
    """Distinct segments that a worker has met: their ids one after the other. Numbers hold until forget()."""

    def __init__(self, path: str):
        self.path, self.tok = path, tokenizer(path)
        ids = lambda t: self.tok.encode(t, add_special_tokens=False).ids
        if ids(" \n") or ids(" one\ttwo 3 ") != ids("one") + ids("two") + ids("3"):
            raise ValueError(f"{path} does not drop white space, so texts cannot be cut there")
        self.lowers = all(ids(w) == ids(w.lower()) for w in ("A", "WORDS", "MiXeD", "É'S", "THE1ST"))
        self.forget()

    def forget(self) -> None:
        self.index = Numbering()
        self.ids: list[np.ndarray] = [np.empty(0, np.int32)]
        self.sizes: list[np.ndarray] = [np.empty(0, np.int64)]

    def numbers(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the segments of all texts, one after the other, and how many each text has.

        Where the tokenizer lower-cases, ASCII capitals are lower-cased first, so that segments differ less; texts that may hold a special string stay as they are.
        """
        if self.lowers:
            texts = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
        lists = pc.ascii_split_whitespace(texts)
        words = lists.flatten().dictionary_encode()
        names = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words.dictionary)], pa.int32()), words.dictionary), " ")[0].as_py().split(" ")
        # the ends of a text may give empty words, which are segments without ids
        number = np.fromiter(map(self.index.__getitem__, names), np.int32, len(names))
        return number[words.indices.to_numpy(zero_copy_only=False)], np.diff(lists.offsets.to_numpy())

    def encode_new(self) -> None:
        """Encode the segments that are new. Latin words are one piece each, so a run of them is encoded as one text and cut after each id that ends a word;
        of a Latin word with one ASCII mark after it, word and mark are segments of their own, and it has the ids of both."""
        given = pa.array(self.index.new, pa.string())
        ended = pc.match_substring_regex(given, MARKED).to_numpy(zero_copy_only=False)
        parts = given.filter(pa.array(ended))
        # words and marks that are not known yet become new segments too
        of = lambda texts: np.fromiter(map(self.index.__getitem__, texts.to_pylist()), np.int64, len(texts))
        both = np.stack([of(pc.utf8_slice_codeunits(parts, 0, -1)), of(pc.utf8_slice_codeunits(parts, -1))], 1).reshape(-1)
        new, self.index.new = self.index.new, []
        ended = np.append(ended, np.zeros(len(new) - len(ended), bool))
        one = pc.match_substring_regex(pa.array(new, pa.string()), PLAIN).to_numpy(zero_copy_only=False)
        flat, sizes = [], np.zeros(len(new), np.int64)
        order = []
        for is_plain, part in ((True, np.flatnonzero(one)), (False, np.flatnonzero(~one & ~ended))):
            for at in range(0, len(part), 4096):
                some = part[at : at + 4096]
                got, sizes[some] = self._encode([new[i] for i in some], is_plain)
                flat.append(got)
            order.append(part)
        marked = np.flatnonzero(ended)
        order = np.concatenate([*order, marked])
        known, known_sizes = self.flat()
        # ids by number, the new ones in the order in which they were made; marked words have none yet
        starts = np.zeros(len(new), np.int64)
        starts[order] = np.cumsum(sizes[order]) - sizes[order] + len(known)
        ids = np.concatenate([known, *flat]).astype(np.int32)
        every, at = np.append(known_sizes, sizes), np.append(np.cumsum(known_sizes) - known_sizes, starts)
        flat.append(gather(ids, every, both, at).astype(np.int32))
        sizes[marked] = every[both].reshape(-1, 2).sum(axis=1)
        starts[order] = np.cumsum(sizes[order]) - sizes[order]
        self.ids.append(gather(np.concatenate(flat), sizes, np.arange(len(new)), starts).astype(np.int32))
        self.sizes.append(sizes)

    def _encode(self, words: list[str], plain: bool) -> tuple[np.ndarray, np.ndarray]:
        if plain:
            ids = np.array(self.tok.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, np.int32)
            ends = np.flatnonzero(word_ends(self.path)[ids]) + 1
            if len(ends) == len(words):
                return ids, np.diff(ends, prepend=0)
        e = self.tok.encode(words, is_pretokenized=True, add_special_tokens=False)
        return np.array(e.ids, np.int32), np.bincount(np.array(e.word_ids, np.int64), minlength=len(words)) if len(e.ids) else np.zeros(len(words), np.int64)

    def flat(self) -> tuple[np.ndarray, np.ndarray]:
        self.ids, self.sizes = [np.concatenate(self.ids)], [np.concatenate(self.sizes)]
        return self.ids[0], self.sizes[0]


@lru_cache(maxsize=1)
def segments(path: str) -> Segments:
    return Segments(path)


def _let_go() -> None:
    segments.cache_clear()
    tokenizer.cache_clear()


held(__name__, _let_go)


def _groups(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order that brings equal pairs together, in order of place, and where each pair's group begins in it."""
    bits, n = int(max(a.max(), b.max())).bit_length(), len(a)
    if 2 * bits + n.bit_length() <= 64:  # pairs with their places, by one sort of both
        low = np.uint64(n.bit_length())
        both = (a.astype(np.uint64) << np.uint64(bits) | b.astype(np.uint64)) << low | np.arange(n, dtype=np.uint64)
        both.sort()
        order, key = (both & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64), both >> low
    else:
        key = a.astype(np.int64) << 32 | b
        order = np.argsort(key, kind="stable")
        key = key[order]
    return order, np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))


class Sequence:
    """Symbols in segments, as a linked list, whose frequent pairs are replaced in place.

    Only places whose pair may be frequent are looked at again: a pair once found rare stays rare, since replacements make
    new pairs of new symbols alone.
    """

    def __init__(self, flat: np.ndarray, sizes: np.ndarray, weights: np.ndarray | None = None):
        n = len(flat)
        self.symbol = np.append(flat, -1).astype(np.int32)
        self.after, self.before = np.arange(1, n + 2, dtype=np.int32), np.arange(-1, n, dtype=np.int32)
        self.last = np.zeros(n + 1, bool)  # whether a symbol ends its segment
        self.last[np.cumsum(sizes)[sizes > 0] - 1] = True
        self.gone = np.zeros(n, bool)
        self.weight = None if weights is None else np.repeat(weights, sizes)
        self.sizes = sizes
        self.rank = np.full(n + 2, NEVER, np.int32)  # the last entry is that of no place
        self.open = np.flatnonzero(~self.last[:n]).astype(np.int32)

    def count(self, of: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
        """Occurrences of each number in of, which belongs to the places at."""
        return np.bincount(of, weights=None if self.weight is None else self.weight[at], minlength=n)

    def round(self, made: int) -> np.ndarray:
        """Replace the frequent pairs of a round; new symbols are numbered from made on. Returns the rules (n, 2), none when nothing is frequent."""
        at = self.open
        a, b = self.symbol[at], self.symbol[self.after[at]]
        # in a run of one symbol, every other pair: the others overlap it
        same = np.flatnonzero(a == b)
        if len(same):
            run = at[same]
            begins = np.append(True, (self.after[run[:-1]] != run[1:]) | self.last[run[:-1]])
            place = np.arange(len(run))
            odd = (place - np.maximum.accumulate(np.where(begins, place, 0))) % 2 == 1
            counted = np.ones(len(at), bool)
            counted[same[odd]] = False
            at, a, b, spare = at[counted], a[counted], b[counted], at[~counted]
        else:
            spare = at[:0]
        h = (a.astype(np.uint32) * FACTOR_A + b.astype(np.uint32) * FACTOR_B) >> np.uint32(32 - HASH_BITS)
        may = (self.count(h, at, 1 << HASH_BITS) >= MIN_PAIR)[h]
        at, a, b = at[may], a[may], b[may]
        if not len(at):
            return np.empty((0, 2), np.uint32)
        order, first = _groups(a, b)
        times = np.diff(first, append=len(order))
        uses = times if self.weight is None else np.add.reduceat(self.weight[at[order]], first)
        frequent = uses >= MIN_PAIR
        ranks = np.full(len(first), NEVER, np.int32)
        best = np.argsort(-uses[frequent], kind="stable")
        ranks[np.flatnonzero(frequent)[best]] = np.arange(len(best), dtype=np.int32)
        mine = np.empty(len(at), np.int32)
        mine[order] = np.repeat(ranks, times)
        inside = mine < NEVER
        at, a, b, mine = at[inside], a[inside], b[inside], mine[inside]
        if not len(at):
            return np.empty((0, 2), np.uint32)
        # a place wins over its neighbours if its pair is the more frequent one, of the same pair the first
        self.rank[at] = mine
        wins = (mine < self.rank[self.before[at]]) & (mine <= self.rank[self.after[at]])
        self.rank[at] = NEVER
        keep = self.count(mine[wins], at[wins], len(best)) >= MIN_PAIR
        won = wins & keep[mine]
        number = (np.cumsum(keep) - 1).astype(np.int32)
        sides = np.empty((int(keep.sum()), 2), np.uint32)
        spots, which = at[won], number[mine[won]]
        sides[which, 0], sides[which, 1] = a[won], b[won]
        second = self.after[spots]
        third = self.after[second]
        self.symbol[spots] = made + which
        self.last[spots] = self.last[second]
        self.after[spots], self.before[third] = third, spots
        self.gone[second] = True
        # left to look at: what is frequent and stands, and the pairs of the new symbols
        still = at[~won]
        near = self.before[spots]
        near = near[near >= 0]
        found = np.concatenate([still, spare, spots, near])
        found = found[~self.gone[found] & ~self.last[found]]
        found.sort()
        self.open = found[np.append(True, found[1:] != found[:-1])] if len(found) else found
        return sides

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        """The symbols left, and how many are left of each segment."""
        kept = ~self.gone
        upto = np.concatenate([[0], np.cumsum(kept)])
        ends = np.cumsum(self.sizes)
        return self.symbol[:-1][kept], upto[ends] - upto[ends - self.sizes]


#: No rank, and odd multipliers of a hash (fixed values).
NEVER = 1 << 30
FACTOR_A, FACTOR_B = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B)


def grammar(flat: np.ndarray, sizes: np.ndarray, weights: np.ndarray | None, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Re-Pair over segments: their symbols, the sizes now, and the rules (n, 2), whose symbols begin at base. weights: how often each segment occurs, once if None."""
    s, rules, made = Sequence(flat, sizes, weights), [np.empty((0, 2), np.uint32)], base
    while len(s.open):
        new = s.round(made)
        if not len(new):
            break
        rules.append(new)
        made += len(new)
    return *s.result(), np.concatenate(rules)


class Writer:
    """Collects documents and writes a shard when it is full."""

    def __init__(self, folder: str, tokenizer_path: str, end_id: int, base: int, part: int):
        self.folder, self.path, self.end_id, self.base, self.part, self.seq = folder, tokenizer_path, end_id, base, part, 0
        self.clear()

    def clear(self) -> None:
        self.segments, self.ids, self.docs, self.lens, self.words = segments(self.path), [], [], [], 0
        if len(self.segments.index) > MEMORY:
            self.segments.forget()

    def add(self, ids: list, texts: pa.Array) -> None:
        numbers, lens = self.segments.numbers(texts)
        self.ids += ids
        self.docs.append(numbers)
        self.lens.append(lens)
        self.words += len(numbers) + len(lens)
        self.segments.encode_new()

    def full(self) -> bool:
        return self.words * 2 >= SHARD_TOKENS

    def flush(self) -> dict:
        known, known_sizes = self.segments.flat()
        numbers, per_doc = np.concatenate(self.docs), np.concatenate(self.lens)
        # the shard's own segments, numbered anew
        weights = np.bincount(numbers, minlength=len(known_sizes)).astype(np.float64)
        used = np.flatnonzero(weights)
        weights, sizes, flat = weights[used], known_sizes[used], gather(known, known_sizes, used)
        place = np.zeros(len(known_sizes), np.int64)
        place[used] = np.arange(len(used))
        short, now, rules = grammar(flat, sizes, weights, self.base)
        # the end id is one more segment, after each document's own
        end = len(sizes)
        flat_end, now_end, size_end = np.append(short, np.int32(self.end_id)), np.append(now, 1), np.append(sizes, 1)
        ends = np.cumsum(per_doc)
        which = np.insert(place[numbers], ends, end)
        doc_ends = ends + np.arange(1, len(ends) + 1)
        to = lambda n: np.concatenate([[0], np.cumsum(n[which])])[doc_ends]
        token_ends, word_ends_ = to(size_end), to(now_end)
        symbols, per_doc, more = grammar(gather(flat_end, now_end, which), np.diff(word_ends_, prepend=0), None, self.base + len(rules))
        rules = np.concatenate([rules, more])
        symbol_ends = np.cumsum(per_doc)
        lengths = [1] * self.base
        for x, y in rules.tolist():
            lengths.append(lengths[x] + lengths[y])
        lengths = np.array(lengths, np.int64)
        high = max(0, int(self.base + len(rules) - 1).bit_length() - 16)
        head = {"n_docs": len(self.ids), "n_tokens": int(token_ends[-1]), "n_symbols": len(symbols), "n_rules": len(rules), "base": self.base, "high": high}
        raw = json.dumps(head).encode()
        f = Atomic(f"{self.folder}/shard-{self.part:06d}-{self.seq:06d}.pair")
        f.write(MAGIC + pack("<I", len(raw)) + raw)
        for x, t in ((rules[:, 0], "<u4"), (rules[:, 1], "<u4"), (lengths[self.base :], "<i8"), (np.array([x or 0 for x in self.ids], np.int64), "<i8"), (np.array([x is None for x in self.ids]), "u1"), (symbol_ends, "<i8"), (token_ends, "<i8"), (symbols & 0xFFFF, "<u2"), *((np.packbits(symbols >> 16 + k & 1), "u1") for k in range(high))):
            f.write(np.ascontiguousarray(x, t).tobytes())
        row = {"part": self.part, "seq": self.seq, "uri": f.uri, **{k: head[k] for k in ("n_docs", "n_tokens", "n_symbols", "n_rules")}, "n_bytes": f.close()}
        self.seq += 1
        self.clear()
        return row


MANIFEST = "part int, seq int, uri string, n_docs long, n_tokens long, n_symbols long, n_rules long, n_bytes long"


def _write(batches: Iterator[pa.RecordBatch], *, folder: str, path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    w = Writer(folder, path, end_id, tokenizer(path).get_vocab_size(), TaskContext.get().partitionId())
    rows = []
    for b in batches:
        w.add(b.column(0).to_pylist(), pc.fill_null(b.column(1), ""))
        if w.full():
            rows.append(w.flush())
    if w.ids:
        rows.append(w.flush())
    yield pa.RecordBatch.from_pylist(rows, arrow_schema(MANIFEST))


class Shard:
    """A shard file: rules and the documents' ends in memory, symbols by seeking; what is decoded is what is asked for."""

    def __init__(self, uri: str):
        fs, path = split_uri(uri)
        self.file = fs.open_input_file(path)
        raw = self.file.read(12)
        if raw[:8] != MAGIC:
            raise ValueError(f"{uri} is no token shard")
        (n,) = unpack_from("<I", raw, 8)
        self.head = h = json.loads(self.file.read(n))
        self.base = h["base"]
        take = lambda kind, count: np.frombuffer(self.file.read(np.dtype(kind).itemsize * count), kind)
        self.left, self.right, self.lengths = take("<u4", h["n_rules"]), take("<u4", h["n_rules"]), take("<i8", h["n_rules"])
        ids, null = take("<i8", h["n_docs"]), take("u1", h["n_docs"])
        self.doc_ids = [None if x else i for i, x in zip(ids.tolist(), null.tolist())]
        self.symbol_ends, self.token_ends = (np.append(0, take("<i8", h["n_docs"])) for _ in range(2))
        self.at = self.file.tell()

    def symbols(self, first: int, end: int) -> np.ndarray:
        """Symbols of documents first to end (exclusive), by seeking."""
        a, b = (int(self.symbol_ends[i]) for i in (first, end))
        n = self.head["n_symbols"]
        out = np.frombuffer(self._bytes(2 * a, 2 * b), "<u2").astype(np.uint32)
        for k in range(self.head["high"]):
            plane = 2 * n + k * -(-n // 8)
            bits = np.unpackbits(np.frombuffer(self._bytes(plane + a // 8, plane + -(-b // 8)), np.uint8))
            out |= bits[a % 8 : a % 8 + b - a].astype(np.uint32) << np.uint32(16 + k)
        return out

    def _bytes(self, a: int, b: int) -> bytes:
        self.file.seek(self.at + a)
        return self.file.read(b - a)

    def sizes(self, symbols: np.ndarray) -> np.ndarray:
        """Ids that each symbol expands to."""
        out = np.ones(len(symbols), np.int64)
        rule = symbols >= self.base
        out[rule] = self.lengths[symbols[rule] - self.base]
        return out

    def expand(self, symbols: np.ndarray, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids start to stop of what symbols expand to: rules give way to their sides, each at its place, as far as they reach into the part."""
        size = self.sizes(symbols)
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        stop = total if stop is None else min(stop, total)
        out = np.empty(max(0, stop - start), np.uint32)
        place, n = ends - size - start, len(out)
        while len(symbols):
            if start or stop < total:
                reach = (place < n) & (place + size > 0)
                symbols, place = symbols[reach], place[reach]
            rule = symbols >= self.base
            out[place[~rule]] = symbols[~rule]
            which, place = symbols[rule] - self.base, place[rule]
            left, right = self.left[which], self.right[which]
            size_left, size_right = self.sizes(left), self.sizes(right)
            symbols, place, size = np.concatenate([left, right]), np.concatenate([place, place + size_left]), np.concatenate([size_left, size_right])
        return out

    def document(self, i: int) -> np.ndarray:
        """All ids of document i."""
        return self.expand(self.symbols(i, i + 1))

    def tokens(self, i: int, start: int, stop: int) -> np.ndarray:
        """Ids start to stop of document i: only the rules that reach into them are expanded."""
        return self.expand(self.symbols(i, i + 1), start, stop)

    def close(self) -> None:
        self.file.close()


#: Ids that are decoded at once, unless a document alone has more.
READ_TOKENS = 500_000


def _read(batches: Iterator[pa.RecordBatch], *, ids: bool) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64()] * 4 + [pa.list_(pa.int64())] * ids
    for b in batches:
        for uri, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            s, at = Shard(uri), 0
            ends = s.token_ends
            while at < s.head["n_docs"]:
                to = max(at + 1, int(np.searchsorted(ends, ends[at] + READ_TOKENS, "right")) - 1)
                parts = np.split(s.expand(s.symbols(at, to)).astype("<u4"), ends[at + 1 : to] - ends[at])
                cols = [s.doc_ids[at:to], start + ends[at:to], np.diff(ends[at : to + 1]), [zlib.crc32(x) for x in parts]] + [[x.tolist() for x in parts]] * ids
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(kinds)])
                at = to
            s.close()


def write_shards(docs: DataFrame, tokenizer_path: str, *, end_id: int, folder: str | None = None, partitions: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text, append end_id, and write shards in ascending order of the id; returns the manifest, a row a shard.

    A null text counts as empty and has the end id alone. Null ids come first. Rows of one id stay apart, in the order of
    their text's hash. An empty table makes no shard. A single text is never cut, so a shard is at least that long.
    """
    spark = docs.sparkSession
    cols = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("tie"))
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = cols.repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    return written(arrow_map(dealt, _write, struct(MANIFEST), folder=folder or scratch(spark, "token-shards"), path=tokenizer_path, end_id=end_id), "token-manifest")


def read_shards(manifest: DataFrame, *, ids: bool = False) -> DataFrame:
    """One row a document, read from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, and the ids if asked for."""
    order = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    at = manifest.select("uri", F.coalesce(F.sum("n_tokens").over(order), F.lit(0)).alias("start"))
    at = at.repartition(max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "uri")
    schema = struct("doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * ids)
    return arrow_map(at, _read, schema, ids=ids)
