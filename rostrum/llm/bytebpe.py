"""Byte-level BPE encoding and decoding by DuckDB queries inside each task.

Encoding: the pieces of a batch of texts that the task has not met before become token-position rows (piece, place, id).
A recursive query joins neighbours with the merge table (every way to put a vocabulary entry together from two others),
contracts each piece's leftmost pair of minimum rank, and goes on until no piece has a pair left. Decoding joins ids
with the vocabulary and puts their bytes together by an ordered aggregation. Work is cut into chunks of a fixed number of
rows, so memory is bounded whatever a text's length; nothing is written outside memory.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Numbering, arrow_map, gather, held, struct
from .tokencount import PATTERN

#: Pieces in a recursive query; squared bytes of a chunk's pieces (the recursion keeps the rows of each round);
#: bytes from which a piece is merged by a heap, with the same result, since its rounds would be too many.
CHUNK_PIECES, CHUNK_SQUARES, LONG = 20_000, 4_000_000, 2048
#: Pieces that a worker remembers before it starts anew (about 200 bytes each), and ids in all for each of them.
MEMORY, IDS_A_PIECE = 1_200_000, 10
#: Tokens of a decoding query.
CHUNK_TOKENS = 500_000

PLACES = 1 << 20

ENCODE = f"""
WITH RECURSIVE state(round, piece, place, id, next_place, next_id, rank) AS (
    SELECT 0, s.piece, s.place, s.id, s.next_place, s.next_id, m.rank
    FROM (
        SELECT piece, place, id, lead(place) OVER w AS next_place, lead(id) OVER w AS next_id
        FROM symbols WINDOW w AS (PARTITION BY piece ORDER BY place)
    ) s
    LEFT JOIN merges m ON m.pair = s.id::BIGINT * {PLACES} + s.next_id
    UNION ALL
    SELECT u.round + 1, u.piece, u.place, u.id, u.next_place, u.next_id, CASE WHEN u.changed THEN m.rank ELSE u.rank END
    FROM (
        SELECT s.round, s.piece, s.place, s.rank,
               CASE WHEN s.place = b.spot THEN b.made ELSE s.id END AS id,
               CASE WHEN s.place = b.spot THEN r.next_place ELSE s.next_place END AS next_place,
               CASE WHEN s.place = b.spot THEN r.next_id WHEN s.next_place = b.spot THEN b.made ELSE s.next_id END AS next_id,
               s.place = b.spot OR coalesce(s.next_place = b.spot, false) AS changed
        FROM state s
        JOIN (
            SELECT piece, (key % {PLACES})::INT AS spot, (key // {PLACES})::INT AS made, gone
            FROM (
                SELECT piece, min(rank::BIGINT * {PLACES} + place) AS key, arg_min(next_place, rank::BIGINT * {PLACES} + place) AS gone
                FROM state WHERE rank IS NOT NULL GROUP BY piece
            )
        ) b ON s.piece = b.piece
        LEFT JOIN state r ON r.piece = s.piece AND r.place = CASE WHEN s.place = b.spot THEN s.next_place END
        WHERE s.place <> b.gone
    ) u
    LEFT JOIN merges m ON m.pair = CASE WHEN u.changed THEN u.id::BIGINT * {PLACES} + u.next_id END
)
SELECT state.piece, state.id
FROM state JOIN (SELECT piece, max(round) AS round FROM state GROUP BY piece) ended USING (piece, round)
ORDER BY state.piece, state.place
"""

DECODE = """
SELECT part, string_agg(letters, '' ORDER BY place) AS letters
FROM tokens JOIN vocabulary USING (id)
GROUP BY part ORDER BY part
"""


class Coder:
    """The vocabulary of a rank file, in DuckDB's memory, with what has been encoded so far."""

    def __init__(self, path: str):
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
        ranks = self.ranks
        pairs, ids = [], []
        for word, rank in ranks.items():
            for cut in range(1, len(word)):
                a, b = ranks.get(word[:cut]), ranks.get(word[cut:])
                if a is not None and b is not None:
                    pairs.append(a * PLACES + b)
                    ids.append(rank)
        self.words = {rank: word for word, rank in ranks.items()}
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "200MB", "temp_directory": ""})
        self.con.register("given", pa.table({"pair": pa.array(pairs, pa.int64()), "rank": pa.array(ids, pa.int32())}))
        self.con.execute("CREATE TABLE merges AS SELECT * FROM given")
        # one character for each byte, U+0000 to U+00FF
        self.con.register("given", pa.table({"id": pa.array(list(ranks.values()), pa.int32()), "letters": [w.decode("latin-1") for w in ranks]}))
        self.con.execute("CREATE TABLE vocabulary AS SELECT * FROM given")
        self.con.unregister("given")
        self.split = regex.compile(PATTERN)
        self.memory = MEMORY
        self.forget()

    def forget(self) -> None:
        self.index, self.names = Numbering(), []
        self.ids, self.sizes, self.starts, self.used = np.empty(1 << 16, np.int32), np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64), 0

    def _heap(self, piece: bytes) -> list[int]:
        """The ids of a long piece: lowest rank first, leftmost first, with lists of neighbours."""
        ids, n = [int(x) for x in self.byte[np.frombuffer(piece, np.uint8)]], len(piece)
        ranks, words = self.ranks, self.words

        def get(a: int, b: int) -> int | None:
            return ranks.get(words[a] + words[b])

        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        now = [get(a, b) for a, b in zip(ids, ids[1:])] + [None]
        heap = [(r, i) for i, r in enumerate(now) if r is not None]
        heapify(heap)
        while heap:
            r, i = heappop(heap)
            if now[i] != r:
                continue
            j = after[i]
            ids[i], after[i], now[j] = r, after[j], None
            ids[j] = -1
            k = after[i]
            now[i] = get(r, ids[k]) if k < n else None
            if k < n:
                before[k] = i
            if now[i] is not None:
                heappush(heap, (now[i], i))
            if (h := before[i]) >= 0:
                now[h] = get(ids[h], r)
                if now[h] is not None:
                    heappush(heap, (now[h], h))
        return [x for x in ids if x >= 0]

    def _recursive(self, pieces: list[bytes]) -> list[np.ndarray]:
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ends = np.cumsum(sizes)
        flat = np.frombuffer(b"".join(pieces), np.uint8)
        symbols = pa.table({  # noqa: F841  (read by the query)
            "piece": pa.array(np.repeat(np.arange(len(pieces), dtype=np.int32), sizes)),
            "place": pa.array((np.arange(len(flat)) - np.repeat(ends - sizes, sizes)).astype(np.int32)),
            "id": pa.array(self.byte[flat]),
        })
        self.con.register("symbols", symbols)
        got = self.con.execute(ENCODE).fetchnumpy()
        self.con.unregister("symbols")
        cuts = np.searchsorted(np.asarray(got["piece"]), np.arange(1, len(pieces)))
        return np.split(np.asarray(got["id"]).astype(np.int32), cuts)

    def learn(self, pieces: list[str]) -> list[np.ndarray]:
        """The ids of each piece."""
        out: list = [None] * len(pieces)
        todo: list[tuple[int, bytes]] = []
        for i, p in enumerate(pieces):
            raw = p.encode()
            rank = self.ranks.get(raw)
            if rank is not None:
                out[i] = np.array([rank], np.int32)
            elif len(raw) > LONG:
                out[i] = np.array(self._heap(raw), np.int32)
            else:
                todo.append((i, raw))
        todo.sort(key=lambda x: len(x[1]))  # pieces of like length need like numbers of rounds
        at = 0
        while at < len(todo):
            end, squares = at, 0
            while end < len(todo) and end - at < CHUNK_PIECES and squares < CHUNK_SQUARES:
                squares += len(todo[end][1]) ** 2
                end += 1
            for (i, _), ids in zip(todo[at:end], self._recursive([raw for _, raw in todo[at:end]])):
                out[i] = ids
            at = end
        return out

    def numbers(self, texts: list[str]) -> list[list[int]]:
        """The numbers of each text's pieces; new pieces are encoded. Numbers hold until the next call."""
        if len(self.index) > self.memory or self.used > IDS_A_PIECE * self.memory:
            self.forget()
        get, findall = self.index.__getitem__, self.split.findall
        out = [list(map(get, findall(t))) for t in texts]
        new, self.index.new = self.index.new, []
        if new:
            arrays = self.learn(new)
            n, m = len(self.names), len(self.index)
            flat, sizes = np.concatenate(arrays), np.fromiter(map(len, arrays), np.int64, len(arrays))
            self.ids, self.sizes, self.starts = _room(self.ids, self.used + len(flat)), _room(self.sizes, m), _room(self.starts, m)
            self.ids[self.used : self.used + len(flat)] = flat
            self.sizes[n:m] = sizes
            self.starts[n:m] = self.used + np.cumsum(sizes) - sizes
            self.used += len(flat)
            self.names += (",".join(map(str, a.tolist())) for a in arrays)
        return out

    def ids_of(self, numbers: list[int]) -> np.ndarray:
        return gather(self.ids, self.sizes, np.array(numbers, np.int64), self.starts)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [self.ids_of(n) for n in self.numbers(texts)]

    def decode(self, docs: list[np.ndarray]) -> list[bytes]:
        """The bytes of each document's ids; parts of a long document are put together one after the other."""
        parts = [(d, ids[i : i + CHUNK_TOKENS]) for d, ids in enumerate(docs) for i in range(0, len(ids), CHUNK_TOKENS)]
        out: list[list[bytes]] = [[] for _ in docs]
        at = 0
        while at < len(parts):
            end, n = at, 0
            while end < len(parts) and (n == 0 or n + len(parts[end][1]) <= CHUNK_TOKENS):
                n += len(parts[end][1])
                end += 1
            sizes = np.fromiter((len(x[1]) for x in parts[at:end]), np.int64, end - at)
            tokens = pa.table({  # noqa: F841
                "part": pa.array(np.repeat(np.arange(end - at, dtype=np.int32), sizes)),
                "place": pa.array(np.arange(n, dtype=np.int32)),
                "id": pa.array(np.concatenate([x[1] for x in parts[at:end]])),
            })
            self.con.register("tokens", tokens)
            got = self.con.execute(DECODE).fetchall()
            self.con.unregister("tokens")
            for part, letters in got:
                out[parts[at + part][0]].append(letters.encode("latin-1"))
            at = end
        return [b"".join(x) for x in out]


def _room(a: np.ndarray, n: int) -> np.ndarray:
    """The array, or a longer one that begins with it, with room for n."""
    return a if n <= len(a) else np.concatenate([a, np.empty(max(n, 2 * len(a)) - len(a), a.dtype)])


@lru_cache(maxsize=2)
def coder(path: str) -> Coder:
    return Coder(path)


held(__name__, coder.cache_clear)


#: Characters of texts that are worked on at once, unless one text alone has more.
GROUP_CHARS = 2 << 20


def _groups(texts: list[str], chars: int = GROUP_CHARS) -> Iterator[list[str]]:
    """Runs of texts of about so many characters, so that ids of a whole batch are never held at once."""
    run, n = [], 0
    for t in texts:
        run.append(t)
        n += len(t)
        if n >= chars:
            yield run
            run, n = [], 0
    if run:
        yield run


def _digests(batches: Iterator[pa.RecordBatch], *, path: str, memory: int, chars: int) -> Iterator[pa.RecordBatch]:
    c = coder(path)
    c.memory = memory
    for b in batches:
        n, ids_sha, out_sha = [], [], []
        for texts in _groups([x or "" for x in b.column(1).to_pylist()], chars):
            numbers = c.numbers(texts)
            docs = [c.ids_of(x) for x in numbers]
            n += map(len, docs)
            ids_sha += (hashlib.sha256(",".join(map(c.names.__getitem__, x)).encode()).hexdigest() for x in numbers)
            out_sha += (hashlib.sha256(x).hexdigest() for x in c.decode(docs))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(out_sha, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def _ids(batches: Iterator[pa.RecordBatch], *, path: str) -> Iterator[pa.RecordBatch]:
    c, at = coder(path), 0
    for b in batches:
        at = 0
        for texts in _groups([x or "" for x in b.column(1).to_pylist()]):
            ids = pa.array([d.tolist() for d in c.encode(texts)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(texts)), ids], names=["doc_id", "ids"])
            at += len(texts)


def _texts(batches: Iterator[pa.RecordBatch], *, path: str) -> Iterator[pa.RecordBatch]:
    c = coder(path)
    for b in batches:
        for i, ids in enumerate(b.column(1).to_pylist()):
            raw = c.decode([np.array(ids or [], np.int32)])
            yield pa.RecordBatch.from_arrays([b.column(0).slice(i, 1), pa.array(raw, pa.binary())], names=["doc_id", "bytes"])


def _pick(docs: DataFrame, id_col: str, col: str, kind: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(col).cast(kind).alias("value"))


def encode(docs: DataFrame, ranks: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (array of int) of every row. A null text counts as empty and has no ids; see digests()."""
    return arrow_map(_pick(docs, id_col, text_col, "string"), _ids, struct("doc_id long, ids array<int>"), path=ranks)


def decode(encoded: DataFrame, ranks: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and bytes of every row of ids. Null ids count as none. An id outside the vocabulary has no bytes."""
    return arrow_map(_pick(encoded, id_col, ids_col, "array<int>"), _texts, struct("doc_id long, bytes binary"), path=ranks)


def digests(docs: DataFrame, ranks: str, *, id_col: str = "doc_id", text_col: str = "text", memory: int = MEMORY, chars: int = GROUP_CHARS) -> DataFrame:
    """Encode and decode every row in one pass: doc_id, n_tokens, ids_sha256 (of decimal ids joined by commas), decoded_sha256.

    memory is the number of pieces that a worker remembers, chars the length of texts that it works on at once; fewer take less memory and
    more time, with the same result.

    A null text counts as empty: 0 tokens and the digests of nothing. Repeated rows and null ids give a row each, an empty
    table none. Other columns are not read, so their names cannot clash.
    """
    schema = struct("doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return arrow_map(_pick(docs, id_col, text_col, "string"), _digests, schema, path=ranks, memory=memory, chars=chars)
