"""Exact top-k inner products by no-random-access aggregation over sorted lists.

Every dimension of a block of candidates is a list sorted by value. A query reads it from the top where its weight is
positive and from the bottom where it is negative, all lists to one depth, then to the next; nothing is ever looked up by candidate. What has been read
bounds every candidate's score: from below by the worst value of each list not yet met in, from above by the value at the reading
place. Outsiders cannot qualify any more once at most k candidates reach the k-th lower bound; then only those are read on for,
until each has been met in every list that weighs, so that its bounds are its score. What ties for the last place is
decided by reading all. The bounds of all queries of a block are matrix products over what has been read so far.

Depths double up to half of a list, then the rest halves: early stops are cheap on skewed data, and late ones are found closely on flat data.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, remove, struct, written

#: Queries and candidates of a block, and the depths (parts of a list) to which lists are read one after the other.
QUERY_BLOCK, CANDIDATE_BLOCK = 512, 4096
DEPTHS = (*(2.0**-i for i in range(6, 0, -1)), *(1 - 2.0**-i for i in range(2, 7)), 1.0)
BLOCK = "block long, n long, dims long, ids binary, values binary"


def _pack(batches: Iterator[pa.RecordBatch], *, rows: int) -> Iterator[pa.RecordBatch]:
    """Blocks of at most so many vectors of one length, each a row of two byte strings."""
    held: dict[int, tuple[list, list]] = {}

    def block(dims: int) -> pa.RecordBatch:
        ids, vectors = held.pop(dims)
        arrays = [pa.array([0], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([dims], pa.int64()), pa.array([np.array(ids, "<i8").tobytes()], pa.binary()), pa.array([np.array(vectors, "<f8").tobytes()], pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, names=["block", "n", "dims", "ids", "values"])

    for b in batches:
        for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            ids, vectors = held.setdefault(len(v), ([], []))
            ids.append(i)
            vectors.append(v)
            if len(ids) == rows:
                yield block(len(v))
    for dims in list(held):
        yield block(dims)


class Lists:
    """The sorted lists of a block of vectors, which are read by place alone: (candidate numbers, values) of places a to b from either end."""

    def __init__(self, x: np.ndarray):
        self.n, self.dims = x.shape
        self._order = np.argsort(x, axis=0, kind="stable")
        self._values = np.take_along_axis(x, self._order, axis=0)

    def lowest(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        return self._order[a:b], self._values[a:b]

    def highest(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        return self._order[self.n - b : self.n - a], self._values[self.n - b : self.n - a]


class Read:
    """What one direction of reading has told so far: the values met, and bounds for those not met yet."""

    def __init__(self, lists: Lists, kind, from_top: bool):
        self.take = lists.highest if from_top else lists.lowest
        # the list's far end is known from the start, as a list states its range
        ends = (lists.lowest if from_top else lists.highest)(0, 1)[1][0].astype(kind)
        self.worst = np.broadcast_to(ends, (lists.n, lists.dims)).copy()
        self.met = np.zeros((lists.n, lists.dims), bool)
        self.columns, self.place, self.from_top = np.arange(lists.dims), ends, from_top

    def on(self, a: int, b: int) -> None:
        which, values = self.take(a, b)
        self.worst[which, self.columns] = values
        self.met[which, self.columns] = True
        self.place = values[0 if self.from_top else -1].astype(self.worst.dtype)

    def best(self) -> np.ndarray:
        return np.where(self.met, self.worst, self.place)


def search(q: np.ndarray, q_ids: np.ndarray, lists: Lists, x_ids: np.ndarray, k: int, depths: tuple[float, ...] = DEPTHS, limit: float = 0.0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(query number, candidate number, score) of each query's k best candidates of a block, and of all that tie with the last; and the
    depth (part of the lists) at which each query was done. limit: what no sum's terms exceed, so that sums are exact in the narrowest type that holds them.

    x_ids ascend; candidates of one id take one of the k places, that of the best of them.
    """
    n = lists.n
    if limit >= 1 << 53:
        raise ValueError("scores beyond 2**53 are not exact integers")
    kind = np.float32 if 0 < limit < 1 << 24 else np.float64
    up, down = np.maximum(q, 0).astype(kind), np.minimum(q, 0).astype(kind)
    high, low = Read(lists, kind, True), Read(lists, kind, False)
    first = np.flatnonzero(np.diff(x_ids, prepend=x_ids[0] - 1)) if n else np.empty(0, np.int64)
    many = len(first) < n
    by_id = (lambda m, f: f.reduceat(m, first, axis=1)) if many else (lambda m, f: m)
    open_, decided = np.arange(len(q)), [np.empty(0, np.int64)] * 2
    out, done = [], np.zeros(len(q))
    at = 0
    for depth in depths:
        d = n if depth == 1 else min(n, max(at, int(depth * n)))
        if d == at:
            continue
        high.on(at, d)
        low.on(at, d)
        at = d
        best_high, best_low = high.best(), low.best()
        if len(decided[0]):  # outsiders are out: read on for the members alone
            r, c = decided
            floor = np.einsum("ij,ij->i", up[r], high.worst[c]) + np.einsum("ij,ij->i", down[r], low.worst[c])
            ceiling = np.einsum("ij,ij->i", up[r], best_high[c]) + np.einsum("ij,ij->i", down[r], best_low[c])
            waits = np.isin(r, r[floor != ceiling])
            out.append((r[~waits], c[~waits], floor[~waits]))
            done[r[~waits]] = d / n
            decided = [r[waits], c[waits]]
        if len(open_):
            own = q_ids[open_][:, None] == x_ids[None, :]
            floor = up[open_] @ high.worst.T + down[open_] @ low.worst.T
            ceiling = floor.copy() if d == n else up[open_] @ best_high.T + down[open_] @ best_low.T
            floor[own] = ceiling[own] = -np.inf
            floors = by_id(floor, np.maximum)
            wide = floors.shape[1]
            kth = np.partition(floors, wide - k, axis=1)[:, wide - k] if wide > k else np.full(len(open_), -np.inf, kind)
            may = (ceiling >= kth[:, None]) & np.isfinite(ceiling)
            stop = (by_id(may, np.logical_or).sum(axis=1) <= k) | (d == n)
            r, c = np.nonzero(may[stop])
            score, same = floor[stop][r, c], (floor[stop] == ceiling[stop])[r, c]
            waits = np.isin(r, r[~same])
            rows = open_[stop][r]
            out.append((rows[~waits], c[~waits], score[~waits]))
            done[np.setdiff1d(open_[stop], rows[waits])] = d / n
            decided = [np.concatenate([decided[0], rows[waits]]), np.concatenate([decided[1], c[waits]])]
            open_ = open_[~stop]
        if not len(open_) and not len(decided[0]):
            break
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), done
    return *(np.concatenate(x) for x in zip(*out)), done


def _search(batches: Iterator[pa.RecordBatch], *, k: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for row in b.to_pylist():
            take = lambda name: (np.frombuffer(row[f"{name}_ids"], "<i8"), np.frombuffer(row[f"{name}_values"], "<f8").reshape(row[f"{name}_n"], row["dims"]))  # noqa: E731, B023
            (q_ids, q), (x_ids, x) = take("q"), take("x")
            order = np.argsort(x_ids, kind="stable")
            x_ids, x = x_ids[order], x[order]
            limit = max(1.0, float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, x.shape[1]))
            i, j, s, _ = search(q, q_ids, Lists(x), x_ids, k, limit=limit)
            place = np.lexsort((x_ids[j], -s, i))
            i, j, s = i[place], x_ids[j[place]], s[place].astype(np.int64)
            # of one id its best row, then the first k of each query
            _, best = np.unique(np.stack([i, j], 1), axis=0, return_index=True) if len(i) else (None, np.empty(0, np.int64))
            best = np.sort(best)
            i, j, s = i[best], j[best], s[best]
            keep = np.arange(len(i)) - np.searchsorted(i, i) < k
            yield pa.RecordBatch.from_arrays([pa.array(q_ids[i[keep]], pa.int64()), pa.array(j[keep], pa.int64()), pa.array(s[keep], pa.int64())], names=["query_id", "vec_id", "score"])


def quantised(vectors: DataFrame, *, scale: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and x: floor(scale * component) of each, as double. Rows of a null id or vector, or with a null or non-finite component, go."""
    v = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x"))
    good = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    v = v.where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & good & (F.size("x") > 0))
    return v.select("vec_id", F.transform("x", lambda c: F.floor(c * F.lit(float(scale))).cast("double")).alias("x"))


def top_k(vectors: DataFrame, *, k: int = 20, query_every: int = 20, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding", query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k highest integer inner products of every row whose id query_every divides, over all rows but the query's own.

    Ties go to the smaller vec_id; a query with fewer candidates has all. Rows of one id are no candidates of each other;
    a repeated query gives its list once, a repeated candidate counts once with its highest score, also where rows of one id have
    different vectors. Vectors of different lengths do not meet. Every block of queries meets every block of candidates, which is the work
    that the search is: it grows with queries times rows.
    Blocks have a fixed number of rows, whatever the ids, so that no key is hot.
    """
    v = quantised(vectors, scale=scale, id_col=id_col, vector_col=vector_col)

    def pack(df: DataFrame, rows: int, name: str) -> DataFrame:
        kept = written(df.dropDuplicates(["vec_id", "x"]), f"{name}-rows")
        # as few tasks as there are full blocks, so that blocks are full however the input is dealt
        full = kept.coalesce(max(1, -(-kept.count() // rows)))
        out = written(arrow_map(full, _pack, struct(BLOCK), rows=rows), name)
        remove(df.sparkSession, kept.rostrum_path)
        return out

    x = pack(v, candidate_block, "nra-candidates")
    q = pack(v.where(F.pmod("vec_id", F.lit(query_every)) == 0), query_block, "nra-queries")
    # every block of queries meets every block of candidates of its length: an equi join of a few large rows
    named = lambda df, s: df.select("dims", F.col("n").alias(f"{s}_n"), F.col("ids").alias(f"{s}_ids"), F.col("values").alias(f"{s}_values"))
    n = max(1, min(int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")), x.count()))
    # a block of candidates goes to one of n places, a block of queries to all; merged, since Spark judges the copied queries by
    # their file before it is copied and compressed, and would broadcast them through the driver. The right side of a merge is held.
    salted = named(x, "x").withColumn("salt", F.pmod(F.xxhash64("x_ids"), F.lit(n)))
    met = named(q, "q").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))).join(salted.hint("merge"), ["dims", "salt"])
    found = arrow_map(met, _search, struct("query_id long, vec_id long, score long"), k=k)
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.select("query_id", F.row_number().over(order).alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
