"""Document quality by Bradley-Terry ranking.

Documents of label 1 are preferred to those of label 0. A document's strength is linear in features of its text, and the
chance that one is preferred to another is the logistic function of the difference of their strengths, so the weights are those of a
logistic regression on differences of features (Newton's method with a ridge). The threshold is a quantile of the training
documents' strengths, the one that tells the labels apart best; scores are the logistic function of the strength, shifted so that the threshold scores
THRESHOLD. Features are computed where the texts are, line by line, so that a long text is never
copied more than once.

All labelled documents and all pairs of a good and a bad one are learnt from. No pair is made: what a pair adds depends on the two strengths by a
smooth function, so a document is stood for by shares of itself at NODES fixed places around its strength (Chebyshev interpolation, with an error
of about 1e-10), and sums over pairs become sums over pairs of places. A step of Newton's method is one pass over the documents, of which the sums at
the places that occur reach the driver. Blocks of documents and whole-number sums make the model the same however the rows are dealt.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, remove, struct, written

#: Ridge, and the score of the threshold.
RIDGE, THRESHOLD = 1e-2, 0.7
#: Training documents of a block, about; width of the cells that strengths fall into, and places of a cell that stand for them.
BLOCK, CELL, NODES = 8192, 2.0, 12
#: Parts of the training documents' strengths that are tried as the share below the threshold.
QUANTILES = np.linspace(0.002, 0.998, 499)
#: Marks that prose rarely has, and ASCII characters by class.
SYMBOLS, UPPER, LOWER, DIGIT = b"#$%&*+/<=>@[\\]^_`{|}~", string.ascii_uppercase.encode(), string.ascii_lowercase.encode(), b"0123456789"

NAMES = (
    "symbols", "bars", "exclaims", "upper", "digits", "odd_lines", "worst_line", "repeated_lines", "repeated_words", "few_words",
    "ends_plain", "word_length", "long_words", "short_text", "stops", "empty", "log_length", "few_lower",
)


def features(text: str | None) -> list[float]:
    """Numbers that describe a text, each between 0 and about 1; all zero but one for a text without words."""
    raw = (text or "").encode()
    words = raw.split()
    if not words:
        return [0.0] * NAMES.index("empty") + [1.0] + [0.0] * (len(NAMES) - NAMES.index("empty") - 1)
    n, k = len(raw) - sum(map(raw.count, (b" ", b"\n"))), len(words)
    n = max(1, n)

    def share(chars: bytes, of: bytes, size: int) -> float:
        return (len(of) - len(of.translate(None, chars))) / max(1, size)

    letters = n - (len(raw) - len(raw.translate(None, SYMBOLS + DIGIT + b"!?.,;:'\"()-")))
    upper, lower = share(UPPER, raw, letters), share(LOWER, raw, letters)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    odd, worst = 0, 0.0
    for x in lines:
        bad = share(SYMBOLS + b"!", x, len(x)) + max(0.0, share(UPPER, x, len(x)) - 0.3)
        worst = max(worst, bad if len(x) >= 40 else 0.0)
        odd += (bad > 0.03) * len(x)
    same = sum(a == b for a, b in pairwise(words))
    distinct = len(set(words))
    return [
        min(1.0, 10 * share(SYMBOLS.replace(b"|", b""), raw, n)), min(1.0, 10 * raw.count(b"|") / n), min(1.0, 10 * raw.count(b"!") / n),
        upper, share(DIGIT, raw, n), odd / max(1, len(raw)), min(1.0, 5 * worst), 1 - len(set(lines)) / len(lines), same / k,
        max(0.0, 1 - distinct / min(k, 40.0 + k**0.85)), sum(w[-1:].isalpha() or w[-1] >= 128 or w[-1:] in b".,;:" for w in words) / k,
        min(1.0, n / k / 20), sum(len(w) > 20 for w in words) / k, 1 / (1 + k / 10), min(1.0, 5 * sum(map(raw.count, (b". ", b".\n"))) / k),
        0.0, min(1.0, np.log1p(k) / 12), max(0.0, 0.6 - lower),
    ]


#: Where a cell's places are, between -1 and 1, and what turns Chebyshev polynomials of a strength's place into its shares at them.
PLACES = np.cos((2 * np.arange(NODES) + 1) * np.pi / (2 * NODES))
SHARES = np.linalg.inv(np.polynomial.chebyshev.chebvander(PLACES, NODES - 1))
#: The upper triangle of a square of one and all features.
ROW, COLUMN = np.triu_indices(len(NAMES) + 1)


class Ranker:
    """Weights of the features, and the line that turns a strength into a score. As made, before training, all texts score THRESHOLD."""

    def __init__(self):
        self.w, self.cut, self.slope, self.quantile = np.zeros(len(NAMES)), 0.0, 1.0, 0.0
        self.mean, self.scale = np.zeros(len(NAMES)), np.ones(len(NAMES))

    def strengths(self, x: np.ndarray) -> np.ndarray:
        """Row by row, so that a row's strength does not depend on the rows beside it."""
        return ((x - self.mean) / self.scale * self.w).sum(axis=1)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * (self.strengths(x) - self.cut) + np.log(THRESHOLD / (1 - THRESHOLD)), -30, 30)))


def _features(batches: Iterator[pa.RecordBatch], *, at: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x = [features(t) for t in b.column(at).to_pylist()]
        yield pa.RecordBatch.from_arrays([*b.columns[:at], pa.array(x, pa.list_(pa.float64()))], names=[*b.schema.names[:at], "features"])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(NAMES))


def _pack(rows: pa.Table) -> pa.Table:
    """A block of examples as two byte strings, in an order that the examples alone decide."""
    rows = rows.combine_chunks()
    x, y = _matrix(rows["features"].combine_chunks()), rows["label"].to_numpy()
    order = np.lexsort((*x.T, y))
    return pa.table({"y": pa.array([y[order].astype("<i4").tobytes()], pa.binary()), "x": pa.array([x[order].astype("<f8").tobytes()], pa.binary())})


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for b in batches:
        for y, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            yield np.frombuffer(x, "<f8").reshape(-1, len(NAMES)), np.frombuffer(y, "<i4")


def _summed(batches: Iterator[pa.RecordBatch], *, of, bits: int, **fixed) -> Iterator[pa.RecordBatch]:
    """A task's sums, by key, of what each block gives, as whole multiples of 2**-bits."""
    sums: dict[int, np.ndarray] = {}
    for x, y in _blocks(batches):
        for key, a in of(x, y, **fixed):
            sums[key] = sums.get(key, 0) + np.rint(a * 2.0**bits).astype("<i8")
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([a.tobytes() for a in sums.values()], pa.binary())], names=["key", "sums"])


def _added(rows: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(a, "<i8") for a in rows["sums"].to_pylist())
    return pa.table({"key": rows["key"][:1], "sums": pa.array([total.tobytes()], pa.binary())})


def _sums(blocks: DataFrame, of, bits: int, **fixed) -> dict[int, np.ndarray]:
    parts = arrow_map(blocks, _summed, struct("key long, sums binary"), of=of, bits=bits, **fixed)
    return {r.key: np.frombuffer(r.sums, "<i8") * 2.0**-bits for r in parts.groupBy("key").applyInArrow(_added, struct("key long, sums binary")).collect()}


def _by_label(x: np.ndarray, y: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    for label in (0, 1):
        yield label, np.append(x[y == label].sum(axis=0), (y == label).sum())


def _squares(x: np.ndarray, y: np.ndarray, *, mean: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    yield 0, ((x - mean) ** 2).sum(axis=0)


def _at_places(x: np.ndarray, y: np.ndarray, *, ranker: Ranker) -> Iterator[tuple[int, np.ndarray]]:
    """By cell and label, at each place: the shares of documents, of their features less the mean, and of the products of these."""
    one = np.hstack([np.ones((len(x), 1)), x - ranker.mean])
    products = one[:, ROW] * one[:, COLUMN]
    s = ranker.strengths(x) / CELL
    cell = np.floor(s).astype(np.int64)
    key = 2 * cell + y
    for k in np.unique(key):
        m = key == k
        shares = np.polynomial.chebyshev.chebvander(2 * (s[m] - cell[m]) - 1, NODES - 1) @ SHARES
        yield int(k), shares.T @ products[m]


def _pair_sums(sums: dict[int, np.ndarray], scale: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gradient and curvature of the mean log-likelihood of all pairs, and the covariance of the good documents' features, from the sums at places."""
    n = len(NAMES)

    def label(value: int) -> tuple[np.ndarray, ...]:
        keys = sorted(k for k in sums if k % 2 == value)
        at = np.concatenate([(k // 2 + (PLACES + 1) / 2) * CELL for k in keys])
        square = np.zeros((len(at), n + 1, n + 1))
        square[:, ROW, COLUMN] = square[:, COLUMN, ROW] = np.concatenate([sums[k].reshape(NODES, -1) for k in keys])
        return at, square[:, 0, 0], square[:, 0, 1:] / scale, square[:, 1:, 1:] / scale / scale[:, None]

    (at_g, n_g, x_g, xx_g), (at_b, n_b, x_b, xx_b) = label(1), label(0)
    gradient, cross = np.zeros(n), np.zeros((n, n))
    curve = np.zeros((n, n))
    for i in range(0, len(at_g), NODES):
        part = slice(i, i + NODES)
        wrong = 1 / (1 + np.exp(np.clip(at_g[part, None] - at_b[None, :], -500, 500)))
        gradient += x_g[part].T @ (wrong @ n_b) - x_b.T @ (n_g[part] @ wrong)
        flat = wrong * (1 - wrong)
        curve += np.tensordot(flat @ n_b, xx_g[part], 1) + np.tensordot(n_g[part] @ flat, xx_b, 1)
        cross += x_g[part].T @ flat @ x_b
    pairs = n_g.sum() * n_b.sum()
    middle = x_g.sum(axis=0) / n_g.sum()
    return gradient / pairs, (curve - cross - cross.T) / pairs, xx_g.sum(axis=0) / n_g.sum() - np.outer(middle, middle)


def _strengths(batches: Iterator[pa.RecordBatch], *, ranker: Ranker) -> Iterator[pa.RecordBatch]:
    for x, y in _blocks(batches):
        s, which, n = np.unique(ranker.strengths(x), return_inverse=True, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(s), pa.array(n.astype(np.int64)), pa.array(np.bincount(which, y == 1, len(s)).astype(np.int64))], names=["s", "n", "good"])


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted strengths of a partition, with its number and the documents up to each."""
    part, upto = TaskContext.get().partitionId(), 0
    for b in batches:
        to = upto + np.cumsum(b.column(1).to_numpy())
        upto = int(to[-1]) if len(to) else upto
        yield pa.RecordBatch.from_arrays([pa.array([part] * len(to), pa.int64()), *b.columns, pa.array(to, pa.int64())], names=["part", "s", "n", "good", "upto"])


def _of_rank(batches: Iterator[pa.RecordBatch], *, before: dict[int, int], ranks: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The strengths of those ranks that are asked for. before: documents in the partitions before each."""
    for b in batches:
        part, s, n, _, upto = (c.to_numpy() for c in b.columns)
        end = upto + np.array([before[p] for p in part.tolist()], np.int64)
        a, z = np.searchsorted(ranks, end - n), np.searchsorted(ranks, end)
        found = np.concatenate([ranks[i:j] for i, j in zip(a, z)]) if len(a) else ranks[:0]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(np.repeat(s, z - a))], names=["rank", "s"])


def _between(batches: Iterator[pa.RecordBatch], *, cuts: np.ndarray) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array(np.searchsorted(cuts, b.column(1).to_numpy(), side="right"), pa.int64()), *b.columns[1:4]], names=["slot", "s", "n", "good"])


def _cut(blocks: DataFrame, ranker: Ranker, parts: int) -> tuple[float, float]:
    """The quantile of the training strengths that tells the labels apart best, of equally good ones the lowest; and the threshold there,
    half way to the next strength on either side, so that it is no document's own. Quantiles are those of all strengths, by rank."""
    made = arrow_map(blocks, _strengths, struct("s double, n long, good long"), ranker=ranker).groupBy("s").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    ranged = made.repartitionByRange(parts, "s").sortWithinPartitions("s")
    kept = written(arrow_map(ranged, _running, struct("part long, s double, n long, good long, upto long")), "ranker-strengths")
    sizes = kept.groupBy("part").agg(F.min("s").alias("s"), F.max("upto").alias("n")).orderBy("s").collect()
    ends = np.cumsum([r.n for r in sizes])
    before, total = {r.part: int(e - r.n) for r, e in zip(sizes, ends)}, int(ends[-1])
    place = (total - 1) * QUANTILES
    low = np.floor(place).astype(np.int64)
    ranks = np.unique([low, np.minimum(low + 1, total - 1)])
    found = {r["rank"]: r.s for r in arrow_map(kept, _of_rank, struct("rank long, s double"), before=before, ranks=ranks).collect()}
    at, after, share = np.array([found[i] for i in low]), np.array([found[min(i + 1, total - 1)] for i in low]), place - low
    cuts = np.maximum.accumulate(np.where(share < 0.5, at + (after - at) * share, after - (after - at) * (1 - share)))
    slots = arrow_map(kept, _between, struct("slot long, s double, n long, good long"), cuts=cuts).groupBy("slot")
    got = slots.agg(F.sum("n").alias("n"), F.sum("good").alias("good"), F.min("s").alias("low"), F.max("s").alias("high")).collect()
    n, good = np.zeros(len(cuts) + 1, np.int64), np.zeros(len(cuts) + 1, np.int64)
    for r in got:
        n[r.slot], good[r.slot] = r.n, r.good
    good_above, bad_below = good.sum() - np.cumsum(good)[:-1], np.cumsum(n - good)[:-1]
    best = int(np.argmax((good_above + bad_below) / total + 1e-9 * good_above / good.sum()))
    lows, highs = [r.low for r in got], [r.high for r in got]
    below = max((r.high for r in got if r.slot <= best), default=min(lows))
    above = min((r.low for r in got if r.slot > best), default=max(highs))
    remove(blocks.sparkSession, kept.rostrum_path)
    return float(QUANTILES[best]), (below + above) / 2


def train(docs: DataFrame, labels: DataFrame, *, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> Ranker:
    """A ranker of the labelled documents of docs, all of them and all pairs of a good and a bad one.

    Rows of a null id or of a label other than 0 and 1 are no examples; an id with both labels is one of each, and rows of one id
    are one example. Without examples of both labels, every text scores THRESHOLD.
    """
    d = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text")).where("_id IS NOT NULL")
    return _train(arrow_map(d, _features, struct("_id long, features array<double>"), at=1), labels, label_col, id_col, block)


def _train(described: DataFrame, labels: DataFrame, label_col: str, id_col: str, block: int) -> Ranker:
    spark, ranker = described.sparkSession, Ranker()
    known = labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("int").alias("label")).where("_id IS NOT NULL AND label IN (0, 1)").distinct()
    most = known.count()
    count = max(1, -(-most // block))
    # rows of one id are one example, that of the least features, so that repeated ids do not weigh more
    rows = described.groupBy("_id").agg(F.min("features").alias("features")).join(known, "_id")
    rows = rows.select(F.pmod(F.xxhash64("_id"), F.lit(count)).alias("block"), "label", "features")
    blocks = written(rows.groupBy("block").applyInArrow(_pack, struct("y binary, x binary")), "ranker-blocks")
    # features are at most 2 and shares little over 1, so that no sum passes 2**62
    bits = 58 - most.bit_length()
    first = _sums(blocks, _by_label, bits)
    if len(first) == 2 and first[0][-1] > 0 and first[1][-1] > 0:
        n = first[0][-1] + first[1][-1]
        ranker.mean = (first[0] + first[1])[:-1] / n
        ranker.scale = np.sqrt(_sums(blocks, _squares, bits, mean=ranker.mean)[0] / n) + 1e-9
        for turn in range(26):
            gradient, curve, spread = _pair_sums(_sums(blocks, _at_places, bits, ranker=ranker), ranker.scale)
            step = np.linalg.solve(curve + RIDGE * np.eye(len(NAMES)), gradient - RIDGE * ranker.w)
            if turn == 25 or np.abs(step).max() < 1e-6:
                break
            ranker.w = ranker.w + step
        ranker.slope = float(1 / max(1e-9, np.sqrt(max(0.0, ranker.w @ spread @ ranker.w))))
        parts = min(count, int(spark.conf.get("spark.sql.shuffle.partitions")))
        ranker.quantile, ranker.cut = _cut(blocks, ranker, parts)
    remove(spark, blocks.rostrum_path)
    return ranker


def _score(batches: Iterator[pa.RecordBatch], *, ranker: Ranker) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(ranker.scores(_matrix(b.column(2))), pa.float64())], names=[*b.schema.names[:2], "score"])


def _keep(batches: Iterator[pa.RecordBatch], *, ranker: Ranker, at: int, threshold: float) -> Iterator[pa.RecordBatch]:
    for b in batches:
        s = ranker.scores(np.array([features(t) for t in b.column(at).to_pylist()]).reshape(-1, len(NAMES)))
        yield b.filter(pa.array(s >= threshold))


def held_out_rows(doc_id: Column) -> Column:
    """Whether a row is kept from training: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def quality(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: better) and predicted (1 if score >= threshold) of every row of docs.

    Labels of rows that are held out are not learnt from. A null text counts as empty; a text without words has a score like any
    other. A null id is not held out. Repeated rows give a row each, an empty table none. Other columns of docs are not read.
    """
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out_rows(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"))
    # written, as both training and scoring read them
    described = written(arrow_map(d, _features, struct("doc_id long, held_out boolean, features array<double>"), at=2), "ranker-features")
    known = described.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("_id"), "features")
    ranker = _train(known, labels.where(~held_out_rows(F.col(id_col))), "quality", id_col, BLOCK)
    out = arrow_map(described, _score, struct("doc_id long, held_out boolean, score double"), ranker=ranker)
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, ranker: Ranker, *, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """docs, all columns, without the rows that score below the threshold.

    A null text counts as empty, and an empty one has a score like any other, so it goes or stays by what the labels say of such
    texts. Repeated rows go or stay together; an empty table stays empty.
    """
    return arrow_map(docs, _keep, docs.schema, ranker=ranker, at=docs.columns.index(text_col), threshold=threshold)
