"""Exact Jaccard join of documents on word n-grams, by T-occurrence search (DivideSkip), down to connected components.

1. A document's set is hashed to 64-bit shingles. Documents of one set are a class; its smallest id stands for it from here on.
2. Two sets that link share a shingle of their prefixes: the part of a set that comes first in one order of all shingles
   and is one longer than what a partner may lack. The order is by hash, but shingles that are frequent in prefixes come last. Any
   order is exact; this one keeps a common passage or line from drawing all its documents together.
3. Classes that share a prefix shingle and are of like size gather around the smallest of them, in chunks of a fixed number of documents.
4. In a chunk, each document searches those before it: of the inverted lists of its shingles, the short ones are merged by a heap, the
   long ones are probed by bisection, and what reaches the required overlap links. The lists of one member of each group found so far are
   searched first; documents that are connected by then are not searched again, so that a group of near copies costs little more than its size.
5. Of gatherings of several chunks, members outside the largest component found so far meet every other chunk, so no pair is left out.
6. Links, at most one a document and chunk, become components.

Shingles are compared by their hash; equal hashes of different shingles are as likely as 64 bits allow.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, held, only, remove, struct, tidy, written
from .graph import components, join_small

#: Documents of a chunk. A shingle in more prefixes than FREQUENT comes last in the order; at most ORDER_LIMIT such shingles are broadcast.
CHUNK, FREQUENT, ORDER_LIMIT = 256, 4, 500_000
#: DivideSkip's parameter: the larger, the fewer lists count as long.
MU = 0.01
#: Shingles of a chunk, which bound a task's memory where documents are long; a longer document is a chunk's only one or so.
CHUNK_SHINGLES = 200_000
#: Word hashes that a worker remembers.
MEMORY = 400_000

#: Odd multipliers of the splitmix64 generator.
M1, M2, M3 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


class Hashes(dict):
    """64-bit hashes of words, made when first asked for."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMORY:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


HASHES = Hashes()
held(__name__, HASHES.clear)


def shingles(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct hashes of the text's runs of k words; of all words, if they are fewer; none without words."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words))
    size = min(k, len(w))
    n = len(w) - size + 1
    with np.errstate(over="ignore"):
        h = np.full(n, size, np.uint64)
        for i in range(size):
            h = h * M3 + w[i : n + i]
            h ^= h >> np.uint64(31)
            h *= M1
        h ^= h >> np.uint64(27)
        h *= M2
        h ^= h >> np.uint64(31)
    return np.unique(h)


def prefix_size(n: int, percent: int) -> int:
    """Shingles of a set of n of which one at least is shared with any set that links: n less the least overlap, and one."""
    return n - -(-percent * n // 100) + 1 if n else 0


def _sketch(batches: Iterator[pa.RecordBatch], *, k: int, percent: int, last) -> Iterator[pa.RecordBatch]:
    late = last.value if last is not None else None
    for b in batches:
        sizes, prints, prefixes = [], [], []
        for text in b.column(1).to_pylist():
            h = shingles(text, k)
            sizes.append(len(h))
            prints.append(hashlib.blake2b(h.tobytes(), digest_size=16).digest() if len(h) else None)
            p = prefix_size(len(h), percent)
            first = h[:p]
            if late is not None and len(first):
                at = np.searchsorted(late, h)
                at[at == len(late)] = 0
                is_late = late[at] == h
                if is_late[:p].any():
                    first = np.concatenate([h[~is_late], h[is_late]])[:p]
            prefixes.append(first.view(np.int64))
        ends = np.concatenate([[0], np.cumsum([len(x) for x in prefixes])]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int64), *prefixes])))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), lists], names=["doc_id", "n_shingles", "print", "prefix"])


def divide_skip(lists: list[list[int]], need: int, skip: set[int] | frozenset = frozenset()) -> list[tuple[int, int]]:
    """(entry, occurrences) of the entries that at least need of the sorted lists hold, but for those to skip."""
    lists = sorted((x for x in lists if x), key=len)
    if len(lists) < need:
        return []
    n_long = min(need - 1, int(need / (MU * math.log2(len(lists[-1]) + 1) + 1)))
    short, long = lists[: len(lists) - n_long], lists[len(lists) - n_long :]
    out = []
    run, count = None, 0

    def close() -> None:
        if run is None or count < need - n_long or run in skip:
            return
        total = count
        for i, x in enumerate(long):
            if total + n_long - i < need:
                return
            at = bisect_left(x, run)
            total += at < len(x) and x[at] == run
        if total >= need:
            out.append((run, total))

    for entry in heapq.merge(*short):
        if entry == run:
            count += 1
        else:
            close()
            run, count = entry, 1
    close()
    return out


class Forest:
    """Union-find over numbers."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b


def search(sets: list[np.ndarray], known: list, percent: int) -> list[tuple[int, int]]:
    """Links (numbers of sets) that connect, with what is known (equal labels, not None), all that link among the sets.

    Each set searches those before it twice, both times by DivideSkip: first the inverted lists of one member of each component so far, which
    are short, so that near copies find their group at once; then the lists of all, without the components it belongs to by now.
    """
    n = len(sets)
    order = sorted(range(n), key=lambda i: len(sets[i]))
    sizes = [len(sets[i]) for i in order]
    forest, first = Forest(n), {}
    for place, i in enumerate(order):
        if known[i] is not None:
            forest.join(first.setdefault(known[i], place), place)
    members: dict[int, list[int]] = defaultdict(list)
    df = Counter()
    for s in sets:
        df.update(s.tolist())
    lists: dict[int, list[int]] = {h: [] for h, c in df.items() if c > 1}
    bags: list[list[int]] = []
    links = []
    # one member of each component of several, by its root, and the lists of these members alone
    stands: dict[int, int] = {}
    short: dict[int, list[int]] = defaultdict(list)

    def overlap_of(a: int, b: int) -> int:
        return -(-percent * (sizes[a] + sizes[b]) // (100 + percent))

    def stand_down(root: int) -> None:
        if root in stands:
            x = stands.pop(root)
            for h in bags[x]:
                short[h].remove(x)

    def link(a: int, b: int) -> None:
        ra, rb = forest.root(a), forest.root(b)
        if forest.join(a, b):
            links.append((order[a], order[b]))
            keep = forest.root(a)
            gone = rb if keep == ra else ra
            stand_down(gone)
            members[keep] += members.pop(gone, [])

    def found(q: int, bag: list[int], among: dict[int, list[int]], low: int, skip: frozenset) -> None:
        need = overlap_of(q, low)
        if len(bag) < need:
            return
        others = [y for h in bag if h in among and (y := [x for x in among[h][bisect_left(among[h], low) :] if x not in skip])]
        for x, total in divide_skip(others, need):
            if total >= overlap_of(q, x) and forest.root(x) != forest.root(q):
                link(q, x)

    for q in range(n):
        bag = [h for h in sets[order[q]].tolist() if h in lists]
        low = bisect_left(sizes, -(-percent * sizes[q] // 100), 0, q)
        if sizes[q]:
            if stands:
                found(q, bag, short, low, frozenset())
            own = frozenset(x for x in members.get(forest.root(q), ()) if x >= low)
            if q - low > len(own):
                found(q, bag, lists, low, own)
        bags.append(bag)
        root = forest.root(q)
        members[root].append(q)
        for h in bag:
            lists[h].append(q)
        if len(members[root]) > 1:
            stand_down(root)
            stands[root] = q
            for h in bag:
                short[h].append(q)
    return links


def _search(group: pa.Table, *, k: int, percent: int) -> pa.Table:
    only(__name__)
    ids, known = group.column("doc_id").to_pylist(), group.column("known").to_pylist()
    sets = [shingles(t, k) for t in group.column("text").to_pylist()]
    first: dict = {}
    for i, d in enumerate(ids):  # rows of one id are one document
        known[i] = known[i] if known[i] is not None else d
        first.setdefault(d, known[i])
        known[i] = first[d]
    found = search(sets, known, percent)
    return pa.table({"a": pa.array([ids[a] for a, _ in found], pa.int64()), "b": pa.array([ids[b] for _, b in found], pa.int64())})


def _links(texts: DataFrame, groups: DataFrame, keys: list[str], k: int, percent: int) -> DataFrame:
    """Search in every group of groups (keys, doc_id, known), with the documents' texts."""
    rows = join_small(texts, groups, "doc_id").select(*keys, "doc_id", "known", "text")

    def run(group):
        return _search(group, k=k, percent=percent)

    run.__annotations__ = {"group": pa.Table, "return": pa.Table}  # Spark reads them to tell what it hands over
    return rows.groupBy(*keys).applyInArrow(run, struct("a long, b long"))


def jaccard_components(docs: DataFrame, *, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of docs: documents link when 100 * intersection >= percent * union.

    component_id is the smallest doc_id that links reach, a document's own included. A document without text or words has
    no shingles and links with nothing. Rows of one doc_id are one document, and so are connected. A row of a null
    doc_id takes the component of its set's class (null if all its ids are null), but makes no links of its own. An empty table gives no rows.
    Other columns are not read.
    """
    spark = docs.sparkSession
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = struct("doc_id long, n_shingles long, print binary, prefix array<long>")
    sketch = written(arrow_map(d, _sketch, schema, k=k, percent=percent, last=None), "sketch")

    def classes(s: DataFrame) -> DataFrame:
        return s.where("print IS NOT NULL AND doc_id IS NOT NULL").groupBy("print").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n"))

    copies = written(classes(sketch.drop("prefix")).where("n > 1").drop("n"), "copies")

    def buckets(s: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Rows (h, doc_id, n_shingles) of the classes' prefixes, and the shingles that several of them have."""
        one = join_small(s.where("print IS NOT NULL AND doc_id IS NOT NULL"), copies, "print", "left").where("rep IS NULL OR rep = doc_id")
        rows = one.select("doc_id", "n_shingles", F.explode("prefix").alias("h"))
        many = rows.groupBy("h").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("top"), F.count(F.lit(1)).alias("n")).where("low < top")
        return rows, written(many.select("h", "n"), "buckets")

    rows, many = buckets(sketch)
    limit = frequent
    while (late := many.where(F.col("n") > limit)).limit(ORDER_LIMIT + 1).count() > ORDER_LIMIT:
        limit *= 4
    order = np.sort(np.array([r.h for r in late.select("h").toLocalIterator()], np.int64).view(np.uint64))
    if len(order):
        late_sketch = written(arrow_map(d, _sketch, schema, k=k, percent=percent, last=spark.sparkContext.broadcast(order)), "sketch")
        remove(spark, sketch.rostrum_path)
        remove(spark, many.rostrum_path)
        del rows, many
        tidy(spark)
        sketch = late_sketch
        rows, many = buckets(sketch)

    # sets that link differ in size by less than one band, so each goes to its own band and the next
    shared = written(join_small(rows, many.select("h"), "h"), "shared")
    tidy(spark)
    band = F.floor(F.log(F.col("n_shingles").cast("double")) / (math.log(100 / percent) * (1 + 1e-9) if percent < 100 else 1e-9)).cast("long")
    banded = shared.select("h", "doc_id", "n_shingles", F.explode(F.array(band, band + 1)).alias("band"))
    pivots = written(banded.groupBy("h", "band").agg(F.min("doc_id").alias("pivot"), F.max("doc_id").alias("top")).where("pivot < top").drop("top"), "pivots")
    gather = written(join_small(banded, pivots, ["h", "band"]).where("doc_id <> pivot").select("pivot", "doc_id", "n_shingles").distinct(), "gatherings")
    for x in (many, shared, pivots):
        remove(spark, x.rostrum_path)
    tidy(spark)
    many_of = F.greatest(F.ceil(F.count(F.lit(1)) / chunk), F.ceil(F.sum("n_shingles") / CHUNK_SHINGLES)).cast("int")
    large = written(gather.groupBy("pivot").agg(many_of.alias("chunks")).where("chunks > 1"), "large")
    put = join_small(gather, large, "pivot", "left").select("pivot", "doc_id", "n_shingles", F.pmod(F.xxhash64("doc_id"), F.coalesce("chunks", F.lit(1))).cast("int").alias("chunk"))
    # the pivot is in every chunk of its gathering
    pivots = put.select("pivot", "chunk").distinct().select("pivot", F.col("pivot").alias("doc_id"), F.lit(0).cast("long").alias("n_shingles"), "chunk")
    groups = written(put.unionByName(pivots).withColumn("known", F.lit(None).cast("long")), "groups")
    links = written(_links(d, groups, ["pivot", "chunk"], k, percent), "links")
    labels = written(components(links), "components")

    if not large.isEmpty():
        wide = join_small(groups.drop("known"), large, "pivot").dropDuplicates(["pivot", "chunk", "doc_id"])
        wide = join_small(wide, labels.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("pivot", "chunk", "chunks", "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("known"))
        wide = written(wide, "wide")
        most = wide.groupBy("pivot", "known").agg(F.count(F.lit(1)).alias("n")).groupBy("pivot").agg(F.max_by("known", F.struct("n", "known")).alias("most"))
        rest = join_small(wide, written(most, "most"), "pivot").where("known <> most")
        if not rest.isEmpty():
            # blocks of the rest meet every other chunk of their gathering
            parts = written(rest.groupBy("pivot").agg(F.greatest(many_of, F.lit(1)).alias("parts")), "parts")
            split = join_small(rest, parts, "pivot").select("pivot", "chunks", "doc_id", "known", "parts", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("parts")).cast("int").alias("part"))
            a = split.select("pivot", "doc_id", "known", "part", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
            b = join_small(wide, parts, "pivot").select("pivot", "doc_id", "known", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "chunk")
            both = written(a.unionByName(b).dropDuplicates(["pivot", "part", "chunk", "doc_id"]), "groups")
            more = _links(d, both, ["pivot", "part", "chunk"], k, percent)
            links = written(links.unionByName(more), "links")
            labels = written(components(links), "components")

    out = join_small(sketch.select("doc_id", "n_shingles", "print"), copies, "print", "left")
    out = join_small(out.withColumn("node", F.coalesce("rep", "doc_id")), labels, "node", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "node").alias("component_id"))


def deduplicate(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """docs, all columns, with one document of each component: that of the smallest id. Rows without shingles or id stay.

    Rows of one id are one document, so all of them stay or go together: of an id that occurs twice, equal rows or not, both rows stay if the
    document does. Null texts, empty ones and null ids link with nothing; an empty table stays empty.
    """
    found = jaccard_components(docs, id_col=id_col, text_col=text_col, **params)
    gone = written(found.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("gone_id")).distinct(), "gone")
    return docs.join(F.broadcast(gone) if gone.count() <= 300_000 else gone, docs[id_col] == gone["gone_id"], "left_anti")
