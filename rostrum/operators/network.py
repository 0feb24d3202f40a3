"""Graphs as vertex and edge tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship

#: Edges that a task holds as adjacency at most; larger graphs are refused by betweenness and homophily rather than cut.
ADJACENCY_EDGES = 5_000_000


def clean_edges(edges: DataFrame, a: str = "src", b: str = "dst", weight: str | None = None) -> DataFrame:
    """src, dst, weight of distinct directed edges without loops."""
    w = F.sum(weight) if weight else F.count(F.lit(1))
    return edges.where(F.col(a) != F.col(b)).groupBy(F.col(a).alias("src"), F.col(b).alias("dst")).agg(w.cast("long").alias("weight"))


def degrees(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """node, in_degree, out_degree; isolated nodes only if nodes are given."""
    both = edges.select(F.col("dst").alias("node"), F.lit(1).alias("i"), F.lit(0).alias("o")).unionByName(edges.select(F.col("src").alias("node"), F.lit(0).alias("i"), F.lit(1).alias("o")))
    if nodes is not None:
        both = both.unionByName(nodes.select("node", F.lit(0).alias("i"), F.lit(0).alias("o")))
    return both.groupBy("node").agg(F.sum("i").cast("long").alias("in_degree"), F.sum("o").cast("long").alias("out_degree"))


def mutual_pairs(edges: DataFrame) -> DataFrame:
    """a < b that have edges both ways."""
    e = edges.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"), (F.col("src") < F.col("dst")).alias("up"))
    return e.groupBy("a", "b").agg(F.count_distinct("up").alias("ways")).where("ways = 2").select("a", "b")


def undirected(edges: DataFrame) -> DataFrame:
    """a < b and the sum of weights of both directions."""
    return edges.groupBy(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).agg(F.sum("weight").cast("long").alias("weight"))


def same_label_share(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """share and n of edges whose ends have one label, among those with both labels (node, label)."""
    s = labels.select(F.col("node").alias("src"), F.col("label").alias("la"))
    d = labels.select(F.col("node").alias("dst"), F.col("label").alias("lb"))
    j = edges.join(s, "src").join(d, "dst").where("la IS NOT NULL AND lb IS NOT NULL")
    return j.agg(F.avg((F.col("la") == F.col("lb")).cast("double")).alias("share"), F.count(F.lit(1)).alias("n"))


def rand_index(df: DataFrame, a: str, b: str) -> DataFrame:
    """Adjusted Rand index of two labellings of the same rows."""
    c2 = lambda c: F.sum(c * (c - 1) / 2)
    t = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    cells = t.agg(c2(F.col("n")).alias("s"), F.sum("n").alias("total"))
    ra = t.groupBy(a).agg(F.sum("n").alias("n")).agg(c2(F.col("n")).alias("sa"))
    rb = t.groupBy(b).agg(F.sum("n").alias("n")).agg(c2(F.col("n")).alias("sb"))
    j = cells.join(ra, F.lit(True)).join(rb, F.lit(True))
    expected = F.col("sa") * F.col("sb") / F.nullif(F.col("total") * (F.col("total") - 1) / 2, F.lit(0))
    most = (F.col("sa") + F.col("sb")) / 2
    return j.select(F.when(most == expected, F.lit(1.0)).otherwise((F.col("s") - expected) / (most - expected)).alias("ari"))


def modularity(edges: DataFrame, communities: DataFrame) -> DataFrame:
    """Modularity of an undirected weighted graph (a, b, weight) under communities (node, community)."""
    c = communities
    ends = edges.select(F.col("a").alias("node"), "weight").unionByName(edges.select(F.col("b").alias("node"), "weight"))
    deg = ends.join(c, "node").groupBy("community").agg(F.sum("weight").alias("d"))
    inner = edges.join(c.withColumnsRenamed({"node": "a", "community": "ca"}), "a").join(c.withColumnsRenamed({"node": "b", "community": "cb"}), "b").where("ca = cb").groupBy(F.col("ca").alias("community")).agg(F.sum("weight").alias("w"))
    m = edges.agg(F.sum("weight").alias("m"))
    j = deg.join(inner, "community", "left").join(F.broadcast(m), F.lit(True))
    return j.agg(F.sum(F.coalesce("w", F.lit(0)) / F.col("m") - (F.col("d") / (2 * F.col("m"))) ** 2).alias("modularity"))


def _held(edges: DataFrame) -> list[tuple]:
    rows = edges.select("src", "dst").limit(ADJACENCY_EDGES + 1).collect()
    if len(rows) > ADJACENCY_EDGES:
        raise ValueError(f"more than {ADJACENCY_EDGES} edges; this measure holds the graph in each task")
    return sorted((r.src, r.dst) for r in rows)


def _rows(nodes: DataFrame) -> list:
    """Rows of the nodes' table, which has no more of them than the graph may have edges."""
    rows = nodes.limit(ADJACENCY_EDGES + 1).collect()
    if len(rows) > ADJACENCY_EDGES:
        raise ValueError(f"more than {ADJACENCY_EDGES} nodes; this measure holds them in each task")
    return rows


def betweenness(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, betweenness: unweighted, directed, divided by (n - 1)(n - 2). Each task walks from its share of the sources (Brandes); the sums meet in Spark."""
    spark = edges.sparkSession
    ship(spark)
    held = _held(edges)
    names = sorted({r.node for r in _rows(nodes.select("node"))} | {x for e in held for x in e})
    number = {v: i for i, v in enumerate(names)}
    out: list[list[int]] = [[] for _ in names]
    for a, b in held:
        out[number[a]].append(number[b])
    graph = spark.sparkContext.broadcast(out)
    n = len(names)

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        adj = graph.value
        total = np.zeros(len(adj))
        for pdf in batches:
            for s in pdf["id"]:
                order, paths, depth, before = [], np.zeros(len(adj)), np.full(len(adj), -1), [[] for _ in adj]
                paths[s], depth[s], queue = 1, 0, [s]
                for v in queue:
                    order.append(v)
                    for w in adj[v]:
                        if depth[w] < 0:
                            depth[w] = depth[v] + 1
                            queue.append(w)
                        if depth[w] == depth[v] + 1:
                            paths[w] += paths[v]
                            before[w].append(v)
                share = np.zeros(len(adj))
                for w in reversed(order):
                    for v in before[w]:
                        share[v] += paths[v] / paths[w] * (1 + share[w])
                    if w != s:
                        total[w] += share[w]
        yield pd.DataFrame({"i": np.arange(len(adj)), "b": total})

    sums = spark.range(n).mapInPandas(walk, "i long, b double").groupBy("i").agg(F.sum("b").alias("b"))
    labels = spark.createDataFrame(list(enumerate(names)), ["i", "node"])
    scale = (n - 1) * (n - 2) if n > 2 else 1
    return labels.join(sums, "i").select("node", (F.col("b") / scale).alias("betweenness"))


def homophily(edges: DataFrame, labels: DataFrame, *, draws: int = 1000, seed: int = 11) -> DataFrame:
    """observed, shuffled, rewired (mean shares), ratio, p: same-label edges against label shuffles and degree-preserving rewirings.

    Every replicate has a generator of its own number, so results do not depend on how replicates are dealt.
    """
    spark = edges.sparkSession
    ship(spark)
    by = {r.node: r.label for r in _rows(labels.where("label IS NOT NULL"))}
    held = [(a, b) for a, b in _held(edges) if a in by and b in by]
    nodes = sorted(by)
    number, kinds = {v: i for i, v in enumerate(nodes)}, {k: i for i, k in enumerate(sorted(set(by.values()), key=str))}
    data = spark.sparkContext.broadcast((np.array([number[a] for a, _ in held]), np.array([number[b] for _, b in held]), np.array([kinds[by[v]] for v in nodes])))

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        src, dst, kind = data.value
        for pdf in batches:
            rows = []
            for i in pdf["id"]:
                r = np.random.default_rng([seed, int(i)])
                k = r.permutation(kind)
                rows.append((int(i), float((k[src] == k[dst]).mean()) if len(src) else 0.0, float((kind[src] == kind[r.permutation(dst)]).mean()) if len(src) else 0.0))
            yield pd.DataFrame(rows, columns=["i", "shuffled", "rewired"])

    src, dst, kind = data.value
    observed = float((kind[src] == kind[dst]).mean()) if len(src) else 0.0
    d = spark.range(draws).mapInPandas(draw, "i long, shuffled double, rewired double")
    return d.agg(F.lit(observed).alias("observed"), F.avg("shuffled").alias("shuffled"), F.avg("rewired").alias("rewired"), (F.lit(observed) / F.nullif(F.avg("rewired"), F.lit(0.0))).alias("ratio"), F.avg((F.col("rewired") >= observed).cast("double")).alias("p"))


def communities(edges: DataFrame, limit: int = 200_000) -> DataFrame:
    """node, community by greedy modularity on an undirected weighted graph (a, b, weight) of at most limit edges, merged on the driver."""
    spark = edges.sparkSession
    rows = edges.select("a", "b", "weight").limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} edges; greedy merging holds the graph on the driver")
    nodes = sorted({x for r in rows for x in (r.a, r.b)})
    m = float(sum(r.weight for r in rows)) or 1.0
    group = {v: i for i, v in enumerate(nodes)}
    link: dict[int, dict[int, float]] = {i: {} for i in range(len(nodes))}
    share = dict.fromkeys(range(len(nodes)), 0.0)
    for r in sorted(rows, key=lambda r: (r.a, r.b)):
        i, j = group[r.a], group[r.b]
        link[i][j] = link[i].get(j, 0) + r.weight / m
        link[j][i] = link[j].get(i, 0) + r.weight / m
        share[i] += r.weight / (2 * m)
        share[j] += r.weight / (2 * m)
    members = {i: [v] for v, i in group.items()}
    while True:
        best = max(((w - 2 * share[i] * share[j], -i, -j) for i in link for j, w in link[i].items() if i < j), default=None)
        if best is None or best[0] <= 1e-12:
            break
        i, j = -best[1], -best[2]
        for k, w in link.pop(j).items():
            link[k].pop(j)
            if k != i:
                link[i][k] = link[i].get(k, 0) + w
                link[k][i] = link[i][k]
        share[i] += share.pop(j)
        members[i] += members.pop(j)
    ordered = sorted(members.values(), key=lambda g: (-len(g), min(g)))
    return spark.createDataFrame([(v, k) for k, g in enumerate(ordered) for v in sorted(g)], "node long, community int" if nodes and isinstance(nodes[0], int) else "node string, community int")


def layout(edges: DataFrame, *, seed: int = 3, rounds: int = 200, limit: int = 20_000) -> DataFrame:
    """node, x, y: a force layout of a small graph (a, b, weight), the same for one seed; made on the driver."""
    spark = edges.sparkSession
    rows = sorted((r.a, r.b, r.weight) for r in edges.select("a", "b", "weight").limit(limit + 1).collect())
    if len(rows) > limit:
        raise ValueError(f"more than {limit} edges are no picture")
    nodes = sorted({x for r in rows for x in r[:2]})
    at = {v: i for i, v in enumerate(nodes)}
    w = np.zeros((len(nodes), len(nodes)))
    for a, b, x in rows:
        w[at[a], at[b]] = w[at[b], at[a]] = x
    p = np.random.default_rng(seed).random((len(nodes), 2))
    k, heat = 1 / np.sqrt(max(1, len(nodes))), 0.1
    for _ in range(rounds):
        d = p[:, None] - p[None]
        length = np.maximum(np.linalg.norm(d, axis=2), 0.01)
        move = (d * (k * k / length**2 - w * length / k / max(1.0, w.max()))[:, :, None]).sum(axis=1)
        size = np.maximum(np.linalg.norm(move, axis=1), 0.01)
        p = p + move / size[:, None] * np.minimum(size, heat)[:, None]
        heat = max(0.0, heat - 0.1 / (rounds + 1))
    return spark.createDataFrame([(v, float(p[i, 0]), float(p[i, 1])) for v, i in at.items()], ["node", "x", "y"])
