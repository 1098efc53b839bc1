"""Approximate nearest neighbours by learned partitions.

A bounded sample of the vectors is joined into a nearest-neighbour graph; the graph is cut into
parts of equal size with few edges between them (recursive bisection: a split along the main
direction, then swaps that lower the number of cut edges). A small network learns to tell a
vector's part, its targets being the parts of the vector's graph neighbours. It routes every
vector of the table to one part (the index holds all rows) and every query to its few most
probable parts, whose members are reranked by exact distance.

Parts grow in number with the table up to ``MOST_PARTS``; a part's members are split into chunks
by a hash of the id, so that many equal vectors make no large task. Queries go to all chunks of
their parts, and the best of each chunk are merged.

An exact check follows: a part's members lie in a ring around their mean, which bounds their distance
to a query from below. A query goes on to the parts that the router left out wherever that bound is
within the distance of its ``k``-th found so far, so that nothing is missed on any table; where the
router has done well on clustered vectors, few parts are left.

Results of the awkward cases: vectors that are null, zero, of another length than most, or that
hold null or non-finite components take no part, nor do rows without an id; equal distances go to
the smaller id; of rows that share an id and a vector one is kept, and rows of the query's own id
are no candidates for it; with fewer than ``k`` candidates all of them are returned; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.operators.vectors import mean_vectors
from cohortlens.session import reliable_checkpoint

#: Largest number of vectors that the partition and the router are learned from.
SAMPLE = 8192
ROWS_PER_PART = 1024
MOST_PARTS = 128
CHUNK_ROWS = 32768
QUERY_ROWS = 256
#: Parts that are searched stop growing once they hold this share of the router's probability ...
ROUTED = 0.995
#: ... and at this share of all parts, at least LEAST_PROBES.
MOST_PROBED = 0.3
LEAST_PROBES = 4
GRAPH_NEIGHBOURS = 10


def usable(vectors: DataFrame) -> DataFrame:
    """Ids and vectors, as doubles, that take part in the search."""
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)
    )
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(~bad & F.exists("v", lambda x: x != 0))
    common = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    return rows.where(F.size("v") == (common["d"] if common else 0)).dropDuplicates(["vec_id", "v"])


def matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def neighbours(x: np.ndarray, k: int) -> np.ndarray:
    """Nearest others of each sample row."""
    squares, found = (x**2).sum(1), []
    for a in range(0, len(x), 64):
        d = squares[a : a + 64, None] + squares[None, :] - 2 * x[a : a + 64] @ x.T
        d[np.arange(len(d)), np.arange(a, a + len(d))] = np.inf
        found.append(np.argpartition(d, min(k, d.shape[1] - 1), 1)[:, :k])
    return np.concatenate(found)


def bisect(x: np.ndarray, graph: np.ndarray, rows: np.ndarray, rounds: int = 12) -> np.ndarray:
    """Halve ``rows`` evenly so that few graph edges are cut; returns the side of each."""
    centred = x[rows] - x[rows].mean(0)
    main = np.linalg.svd(centred[:: max(1, len(rows) // 1024)], full_matrices=False)[2][0]
    side = np.zeros(len(rows), bool)
    side[np.argsort(centred @ main, kind="stable")[len(rows) // 2 :]] = True
    place = np.full(len(x), -1)
    place[rows] = np.arange(len(rows))
    near = place[graph[rows]]
    a, b = np.repeat(np.arange(len(rows)), near.shape[1])[near.ravel() >= 0], near.ravel()[near.ravel() >= 0]
    for _ in range(rounds):
        to_one = np.bincount(a, side[b], len(rows)) + np.bincount(b, side[a], len(rows))
        edges = np.bincount(a, minlength=len(rows)) + np.bincount(b, minlength=len(rows))
        gain = np.where(side, edges - 2 * to_one, 2 * to_one - edges)  # edges won by changing side
        zero, one = np.flatnonzero(~side), np.flatnonzero(side)
        zero, one = zero[np.argsort(-gain[zero], kind="stable")], one[np.argsort(-gain[one], kind="stable")]
        n = min(len(zero), len(one))
        swaps = int(((gain[zero[:n]] + gain[one[:n]]) > 0).sum())
        if not swaps:
            break
        swaps = max(1, swaps // 2)  # neighbours that swap together would cancel out
        side[zero[:swaps]], side[one[:swaps]] = True, False
    return side


def partition(x: np.ndarray, graph: np.ndarray, parts: int) -> np.ndarray:
    """Balanced parts of the sample's graph; ``parts`` is a power of two."""
    part, rows_of = np.zeros(len(x), np.int64), [np.arange(len(x))]
    while len(rows_of) < parts:
        halves = []
        for rows in rows_of:
            side = bisect(x, graph, rows)
            halves += [rows[~side], rows[side]]
        rows_of = halves
    for p, rows in enumerate(rows_of):
        part[rows] = p
    return part


@dataclass
class Router:
    """One hidden layer and a softmax over parts."""

    mean: np.ndarray
    scale: float
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum((x - self.mean) / self.scale @ self.w1 + self.b1, 0)
        z = hidden @ self.w2 + self.b2
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


def fit_router(x: np.ndarray, target: np.ndarray, hidden: int = 128, epochs: int = 30, rate: float = 4e-3, seed: int = 5) -> Router:
    rng = np.random.default_rng(seed)
    mean, scale = x.mean(0), float(x.std() or 1.0)
    z, d, p = (x - mean) / scale, x.shape[1], target.shape[1]
    params = [rng.normal(0, (2 / d) ** 0.5, (d, hidden)), np.zeros(hidden), rng.normal(0, (1 / hidden) ** 0.5, (hidden, p)), np.zeros(p)]
    first, second, step = [np.zeros_like(w) for w in params], [np.zeros_like(w) for w in params], 0
    for epoch in range(epochs):
        order = rng.permutation(len(z))
        for a in range(0, len(z), 256):
            rows = order[a : a + 256]
            h = np.maximum(z[rows] @ params[0] + params[1], 0)
            o = h @ params[2] + params[3]
            o = np.exp(o - o.max(1, keepdims=True))
            o = (o / o.sum(1, keepdims=True) - target[rows]) / len(rows)
            back = (o @ params[2].T) * (h > 0)
            step += 1
            for i, g in enumerate((z[rows].T @ back, back.sum(0), h.T @ o, o.sum(0))):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                params[i] -= rate * (1 - epoch / epochs) * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return Router(mean, scale, *params)


def learn(vectors: DataFrame, n: int) -> tuple[Router, int]:
    """Router and number of parts, from the ``SAMPLE`` rows with the smallest hash of their vector."""
    drawn = F.xxhash64("v")
    different = vectors.agg(F.approx_count_distinct(drawn)).first()[0]
    # few more than wanted are compared and sent to the driver
    most = int((min(1.0, 1.5 * SAMPLE / max(different, 1)) - 0.5) * 2.0**64)
    some = vectors.where(drawn <= F.lit(min(most, 2**63 - 1))).select("v").distinct()
    sample = some.orderBy(drawn, "v").limit(SAMPLE)

    def fit(table: pa.Table) -> pa.Table:
        return pa.table({"fitted": pa.array([pickle.dumps(fit_parts(matrix(table.column("v")), n))])})

    # the sample is learned from in a task; the driver holds the network's weights only
    return pickle.loads(sample.groupBy().applyInArrow(fit, "fitted binary").first()["fitted"])


def fit_parts(x: np.ndarray, n: int) -> tuple[Router, int]:
    """Router and number of parts of a table of ``n`` rows, from a sample."""
    parts = 1
    while parts < MOST_PARTS and parts * ROWS_PER_PART * 2 <= n and parts * 32 <= len(x):
        parts *= 2
    if parts == 1:
        return Router(np.zeros(x.shape[1]), 1.0, np.zeros((x.shape[1], 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)), 1
    graph = neighbours(x, min(GRAPH_NEIGHBOURS, len(x) - 1))
    part = partition(x, graph, parts)
    target = np.zeros((len(x), parts))
    for j in range(graph.shape[1]):
        target[np.arange(len(x)), part[graph[:, j]]] += 1 / graph.shape[1]
    target[np.arange(len(x)), part] += 1
    return fit_router(x, target / 2), parts


def routed(rows: DataFrame, router: Router) -> DataFrame:
    """Rows with their most probable ``part``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                part = router.scores(matrix(batch.column("v"))).argmax(1)
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), pa.array(part.astype(np.int32))], ["vec_id", "v", "part"])

    return rows.mapInArrow(run, "vec_id long, v array<double>, part int")


def probed(rows: DataFrame, router: Router, parts: int) -> DataFrame:
    """Rows with ``parts``: all that a query searches first."""
    most = max(LEAST_PROBES, int(np.ceil(MOST_PROBED * parts)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            share = router.scores(matrix(batch.column("v")))
            order = np.argsort(-share, 1, kind="stable").astype(np.int32)
            ordered = np.take_along_axis(share, order, 1)
            rank = np.arange(parts)[None, :]
            taken = (rank < LEAST_PROBES) | (np.cumsum(ordered, 1) - ordered < ROUTED) & (rank < most)
            lists = pa.array([o[t] for o, t in zip(order, taken)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), lists], ["vec_id", "v", "parts"])

    return rows.mapInArrow(run, "vec_id long, v array<double>, parts array<int>")


def rings(index: DataFrame, sizes: dict[int, int]) -> dict[int, tuple[np.ndarray, float, float]]:
    """Mean of each part, and the least and largest distance of its members from it."""
    means = mean_vectors(index, "part", "v").collect()  # a row per part
    centres = {r["part"]: np.array(r["vector"]) for r in means}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, x = batch.column("part").to_numpy(), matrix(batch.column("v"))
            for p in np.unique(part):
                d = lengths(x[part == p] - centres[p])
                yield pa.RecordBatch.from_pydict({"part": pa.array([p], pa.int32()), "least": [d.min()], "most": [d.max()]})

    found = index.mapInArrow(run, "part int, least double, most double")
    found = found.groupBy("part").agg(F.min("least").alias("least"), F.max("most").alias("most")).collect()  # a row per part
    return {r["part"]: (centres[r["part"]], r["least"], r["most"]) for r in found if r["part"] in sizes}


def lengths(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x**2).sum(1))


def left_out(asked: DataFrame, best: DataFrame, parts: dict[int, tuple[np.ndarray, float, float]], k: int) -> DataFrame:
    """Queries with the parts not searched yet that may hold one of their ``k`` nearest."""
    last = best.groupBy("query_id").agg(F.max("score").alias("last"), F.count("*").alias("n"))
    last = last.select(F.col("query_id").alias("vec_id"), F.when(F.col("n") >= k, F.col("last")).alias("last"))
    rows = asked.join(last, "vec_id", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = np.array(sorted(parts), np.int32)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column("v"))
            last = batch.column("last").fill_null(np.inf).to_numpy()
            wanted = np.zeros((len(x), len(numbers)), bool)
            for j, p in enumerate(numbers):
                centre, least, most = parts[p]
                d = lengths(x - centre)
                # a little less than the bound, for rounding; what can't be computed is searched
                bound = np.maximum(d - most, least - d) - 1e-9 * (d + most)
                wanted[:, j] = ~(bound > last)
            lists = [numbers[w & ~np.isin(numbers, seen)] for w, seen in zip(wanted, batch.column("parts").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), pa.array(lists, pa.list_(pa.int32()))], ["vec_id", "v", "parts"])

    return rows.mapInArrow(run, "vec_id long, v array<double>, parts array<int>")


def chunk_nearest(ids: np.ndarray, x: np.ndarray, names: np.ndarray, q: np.ndarray, k: int) -> pd.DataFrame:
    """The ``k`` nearest members of a chunk for each query, by the exact distance.

    Products around the chunk's mean tell who may be among them; where they overflow, everybody may.
    """
    centre, out = x.mean(0), []
    with np.errstate(over="ignore", invalid="ignore"):
        z = x - centre
        squares = (z**2).sum(1)
        for a in range(0, len(q), QUERY_ROWS):
            name, v = names[a : a + QUERY_ROWS], q[a : a + QUERY_ROWS]
            y = v - centre
            own = (y**2).sum(1)
            rough = squares[None, :] + own[:, None] - 2 * y @ z.T
            rough[ids[None, :] == name[:, None]] = np.inf
            spare = 1e-12 * (squares.max() + own) * (1 + x.shape[1])
            at = min(k, len(x)) - 1
            limit = np.partition(rough, at, 1)[:, at] + 2 * spare
            for row in range(len(v)):
                near = np.flatnonzero(~(rough[row] > limit[row]))
                score = np.sqrt(((x[near] - v[row]) ** 2).sum(1))
                score[ids[near] == name[row]] = np.inf
                first = np.lexsort((ids[near], score))
                first = first[np.isfinite(score[first])][:k]
                out.append((np.full(len(first), name[row]), ids[near[first]], score[first]))
    return pd.DataFrame({c: np.concatenate([o[i] for o in out]) for i, c in enumerate(("query_id", "vec_id", "score"))})


def nearest(vectors: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """The ``k`` nearest of each query row among all rows but those of its own id."""
    rows = reliable_checkpoint(usable(vectors))
    n = rows.count()
    schema = "query_id long, vec_id long, score double"
    if not n:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    router, parts = learn(rows, n)
    index = reliable_checkpoint(routed(rows, router))
    sizes = {r["part"]: r["n"] for r in index.groupBy("part").agg(F.count("*").alias("n")).collect()}  # a row per part
    chunks = F.create_map(*[F.lit(x) for p, size in sizes.items() for x in (p, -(-size // CHUNK_ROWS))])
    members = index.withColumn("chunk", F.pmod(F.xxhash64("vec_id"), chunks[F.col("part")]).cast("int"))

    def rerank(key: tuple, queries: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(found):
            return pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        x, q = np.stack(found["v"].to_numpy()), np.stack(queries["v"].to_numpy())
        return chunk_nearest(found["vec_id"].to_numpy(), x, queries["vec_id"].to_numpy(), q, k)

    def search(queries: DataFrame) -> DataFrame:
        """The best of every chunk of the parts that each query names."""
        asked = queries.select("vec_id", "v", F.explode("parts").alias("part"))
        asked = asked.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.coalesce(chunks[F.col("part")], F.lit(0)) - 1, F.lit(1)))).where(F.col("chunk") >= 0)
        asked = asked.withColumn("chunk", F.col("chunk").cast("int"))
        keys = ("part", "chunk")
        return asked.groupBy(*keys).cogroup(members.groupBy(*keys)).applyInPandas(rerank, schema)

    def first(found: DataFrame) -> DataFrame:
        found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
        return found.withColumn("rank", rank).where(F.col("rank") <= k)

    asked = reliable_checkpoint(probed(rows.where(is_query), router, parts))
    best = first(search(asked))
    if parts > 1:
        best = reliable_checkpoint(best.drop("rank"))
        more = search(left_out(asked, best, rings(index, sizes), k))
        best = first(best.unionByName(more.select(*best.columns)))
    return best.select("query_id", "rank", "vec_id", "score")
