"""Exact nearest neighbours over vector columns."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.functions.ordering import top_n
from cohortlens.session import shuffle_width

#: Rows and numbers in a block of vectors: up to the larger block while it has few rows, as each side is moved once per
#: block of the other; blocks of short vectors are bounded by their rows, each of which takes memory of its own; blocks of
#: sparse vectors become dense and hold 16,384 queries and 4096 items at most.
BLOCK_NUMBERS = 2**22
LARGE_BLOCK_NUMBERS = 2**24
LARGE_BLOCK_ROWS = 2**18
SHORT_BLOCK_ROWS = 2**19
QUERY_BLOCK = 16384
ITEM_BLOCK = 4096
#: Pairs of blocks that there are at least, for the sake of parallel tasks.
BLOCK_PAIRS = 48
#: Partitions that pairs of blocks are dealt over, so that few pairs meet in a task.
PAIR_PARTITIONS = 512
#: Bytes of a row that is found in a block.
FOUND_BYTES = 24
CHUNK = 1024
BOX = 128
#: Rows found in a chunk are cut to the best ones when there are more than these and than twice the wanted ones.
KEPT_ROWS = 2**14
PAIR_SCHEMA = "query_id long, item_id long, score double"


def unit(vector: Column) -> Column:
    """The vector at length one (unchanged when it is all zero)."""
    v = F.transform(vector, lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
    return F.when(norm > 0, F.transform(v, lambda x: x / norm)).otherwise(v)


def mean_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Mean vector per key, combined map-side: (key, vector)."""
    mean = Summarizer.mean(array_to_vector(F.col(vector)))
    return df.groupBy(key).agg(mean.alias("_mean")).select(key, vector_to_array("_mean").alias("vector"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two array columns, 0 when one of them is all zero."""
    return F.coalesce(F.try_divide(dot(a, b), norm(a) * norm(b)), F.lit(0.0))


def most_similar(
    queries: DataFrame,
    items: DataFrame,
    k: int,
    same: bool = True,
    lower: float | None = None,
    dims: int | None = None,
) -> DataFrame:
    """The ``k`` items of highest cosine for every query: (query_id, item_id, score, rank).

    Both inputs are ``(id, vector)`` with unique ids; with ``same=False`` an item is no
    neighbour of the query of equal id. See ``best_products`` for how it runs.
    """
    best = best_products(with_length(queries, dims), with_length(items, dims), k, same, lower, dims)
    return top_n(best, "query_id", [F.desc("score"), F.asc("item_id")], k)


def with_length(df: DataFrame, dims: int | None) -> DataFrame:
    """Arrays come with the length that a block divides them by (1 when all zero), so that single
    precision is moved as it is; sparse vectors are expected to be of length one already."""
    if dims is not None:
        return df.select("id", "vector")
    single = df.schema["vector"].dataType == T.ArrayType(T.FloatType(), df.schema["vector"].dataType.containsNull)
    v = F.transform("vector", lambda x: x.cast("double"))
    length = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
    return df.select("id", ("vector" if single else v.alias("vector")), F.when(length > 0, length).otherwise(1.0).alias("length"))


def product_ceilings(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Largest dot product of each row of ``a`` with any vector between ``low`` and ``high``."""
    return np.maximum(a, 0) @ high.T + np.minimum(a, 0) @ low.T


def best_products(
    queries: DataFrame,
    items: DataFrame,
    k: int,
    same: bool = True,
    lower: float | None = None,
    dims: int | None = None,
    decimals: int | None = 6,
    kernel: Callable[[np.ndarray, np.ndarray], np.ndarray] = np.matmul,
    ceilings: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray] = product_ceilings,
) -> DataFrame:
    """Highest dot products per query and item block: (query_id, item_id, score).

    Rows are spread over large blocks by a hash of the id, and each pair of blocks is a task's work:
    neither side is copied more often than the other has blocks, and per query and item block at
    most ``k`` rows are shuffled. Of the cuts with enough pairs, the one that moves least is taken. Inside a pair the items lie in small boxes of near vectors; a box
    is scored for the queries only that it could still give one of their ``k`` best, by the largest
    score in the box (``ceilings``). A column ``without`` of the queries lists items that a query
    does not want; each of them goes to the item's block only. Vectors with a column ``length`` are divided by it. With ``dims`` the vectors are sparse ``struct<i, v>`` and made dense inside a block.
    Scores are ranked and returned with ``decimals`` decimals (None: as they are); the caller picks
    the final first ones. Another ``kernel`` scores the rows of a matrix with the columns of another
    in place of the dot product, and comes with its ``ceilings``; one with a method ``above`` finds
    the pairs that reach a score without scoring all of them in full.
    """
    if dims is None:
        width = max(items.select(F.max(F.size("vector"))).first()[0] or 1, 1)
        large = min(LARGE_BLOCK_ROWS, LARGE_BLOCK_NUMBERS // width)
        query_block = item_block = max(ITEM_BLOCK, min(SHORT_BLOCK_ROWS, BLOCK_NUMBERS // width), large)
    else:
        width = 1
        query_block, item_block = QUERY_BLOCK, max(256, min(ITEM_BLOCK, 2**24 // dims))
    parallel = shuffle_width(queries.sparkSession)
    rows = queries.count(), items.count()
    least = blocks_of(queries, query_block, rows[0]), blocks_of(items, item_block, rows[1])
    n_query, n_item = block_counts(*rows, *least, parallel, width, k)
    block_of = lambda c: F.pmod(F.xxhash64(c.cast("long")), F.lit(n_item))
    extra = [c for c in ("length", "without") if c in queries.columns]
    asked, rest = queries.select("id", "vector", *extra), extra
    if "without" in extra:
        asked = asked.withColumn("_places", F.transform("without", block_of))
        here = F.filter("without", lambda c, i: F.get(F.col("_places"), i) == F.col("ib"))
        extra, rest = [*extra, "_places"], [*[c for c in extra if c != "without"], here.alias("without")]
    left = asked.select(
        F.pmod(F.xxhash64("id"), F.lit(n_query)).alias("qb"),
        F.explode(block_numbers(n_item)).alias("ib"),
        F.col("id").cast("long").alias("id"),
        "vector",
        *extra,
    ).select("qb", "ib", "id", "vector", *rest)
    right = items.select(
        F.explode(block_numbers(n_query)).alias("qb"),
        block_of(F.col("id")).alias("ib"),
        F.col("id").cast("long").alias("id"),
        "vector",
        *[c for c in ["length"] if c in items.columns],
    )
    options = {"same": same, "lower": lower, "decimals": decimals, "kernel": kernel, "ceilings": ceilings}
    parts = max(parallel, min(4 * n_query * n_item, PAIR_PARTITIONS))
    if dims is not None:
        left = left.withColumn("k", F.lit(k))
    pairs = left.repartition(parts, "qb", "ib").groupBy("qb", "ib").cogroup(right.repartition(parts, "qb", "ib").groupBy("qb", "ib"))
    if dims is not None:
        return pairs.applyInPandas(partial(block_best, dims=dims, **options), PAIR_SCHEMA)
    return pairs.applyInArrow(partial(table_best, k=k, **options), PAIR_SCHEMA)


def blocks_of(df: DataFrame, size: int, rows: int | None = None) -> int:
    """Number of blocks of about ``size`` rows (``rows``: how many there are, where known)."""
    return max(1, -(-(df.count() if rows is None else rows) // size))


def block_counts(queries: int, items: int, least_query: int, least_item: int, parallel: int, width: int, k: int) -> tuple[int, int]:
    """Numbers of query and item blocks: at least those, enough pairs, and the fewest bytes moved."""
    # a block has about 512 rows at least
    pairs = max(1, min(BLOCK_PAIRS, parallel, queries // 512))
    cuts = []
    for n_item in range(least_item, max(least_item, min(pairs, items // 512)) + 1):
        n_query = max(least_query, -(-pairs // n_item))
        moved = n_item * queries * (8 * width + k * FOUND_BYTES) + n_query * items * 8 * width
        cuts.append((moved, n_query, n_item))
    return min(cuts)[1:]


def block_numbers(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def dense(rows: pd.DataFrame, dims: int | None) -> np.ndarray:
    vectors = rows["vector"]
    if dims is None:
        out = np.stack(vectors.to_numpy()).astype(float, copy=False)
        return out / rows["length"].to_numpy()[:, None] if "length" in rows else out
    out = np.zeros((len(vectors), dims))
    for row, v in enumerate(vectors):
        out[row, np.asarray(v["i"], dtype=int)] = v["v"]
    return out


def boxes_of(x: np.ndarray, size: int) -> list[np.ndarray]:
    """Row numbers in groups of near vectors, by halving along the widest column."""
    whole, out = [np.arange(len(x))], []
    while whole:
        rows = whole.pop()
        if len(rows) <= size:
            out.append(rows)
            continue
        some = x[rows[:: max(1, len(rows) // 256)]]
        half = len(rows) // 2
        order = np.argpartition(x[rows, np.ptp(some, axis=0).argmax()], half)
        whole += [rows[order[half:]], rows[order[:half]]]
    return out


@dataclass
class Queries:
    """Ids, vectors and wanted numbers of some queries; unwanted items as one array with the number of each query's."""

    ids: np.ndarray
    x: np.ndarray
    k: np.ndarray
    unwanted: tuple[np.ndarray, np.ndarray] | None = None

    @classmethod
    def of(cls, rows: pd.DataFrame, dims: int | None) -> Queries:
        unwanted = None
        if "without" in rows:
            lists = [np.zeros(0, np.int64) if w is None else np.asarray(w, np.int64) for w in rows["without"]]
            unwanted = np.concatenate([np.zeros(0, np.int64), *lists]), np.array([len(w) for w in lists], int)
        return cls(rows["id"].to_numpy(), dense(rows, dims), rows["k"].to_numpy(), unwanted)

    def take(self, rows: np.ndarray) -> Queries:
        unwanted = None
        if self.unwanted is not None:
            ids, sizes = self.unwanted
            n = sizes[rows]
            starts = (np.cumsum(sizes) - sizes)[rows]
            unwanted = ids[np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(n.sum())], n
        return Queries(self.ids[rows], self.x[rows], self.k[rows], unwanted)


def dense_table(rows: pa.Table) -> np.ndarray:
    """``dense`` of arrays that come as an Arrow table, without an object per row."""
    vectors = rows["vector"].combine_chunks()
    width = len(vectors[0]) if not vectors.null_count else -1
    if (vectors.value_lengths().fill_null(0).to_numpy() != width).any():
        raise ValueError("all vectors must have the same length")
    values = vectors.flatten().to_numpy(zero_copy_only=False)
    out = values.astype(float, copy=False).reshape(len(vectors), width)
    return out / rows["length"].to_numpy()[:, None] if "length" in rows.column_names else out


def table_best(q: pa.Table, i: pa.Table, k: int, same: bool, lower: float | None, decimals: int | None, kernel, ceilings) -> pa.Table:
    """``block_best`` of Arrow tables."""
    found = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
    if q.num_rows and i.num_rows:
        unwanted = None
        if "without" in q.column_names:
            lists = q["without"].combine_chunks()
            sizes = lists.value_lengths().fill_null(0).to_numpy()
            unwanted = lists.flatten().fill_null(np.iinfo(np.int64).min).to_numpy(), sizes.astype(int)
        queries = Queries(q["id"].to_numpy(), dense_table(q), np.full(q.num_rows, k), unwanted)
        found = best_of(queries, dense_table(i), i["id"].to_numpy(), same, lower, decimals, kernel, ceilings)
    # an id that is null is NaN in between
    ids = (pa.array(x, pa.int64(), from_pandas=True) for x in found[:2])
    return pa.table([*ids, pa.array(found[2])], ["query_id", "item_id", "score"])


def best_of(queries: Queries, items: np.ndarray, item_ids: np.ndarray, same, lower, decimals, kernel, ceilings) -> list[np.ndarray]:
    boxes = Boxes.of(items, item_ids)
    chunks = (queries.take(rows) for rows in boxes_of(queries.x, CHUNK))
    parts = [queries_best(part, item_ids, same, lower, decimals, kernel, ceilings, boxes) for part in chunks]
    return [np.concatenate([p[j] for p in parts]) for j in range(3)]


def block_best(q: pd.DataFrame, i: pd.DataFrame, same: bool, lower: float | None, dims: int | None, decimals: int | None, kernel, ceilings=product_ceilings) -> pd.DataFrame:
    if q.empty or i.empty:
        return pd.DataFrame({"query_id": [], "item_id": [], "score": []})
    items, item_ids = dense(i, dims), i["id"].to_numpy()
    if dims is None:
        found = best_of(Queries.of(q, dims), items, item_ids, same, lower, decimals, kernel, ceilings)
        return pd.DataFrame(dict(zip(("query_id", "item_id", "score"), found)))
    boxes = Boxes.of(items, item_ids)
    chunks = (q.iloc[start : start + CHUNK] for start in range(0, len(q), CHUNK))
    parts = [chunk_best(part, items, item_ids, same, lower, dims, decimals, kernel, ceilings, boxes) for part in chunks]
    return pd.concat(parts, ignore_index=True)


@dataclass
class Boxes:
    """Distinct vectors in boxes of near ones, and the items of each vector by ascending id.

    Items of equal vector have equal scores, so a vector is scored once, whatever the number of its
    items, and of those only the first ids can be among a query's best.
    """

    ids: np.ndarray  # of all items, by vector and id
    starts: np.ndarray  # place of a vector's first item
    sizes: np.ndarray  # number of a vector's items
    inside: list[tuple[np.ndarray, np.ndarray]]  # vectors and their numbers, by box
    low: np.ndarray  # smallest and largest value of each box per column
    high: np.ndarray
    known: np.ndarray  # the distinct ids in order, and how often each occurs
    times: np.ndarray

    @classmethod
    def of(cls, items: np.ndarray, item_ids: np.ndarray) -> Boxes:
        plain = np.ascontiguousarray(items + 0.0)  # without a negative zero
        raw = plain.view(np.dtype((np.void, plain.itemsize * plain.shape[1]))).ravel()
        _, one, number = np.unique(raw, return_index=True, return_inverse=True)
        order = np.lexsort((item_ids, number))
        sizes = np.bincount(number)
        distinct = plain[one]
        inside = [(distinct[rows], rows) for rows in boxes_of(distinct, BOX)]
        low, high = np.stack([x.min(0) for x, _ in inside]), np.stack([x.max(0) for x, _ in inside])
        return cls(item_ids[order], np.cumsum(sizes) - sizes, sizes, inside, low, high, *np.unique(item_ids, return_counts=True))

    def items(self, r: np.ndarray, s: np.ndarray, vectors: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows (query, score, item id) of the found vectors: enough to hold the best ``most`` of each query."""
        n = np.minimum(self.sizes[vectors], most[r])
        if n.max(initial=1) > 1:
            order = np.lexsort((-s, r))
            r, s, vectors, n = r[order], s[order], vectors[order], n[order]
            before = np.cumsum(n) - n
            before -= before[np.searchsorted(r, r)]
            # vectors of equal score share their places
            first = np.r_[True, (r[1:] != r[:-1]) | (s[1:] != s[:-1])]
            keep = before[np.flatnonzero(first)[np.cumsum(first) - 1]] < most[r]
            r, s, vectors, n = r[keep], s[keep], vectors[keep], n[keep]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(r, n), np.repeat(s, n), self.ids[np.repeat(self.starts[vectors], n) + within]


def chunk_best(part, right, item_ids, same, lower, dims, decimals=6, kernel=np.matmul, ceilings=product_ceilings, boxes=None) -> pd.DataFrame:
    """``queries_best`` of rows of a table."""
    found = queries_best(Queries.of(part, dims), item_ids, same, lower, decimals, kernel, ceilings, boxes or Boxes.of(right, item_ids))
    return pd.DataFrame(dict(zip(("query_id", "item_id", "score"), found)))


def queries_best(part: Queries, item_ids, same, lower, decimals, kernel, ceilings, boxes: Boxes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best items of each query of a chunk, ties by item id: query ids, item ids, scores.

    ``floor`` and ``last`` are the score and id of a query's last item so far; what comes behind
    them is left out, and so are boxes whose ceiling lies below ``floor``.
    """
    low, high = boxes.low, boxes.high
    x, ids = part.x, part.ids
    # the query's own item is taken along and dropped at the end
    wanted = part.k + (not same)
    unwanted = None if part.unwanted is None else unwanted_pairs(*part.unwanted, boxes.known)
    enough = wanted if unwanted is None else wanted + unwanted_items(len(x), boxes.times, *unwanted)
    top = ceilings(x, low, high)
    size = np.maximum(np.abs(x) @ np.maximum(np.abs(low), np.abs(high)).T, np.abs(top))
    top = top + 1e-9 * size  # never below a score, whatever the rounding
    spare = 0.0 if decimals is None else 10.0**-decimals
    top += spare
    if lower is not None:
        top = np.clip(top, lower, 1.0)
    floor, last = np.full(len(x), -np.inf), np.full(len(x), np.iinfo(np.int64).max)
    found, held, most = [], 0, max(KEPT_ROWS, 2 * int(wanted.sum()))
    for b in np.argsort(-top.mean(0), kind="stable"):
        rows = np.flatnonzero(~(top[:, b] < floor))
        if not len(rows):
            continue
        inside, numbers = boxes.inside[b]
        # most scores lie below the floor, whatever the rounding
        if hasattr(kernel, "above"):
            at, c, s = kernel.above(x[rows], inside.T, floor[rows] - spare)
        else:
            scores = kernel(x[rows], inside.T)
            if lower is not None:
                scores = np.clip(scores, lower, 1.0)
            at, c = np.nonzero(scores >= floor[rows, None] - spare)
            s = scores[at, c]
        r, vectors = rows[at], numbers[c]
        s = (s if decimals is None else np.round(s, decimals)) + 0.0
        keep = np.isfinite(s) & ((s > floor[r]) | (s == floor[r]) & (boxes.ids[boxes.starts[vectors]] < last[r]))
        r, s, new = boxes.items(r[keep], s[keep], vectors[keep], enough)
        keep = (s > floor[r]) | (new < last[r])
        r, s, new = r[keep], s[keep], new[keep]
        if unwanted is not None:
            keep = ~is_unwanted(r, new, *unwanted)
            r, s, new = r[keep], s[keep], new[keep]
        found.append((r, s, new))
        held += len(r)
        if held > most or len(found) == 1:
            found = [first_rows(found, wanted)]
            held = len(found[0][0])
            full_floors(found[0], wanted, floor, last)
    r, s, new = first_rows(found, wanted)
    if not same:
        other = new != ids[r]
        r, s, new = first_rows([(r[other], s[other], new[other])], wanted - 1)
    return ids[r], new, s


def unwanted_pairs(ids: np.ndarray, sizes: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The block's items in order, and query row * items + item place of every unwanted pair, in order."""
    rows = np.repeat(np.arange(len(sizes)), sizes)
    place = np.minimum(np.searchsorted(order, ids), len(order) - 1)
    inside = order[place] == ids
    return order, np.unique(rows[inside] * len(order) + place[inside])


def unwanted_items(queries: int, times: np.ndarray, order: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """How many of the block's items each query does not want; an id counts as often as it occurs."""
    return np.bincount(pairs // len(order), times[pairs % len(order)], queries).astype(int)


def is_unwanted(r: np.ndarray, ids: np.ndarray, order: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    if not len(pairs):
        return np.zeros(len(r), bool)
    wanted = r * len(order) + np.searchsorted(order, ids)
    return pairs[np.minimum(np.searchsorted(pairs, wanted), len(pairs) - 1)] == wanted


def first_rows(found: list[tuple], wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows by query, score and item id, the first ``wanted`` of each query."""
    r, s, new = (np.concatenate([f[j] for f in found]) if found else np.zeros(0, int) for j in range(3))
    order = np.lexsort((new, -s, r))
    r, s, new = r[order], s[order], new[order]
    place = np.arange(len(r)) - np.searchsorted(r, r)
    keep = place < wanted[r]
    return r[keep], s[keep], new[keep]


def full_floors(found: tuple, wanted: np.ndarray, floor: np.ndarray, last: np.ndarray) -> None:
    """Put the last score and id of the queries that have all their rows into ``floor`` and ``last``."""
    r, s, new = found
    ends = np.searchsorted(r, np.arange(len(wanted)), "right")
    full = np.flatnonzero((np.bincount(r, minlength=len(wanted)) >= wanted) & (wanted > 0))
    floor[full], last[full] = s[ends[full] - 1], new[ends[full] - 1]


def shared_profiles(people: DataFrame, profile: str) -> tuple[DataFrame, DataFrame]:
    """Distinct profiles with one representative id, and who is represented by it.

    Students of equal profile share one query, however many they are.
    """
    profiles = people.groupBy(profile).agg(F.min("id").alias("profile_id"))
    members = people.join(profiles, profile).select(F.col("id"), "profile_id")
    return profiles.select(F.col("profile_id").alias("id"), profile), members


def most_similar_by_profile(people: DataFrame, items: DataFrame, k: int, **options) -> DataFrame:
    """``most_similar`` for many queries with few distinct vectors."""
    profiles, members = shared_profiles(people, "vector")
    return to_members(most_similar(profiles, items, k, **options), members)


def to_members(found: DataFrame, members: DataFrame) -> DataFrame:
    """Lists of the representatives, given to everybody they stand for."""
    listed = found.withColumnRenamed("query_id", "profile_id")
    return members.join(listed, "profile_id").select(F.col("id").alias("query_id"), "item_id", "score", "rank")
