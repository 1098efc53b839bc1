"""N-gram Jaccard join with a token-group matrix.

Documents are sets of word shingles; two are linked when their sets' Jaccard similarity reaches
the threshold. Documents of equal sets form a class, and classes are compared:

1. A fixed-size table counts shingles by hash. It gives all shingles one order, rare ones first.
   Linked sets share a shingle among their first n - ceil(t n) + 1 (the *prefix*).
2. Prefix shingles that only one document has are dropped (each home sends its distinct ones).
   Classes left without any have no link.
3. The others are partitioned into groups of similar documents: by the smallest hash among the
   shared prefix shingles, in blocks of ``MEMBERS`` at most. The token-group matrix tells which
   groups have a prefix shingle; a class is a query to the groups of a later number that share
   one with it, and pairs inside a group are compared there.
4. A group's task holds the union of its members' shingles and their smallest and largest size.
   The overlap of a query with the union bounds its similarity to every member; only groups that
   qualify are opened, and members are compared exactly.

Nothing is capped: blocks and query chunks only split work. Links are returned as a spanning
forest per task (enough for components) and as counts per class.

Results of the awkward cases: null texts and texts without words have an empty set and are linked
with nothing, not even with each other; texts with fewer words than a shingle are one shingle;
rows of a repeated id are documents of their own; ``component_id`` is the smallest id that isn't
null (null only if all are); an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import (
    KEY_BITS,
    KEY_ROWS,
    homes_of,
    holds,
    key_rows,
    known_keys,
    mixed,
    shared_keys,
    shingles,
    texts,
    with_components,
)
from cohortlens.session import reliable_checkpoint

#: Words of a shingle, and hundredths of similarity, unless a caller gives others.
WORDS = 4
THRESHOLD = 85
#: Cells of the table of shingle counts: 4 MB, whatever the data.
CELLS = 1 << 20
SLICES = 16
MEMBERS = 128
QUERIES = 512
#: Buckets of group tasks per shuffle partition.
BUCKETS = 16
#: Stands for a null id inside the join; sorts last.
NO_ID = (1 << 63) - 1


SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
BYTE_CODES = mixed(np.arange(1, 257, dtype=np.uint64))
PIECE = 1 << 20


@lru_cache(maxsize=2)
def power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64."""
    base, both = 0xD6E8FEB86659FD93, []
    for b in (base, pow(base, -1, 1 << 64)):
        out = np.full(n, b, np.uint64)
        out[0] = 1
        both.append(np.cumprod(out, dtype=np.uint64))
    return both[0], both[1]


def text_codes(raw: bytes) -> np.ndarray:
    """64-bit hash of every word, from running sums over the text's bytes; long texts piece by piece."""
    parts, at = [], 0
    while at < len(raw):
        end = len(raw)
        if end - at > PIECE:  # cut at white space
            end = max(raw.rfind(c, at, at + PIECE) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
            end = end if end > at else len(raw)
        parts.append(piece_codes(raw[at:end]))
        at = end + 1
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def piece_codes(raw: bytes) -> np.ndarray:
    b = np.frombuffer(raw.lower(), np.uint8)
    inside = ~SPACE[b]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = power_table(max(1 << 16, 1 << len(b).bit_length()))
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(BYTE_CODES[b] * up[: len(b)], out=sums[1:])
    return mixed((sums[end] - sums[start]) * down[start])


def shingle_set(raw: bytes, words: int) -> np.ndarray:
    return np.unique(shingles(text_codes(raw), words))


def located(docs: DataFrame) -> DataFrame:
    rows = texts(docs).withColumn("version", F.xxhash64("text")).withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID)))
    homes = homes_of(docs.sparkSession)
    return rows.withColumn("home", F.pmod(F.xxhash64("doc_id", "version"), F.lit(homes)).cast("int"))


def profiles(rows: DataFrame, words: int) -> DataFrame:
    """Size and digest of every document's set, and (``kind`` 1) slices of each task's shingle counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(CELLS, np.uint32)
        kinds = {"kind": pa.int32(), "doc_id": pa.int64(), "version": pa.int64(), "home": pa.int32(), "n_shingles": pa.int64(), "body": pa.binary()}
        for batch in batches:
            sizes, digests = [], []
            for raw in batch.column("text").to_pylist():
                found = shingle_set(raw, words)
                np.add.at(cells, (found & np.uint64(CELLS - 1)).astype(np.int64), np.uint32(1))
                sizes.append(len(found))
                digests.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.zeros(len(sizes), np.int32)),
                    batch.column("doc_id"),
                    batch.column("version"),
                    batch.column("home"),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                ],
                list(kinds),
            )
        if cells.any():
            none = [None] * SLICES
            bodies = [zstandard.compress(part.astype("<u4").tobytes(), 1) for part in cells.reshape(SLICES, -1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([1] * SLICES, pa.int32()), pa.array(none, pa.int64()), pa.array(none, pa.int64()), pa.array(range(SLICES), pa.int32()), pa.array(none, pa.int64()), pa.array(bodies, pa.binary())],
                list(kinds),
            )

    return rows.mapInArrow(run, "kind int, doc_id long, version long, home int, n_shingles long, body binary")


def shingle_counts(found: DataFrame) -> np.ndarray:
    """The table of counts: ``CELLS`` numbers, added up per slice."""

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(CELLS // SLICES, np.uint32)
        for body in pdf["body"]:
            total += np.frombuffer(zstandard.decompress(body), "<u4")
        return pd.DataFrame({"home": pdf["home"].iloc[:1], "body": [total.tobytes()]})

    table = np.zeros((SLICES, CELLS // SLICES), np.uint32)
    rows = found.where(F.col("kind") == 1).select("home", "body").groupBy("home").applyInPandas(add, "home int, body binary")
    for row in rows.collect():  # SLICES rows
        table[row["home"]] = np.frombuffer(row["body"], "<u4")
    return table.ravel()


def prefix(found: np.ndarray, counts: np.ndarray, threshold: int) -> np.ndarray:
    """The rarest shingles of a set: one of them is in every linked set's as well."""
    n = len(found)
    keep = n - -(-threshold * n // 100) + 1
    order = np.argsort(counts[(found & np.uint64(CELLS - 1)).astype(np.int64)], kind="stable")  # ties by hash: found ascends
    return found[order[:keep]]


def own_sets(docs: pd.DataFrame, gone: set, words: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """Id, version and set of the home's documents that stand for their class."""
    done = set()
    for d, v, raw in zip(docs["doc_id"], docs["version"], docs["text"]):
        name = (int(d), int(v))
        if name not in gone and name not in done:
            done.add(name)
            found = shingle_set(raw, words)
            if len(found):
                yield *name, found


def names_of(frame: pd.DataFrame) -> list[tuple]:
    return [(int(d), int(v)) for d, v in zip(frame["doc_id"], frame["version"])]


def local_prefixes(docs: pd.DataFrame, others: pd.DataFrame, counts: np.ndarray, buckets: int, words: int, threshold: int) -> pd.DataFrame:
    rows: list[dict] = []
    if len(docs):
        parts = [prefix(s, counts, threshold) for _, _, s in own_sets(docs, set(names_of(others)), words)]
        if parts:
            keys = np.sort(np.concatenate(parts))
            first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            twice = np.diff(np.r_[first, len(keys)]) > 1
            rows = list(key_rows(int(docs["home"].iloc[0]), keys[first], twice, buckets))
    return pd.DataFrame(rows, columns=["home", "bucket", "keys"])


def local_actives(docs: pd.DataFrame, others: pd.DataFrame, counts: np.ndarray, words: int, threshold: int) -> pd.DataFrame:
    """Documents with shared prefix shingles, and these shingles."""
    out = []
    known = known_keys(list(others.loc[others["kind"] == 1, "keys"])) if len(others) else []
    if len(docs) and len(known):
        for d, v, found in own_sets(docs, set(names_of(others[others["kind"] == 0])), words):
            keys = prefix(found, counts, threshold)
            keys = keys[holds(keys, known)] >> np.uint64(64 - KEY_BITS)
            if len(keys):
                out.append((d, v, len(found), xxhash.xxh3_128_digest(found.tobytes()), np.unique(keys).astype(np.int64).tolist()))
    return pd.DataFrame(out, columns=["doc_id", "version", "n", "node", "keys"])


def sent_sets(docs: pd.DataFrame, others: pd.DataFrame, words: int) -> pd.DataFrame:
    """The texts that group tasks need: each to its own group, and as a query to others."""
    out = []
    if len(docs) and len(others):
        tasks: dict[tuple, list] = {}
        for name, block, chunk, role, weight in zip(names_of(others), others["block"], others["chunk"], others["role"], others["weight"]):
            tasks.setdefault(name, []).append((block, chunk, role, weight))
        done = set()
        for name, raw in zip(names_of(docs), docs["text"]):
            if name in tasks and name not in done:
                done.add(name)
                node = xxhash.xxh3_128_digest(shingle_set(raw, words).tobytes())
                body = zstandard.compress(bytes(raw), 3)  # a third of the size of its shingles
                out += [(block, chunk, role, weight, node, body) for block, chunk, role, weight in tasks[name]]
    return pd.DataFrame(out, columns=["block", "chunk", "role", "weight", "node", "body"])


class Forest:
    """Sets of linked things, by union with path halving."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def top(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.top(i), self.top(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def linked(overlap: np.ndarray, n: int, sizes: np.ndarray, threshold: int) -> np.ndarray:
    return 100 * overlap >= threshold * (n + sizes - overlap)


def may_qualify(overlap: int, n: int, smallest: int, largest: int, threshold: int = THRESHOLD) -> bool:
    """Whether any set of these sizes that lies in the union could be linked with the query."""
    size = min(max(overlap, smallest), largest)
    shared = min(overlap, size)
    return 100 * shared >= threshold * (n + size - shared)


def compare(pdf: pd.DataFrame, words: int, threshold: int) -> pd.DataFrame:
    """One group, and a chunk of its queries: links as a forest, and each class's weighted link count."""

    def read(body: bytes) -> np.ndarray:
        return shingle_set(zstandard.decompress(body), words)

    members = pdf[pdf["role"] == 0]
    queries = pdf[pdf["role"] == 1]
    sets = [read(b) for b in members["body"]]
    nodes = [bytes(b) for b in members["node"]] + [bytes(b) for b in queries["node"]]
    weights = np.concatenate([members["weight"], queries["weight"]]).astype(np.int64)
    sizes = np.array([len(s) for s in sets], np.int64)
    union, at = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    forest, links, out = Forest(len(nodes)), np.zeros(len(nodes), np.int64), []

    def probe(me: int, found: np.ndarray, later: int) -> None:
        place = np.minimum(np.searchsorted(union, found), len(union) - 1)
        place = place[union[place] == found]
        if not may_qualify(len(place), len(found), int(sizes.min()), int(sizes.max()), threshold):
            return
        has = np.zeros(len(union), np.int64)
        has[place] = 1
        overlap = np.add.reduceat(has[at], starts)
        hit = np.flatnonzero(linked(overlap, len(found), sizes, threshold))
        hit = hit[hit >= later]
        links[me] += weights[hit].sum()
        links[hit] += weights[me]
        for j in hit.tolist():
            if forest.join(me, j):
                out.append((nodes[me], nodes[j], 0))

    if pdf["chunk"].iloc[0] == 0:
        for i, s in enumerate(sets):
            probe(i, s, i + 1)
    for i, body in enumerate(queries["body"]):
        probe(len(sets) + i, read(body), 0)
    out += [(nodes[i], None, int(links[i])) for i in np.flatnonzero(links)]
    return pd.DataFrame(out, columns=["a", "b", "links"])


def compare_all(pdf: pd.DataFrame, words: int, threshold: int) -> pd.DataFrame:
    """The groups and chunks of a bucket, one after the other."""
    parts = [compare(part, words, threshold) for _, part in pdf.groupby(["block", "chunk"], sort=False)]
    return pd.concat([p for p in parts if len(p)] or parts[:1], ignore_index=True)


def group_tasks(active: DataFrame, threshold: int) -> DataFrame:
    """For each class, the group that it belongs to and the groups that it is a query to."""
    smallest = F.array_min(F.transform("keys", lambda k: F.struct(F.xxhash64(k).alias("h"), k.alias("k"))))["k"]
    grouped = active.withColumn("group_key", smallest)
    sizes = grouped.groupBy("group_key").agg(F.ceil(F.count("*") / F.lit(MEMBERS)).alias("blocks"))
    placed = grouped.join(sizes, "group_key").withColumn("block_no", F.pmod(F.xxhash64("node"), F.col("blocks")))
    placed = placed.withColumn("block", F.xxhash64("group_key", "block_no")).select("doc_id", "version", "home", "weight", "node", "n", "keys", "block")
    placed = reliable_checkpoint(placed)
    # the token-group matrix, with the sizes of the members that have the token
    entries = placed.select("block", "n", F.explode("keys").alias("key"))
    matrix = entries.groupBy("key", "block").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    several = matrix.groupBy("key").agg(F.count("*").alias("groups")).where(F.col("groups") > 1).select("key")
    matrix = reliable_checkpoint(matrix.join(several, "key"))
    # groups meet first, not documents: a shingle that many documents have joins as often as groups have it
    other = matrix.select("key", F.col("block").alias("other"), "low", "high")
    met = (
        matrix.select("key", "block")
        .join(other, "key")
        .where(F.col("block") < F.col("other"))
        .groupBy("block", "other")
        .agg(F.collect_set("key").alias("shared"), F.min("low").alias("low"), F.max("high").alias("high"))
    )
    fits = (F.col("high") * 100 >= F.col("n") * threshold) & (F.col("low") * threshold <= F.col("n") * 100)
    queries = (
        placed.select("doc_id", "version", "home", "weight", "n", "block", "keys")
        .join(met, "block")
        .where(fits & F.arrays_overlap("keys", "shared"))
        .select("doc_id", "version", "home", "weight", F.col("other").alias("block"))
    )
    queries = reliable_checkpoint(queries)
    chunks = queries.groupBy("block").agg(F.ceil(F.count("*") / F.lit(QUERIES)).cast("int").alias("chunks"))
    asked = queries.join(chunks, "block").select(
        "doc_id", "version", "home", "block", F.pmod(F.xxhash64("doc_id", "version"), F.col("chunks")).cast("int").alias("chunk"), F.lit(1).alias("role"), "weight"
    )
    crowd = placed.groupBy("block").agg(F.count("*").alias("members"))
    held = placed.join(crowd, "block").join(chunks, "block", "left").where((F.col("members") > 1) | F.col("chunks").isNotNull())
    held = held.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.coalesce("chunks", F.lit(1)) - 1)))
    return asked.unionByName(held.select("doc_id", "version", "home", "block", "chunk", F.lit(0).alias("role"), "weight"))


def joined(docs: DataFrame, words: int = WORDS, threshold: int = THRESHOLD) -> DataFrame:
    """Every document: id, version, set size, class (``node``), component and number of links."""
    rows = located(docs)
    spark, buckets = docs.sparkSession, homes_of(docs.sparkSession)
    found = reliable_checkpoint(profiles(rows, words))
    counts = spark.sparkContext.broadcast(shingle_counts(found))  # CELLS numbers
    thin = found.where(F.col("kind") == 0).select("doc_id", "version", "home", "n_shingles", F.col("body").alias("node"))
    place = F.struct("doc_id", "version")
    classes = thin.where(F.col("node").isNotNull()).groupBy("node").agg(F.min(place).alias("origin"), F.count("*").alias("weight"))
    classes = reliable_checkpoint(classes)
    copies = (
        thin.join(classes.where(F.col("weight") > 1), "node")
        .where(place != F.col("origin"))
        .select(*[F.col(c).alias(f"_{c}") for c in ("home", "doc_id", "version")])
        .distinct()
    )
    texts_at = rows.select("home", "doc_id", "version", "text")
    none = F.lit(None).cast("binary")
    marks = copies.select(F.col("_home").alias("home"), F.lit(0).alias("kind"), F.col("_doc_id").alias("doc_id"), F.col("_version").alias("version"), none.alias("keys"))
    local = texts_at.groupBy("home").cogroup(marks.groupBy("home")).applyInPandas(
        lambda k, d, o: local_prefixes(d, o, counts.value, buckets, words, threshold), KEY_ROWS
    )
    shared = shared_keys(local).select("home", F.lit(1).alias("kind"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("version"), "keys")
    active = texts_at.groupBy("home").cogroup(marks.union(shared).groupBy("home")).applyInPandas(
        lambda k, d, o: local_actives(d, o, counts.value, words, threshold), "doc_id long, version long, n long, node binary, keys array<long>"
    )
    active = reliable_checkpoint(active).join(classes.select("node", "weight"), "node")
    active = active.withColumn("home", F.pmod(F.xxhash64("doc_id", "version"), F.lit(buckets)).cast("int"))
    tasks = group_tasks(active, threshold)
    tasks = tasks.select(*[F.col(c).alias(f"_{c}") for c in tasks.columns]).toDF(*tasks.columns)
    sent = texts_at.groupBy("home").cogroup(tasks.groupBy("home")).applyInPandas(
        lambda k, d, o: sent_sets(d, o, words), "block long, chunk int, role int, weight long, node binary, body binary"
    )
    # most groups are small: a bucket holds several, so that a task isn't busy with handing them over
    dealt = sent.withColumn("bucket", F.pmod(F.xxhash64("block", "chunk"), F.lit(BUCKETS * buckets)))
    compared = dealt.groupBy("bucket").applyInPandas(lambda pdf: compare_all(pdf, words, threshold), "a binary, b binary, links long")
    compared = reliable_checkpoint(compared)
    links = compared.where(F.col("b").isNotNull()).select("a", "b")
    degrees = compared.where(F.col("b").isNull()).groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    labels = with_components(links, classes.select("node"))
    labels = labels.join(classes.select("node", "weight", F.col("origin.doc_id").alias("first")), "node").join(degrees, "node", "left")
    labels = reliable_checkpoint(labels.select("node", "component", "first", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")))
    tops = labels.groupBy("component").agg(F.min("first").alias("component_id"))  # the id that stands for null is the largest
    named = labels.join(tops, "component").select("node", "component", "component_id", "n_links")
    whole = thin.where(F.col("node").isNotNull()).join(named, "node").select("doc_id", "version", "n_shingles", "component_id", "n_links", "component")
    empty = thin.where(F.col("node").isNull()).select(
        "doc_id", "version", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links"), F.lit(None).cast("binary").alias("component")
    )
    both = whole.union(empty)
    return both.withColumns({c: F.nullif(c, F.lit(NO_ID)) for c in ("doc_id", "component_id")})


def components(docs: DataFrame) -> DataFrame:
    """Per document: size of its set, component, and number of documents that it is linked with."""
    return joined(docs).select("doc_id", "n_shingles", "component_id", "n_links")


def one_of_each(docs: DataFrame, words: int = WORDS, threshold: int = THRESHOLD) -> DataFrame:
    """The first document of every component, with all columns; documents without words all stay.

    First is the smallest id, then the smallest hash of the text. Rows equal in both are repeats;
    one of them stays.
    """
    found = reliable_checkpoint(joined(docs, words, threshold))
    place = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "version")
    linked_rows = found.where(F.col("component").isNotNull())
    tops = linked_rows.groupBy("component").agg(F.min(place).alias("top"))
    kept = linked_rows.groupBy("component", "doc_id", "version").agg(F.count("*").alias("rows")).join(tops, "component").where(place == F.col("top"))
    kept = kept.select(F.col("doc_id").alias("_llm_id"), F.col("version").alias("_llm_version"), (F.col("rows") > 1).alias("_llm_repeated"))
    blank = found.where(F.col("component").isNull()).select(
        F.col("doc_id").alias("_llm_id"), F.col("version").alias("_llm_version"), F.lit(False).alias("_llm_repeated")
    )
    raw = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_llm_id")) & (F.xxhash64(raw) == F.col("_llm_version"))
    rows = docs.join(kept.union(blank.distinct()), same)
    once = rows.where(~F.col("_llm_repeated")).select(*docs.columns)
    return once.union(rows.where("_llm_repeated").dropDuplicates(["_llm_id", "_llm_version"]).select(*docs.columns))


#: Sets, links and components in SQL.
SQL = """
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, s FROM (SELECT doc_id, unnest(CASE WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 2), lambda k: array_to_string(w[k:k+3], ' ')) END) AS s FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, COUNT(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, COUNT(*) AS o FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 85 * (x.n + y.n - o)),
r AS (SELECT a AS doc_id, a AS b FROM (SELECT DISTINCT a FROM l) UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT doc_id, MIN(b) AS c FROM r GROUP BY doc_id),
k AS (SELECT a AS doc_id, COUNT(*) AS k FROM l GROUP BY a)
SELECT d.doc_id, CAST(COALESCE(n.n, 0) AS BIGINT) AS n_shingles, COALESCE(c.c, d.doc_id) AS component_id, CAST(COALESCE(k.k, 0) AS BIGINT) AS n_links
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.doc_id = d.doc_id LEFT JOIN k ON k.doc_id = d.doc_id
"""
