"""Helpers shared by the corpus operators: words, shingles, homes and row numbers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortlens.session import reliable_checkpoint, shuffle_width

#: Words kept in a task's cache of word hashes before it is emptied.
CACHED_WORDS = 300_000
#: Bits of a key that is compared across homes; equal bits of unequal keys only add candidates.
KEY_BITS = 48


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the UTF-8 bytes of ``text`` (null: empty); every other column is left out."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"),
    )


def id_fold(doc_id: Column, n: int = 5) -> Column:
    """Remainder of the id's checksum; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def words(raw: bytes) -> list[bytes]:
    """Maximal runs without ASCII white space; A-Z are lower-cased, nothing else changes."""
    return raw.lower().split()


class WordHashes(dict):
    """64-bit hash by word; emptied when it has many words, so that its size is bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        code = self[word] = xxhash.xxh3_64_intdigest(word)
        return code


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_codes(raw: bytes, hashes: WordHashes) -> np.ndarray:
    found = words(raw)
    return np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))


def shingles(codes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` words, in order; of the whole text if it has fewer words."""
    if not len(codes):
        return codes
    k = min(k, len(codes))
    m = len(codes) - k + 1
    acc = np.full(m, k, np.uint64)
    for j in range(k):
        acc = acc * np.uint64(0x9E3779B97F4A7C15) + codes[j : j + m]
        acc ^= acc >> np.uint64(29)
    return mixed(acc)


def packed(sorted_keys: np.ndarray) -> bytes:
    """Ascending numbers as compressed differences."""
    steps = np.diff(sorted_keys.astype(np.uint64), prepend=np.uint64(0))
    return zstandard.compress(steps.astype("<u8").tobytes(), 1)


def unpacked(blob: bytes) -> np.ndarray:
    steps = np.frombuffer(zstandard.decompress(blob), "<u8")
    return np.cumsum(steps, dtype=np.uint64)


def text_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts."""
    return docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0


def parts_for(spark: SparkSession, size: int, each: int) -> int:
    """How many parts of about ``each`` bytes hold ``size`` bytes; as many as shuffle partitions at least."""
    return max(shuffle_width(spark), -(-size // each))


def at_home(docs: DataFrame, homes: int) -> DataFrame:
    """Add ``home``: the documents' bucket by id; a home's documents fit in a task.

    There are as many homes as the session has shuffle partitions, which are sized for the data.
    """
    return docs.withColumn("home", F.pmod(F.xxhash64("doc_id", "text"), F.lit(homes)).cast("int"))


def homes_of(spark: SparkSession) -> int:
    return shuffle_width(spark)


def key_rows(home: int, keys: np.ndarray, repeated: np.ndarray, buckets: int) -> Iterator[dict]:
    """Rows of ``shared_keys`` input: a home's distinct keys, cut by key range.

    The lowest bit says that two of the home's documents hold the key.
    """
    keys = keys >> np.uint64(64 - KEY_BITS)
    order = np.argsort(keys, kind="stable")
    keys, repeated = keys[order], repeated[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    if not len(first):
        return
    twice = np.logical_or.reduceat(repeated, first) | (np.diff(np.r_[first, len(keys)]) > 1)
    keys = keys[first]
    where = ((keys >> np.uint64(16)) * np.uint64(buckets)) >> np.uint64(KEY_BITS - 16)
    marked = (keys << np.uint64(1)) | twice.astype(np.uint64)
    cuts = np.flatnonzero(np.r_[True, where[1:] != where[:-1]])
    for a, b in zip(cuts, np.r_[cuts[1:], len(keys)]):
        yield {"home": home, "bucket": int(where[a]), "keys": packed(marked[a:b])}


KEY_ROWS = "home int, bucket int, keys binary"


def meet(pdf: pd.DataFrame) -> pd.DataFrame:
    parts = [unpacked(b) for b in pdf["keys"]]
    keys = np.concatenate(parts)
    home = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    order = np.argsort(keys >> np.uint64(1), kind="stable")
    keys, home = keys[order], home[order]
    key = keys >> np.uint64(1)
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    size = np.diff(np.r_[first, len(key)])
    often = (size > 1) | np.logical_or.reduceat((keys & np.uint64(1)).astype(bool), first)
    keep = np.repeat(often, size)
    key, home = key[keep], home[keep]
    order = np.argsort(home, kind="stable")
    key, home = key[order], home[order]
    rows, cuts = [], np.searchsorted(home, np.arange(len(parts) + 1))
    for i, name in enumerate(pdf["home"]):
        if cuts[i] < cuts[i + 1]:
            rows.append((name, packed(key[cuts[i] : cuts[i + 1]])))
    return pd.DataFrame(rows, columns=["home", "keys"])


def shared_keys(local: DataFrame) -> DataFrame:
    """Of each home, the keys that another of its documents or another home has as well.

    A key travels once per home however many documents hold it, so a very frequent key
    weighs no more than any other.
    """
    return local.groupBy("bucket").applyInPandas(meet, "home int, keys binary")


def known_keys(blobs: list[bytes]) -> np.ndarray:
    """A home's shared keys, ascending."""
    return np.sort(np.concatenate([unpacked(b) for b in blobs])) if len(blobs) else np.zeros(0, np.uint64)


def holds(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which 64-bit keys are among the shared ones of their home."""
    if not len(known) or not len(keys):
        return np.zeros(len(keys), bool)
    cut = keys >> np.uint64(64 - KEY_BITS)
    at = np.minimum(np.searchsorted(known, cut), len(known) - 1)
    return known[at] == cut


def numbered(df: DataFrame, order: list[str], into: str = "row_number") -> DataFrame:
    """Gapless row numbers from 0 in the given order, without a sort in one task.

    Rows are split by range and sorted within the ranges; a range's first number is the
    count of all rows before it. Equal rows may swap numbers; a random last key keeps many
    equal rows from meeting in one range. The numbered rows are kept by a checkpoint, so a
    lost task can't number them anew.
    """
    keys = [F.col(c).asc_nulls_first() for c in order]
    spread = df.withColumn("_llm_tie", F.rand(7))
    by_range = spread.repartitionByRange(*keys, F.col("_llm_tie"))
    marked = by_range.sortWithinPartitions(*keys, F.col("_llm_tie")).withColumn("_llm_id", F.monotonically_increasing_id())
    kept = reliable_checkpoint(marked.drop("_llm_tie"))
    part = F.shiftright("_llm_id", 33)
    sizes = kept.groupBy(part.alias("_llm_part")).agg(F.count("*").alias("_llm_n"))
    before = Window.partitionBy(F.lit(0)).orderBy("_llm_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_llm_part", F.coalesce(F.sum("_llm_n").over(before), F.lit(0)).alias("_llm_start"))
    # one row per partition of the range split: its size is bounded by the number of partitions
    joined = kept.withColumn("_llm_part", part).join(F.broadcast(starts), "_llm_part")
    within = F.col("_llm_id").bitwiseAND(F.lit((1 << 33) - 1))
    return joined.withColumn(into, F.col("_llm_start") + within).drop("_llm_part", "_llm_start", "_llm_id")


def with_components(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """Smallest node reachable over ``links`` (a, b), for every row of ``nodes`` (node).

    Each round takes the smallest label among a node's neighbours and then that label's own
    label, until no label changes. Sums and minima combine before the shuffle, and joins
    with a frequent key can be split by Spark, so a node with many links is no hot task.
    """
    spark = nodes.sparkSession
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = reliable_checkpoint(both.where(F.col("a") != F.col("b")).distinct())
    if edges.isEmpty():
        return nodes.select("node", F.col("node").alias("component"))
    labels = reliable_checkpoint(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")))
    while True:
        near = (
            edges.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        own = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("label").alias("far"))
        stepped = own.join(jump, "low", "left").select(
            "node", F.col("label").alias("was"), F.least("low", F.coalesce("far", "low")).alias("label")
        )
        stepped = reliable_checkpoint(stepped)
        moved = stepped.where(F.col("was") != F.col("label")).isEmpty()
        labels = stepped.select("node", "label")
        if moved:
            break
    return nodes.join(labels, "node", "left").select("node", F.coalesce("label", "node").alias("component"))


