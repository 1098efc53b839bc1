"""Sharding by a Feistel permutation of global row numbers.

Rows are numbered from 0 in the order of their ids. A keyed permutation of 0..n-1 gives
every number a place; ``place % shards`` is the shard and ``place / shards`` the slot, so
shard sizes differ by one row at most and slots have no gaps. Both can be computed from
a row number alone (``locate``), without any table.

The permutation is a Feistel network over pairs of digits (left, right) with bases ``a``
and ``b``, the smallest with a * b >= n and a = ceil(sqrt(n)). A place of n or more is
permuted again (cycle walking) until it is below n. At most ``a`` places lie outside, so
the longest walk is found by walking from those.

Results of the awkward cases: null ids come first in the row order; equal ids are ordered
by size and checksum; rows equal in all of these may swap places, which changes no result;
a null text has size 8 and checksum 0; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import numbered

ROUNDS = 6
#: Three primes below 2^31: each step stays below 2^62, and their mix is not linear.
PRIMES = (2147483647, 2147483629, 2147483587)


def round_keys(seed: int) -> list[tuple[tuple[int, int], ...]]:
    """A factor and a summand for every prime and round."""
    state, keys = (seed * 2862933555777941757 + 3037000493) % (1 << 64), []
    for _ in range(ROUNDS):
        one = []
        for p in PRIMES:
            pair = []
            for _ in range(2):
                state = (state * 6364136223846793005 + 1442695040888963407) % (1 << 64)
                pair.append(1 + (state >> 33) % (p - 1))
            one.append(tuple(pair))
        keys.append(tuple(one))
    return keys


@dataclass(frozen=True)
class Permutation:
    """A seeded permutation of 0..n-1."""

    n: int
    seed: int

    @property
    def bases(self) -> tuple[int, int]:
        a = max(1, isqrt(self.n - 1) + 1) if self.n else 1
        return a, max(1, -(-self.n // a))

    def once(self, x: int) -> int:
        """One pass over the whole grid of a * b places."""
        a, b = self.bases
        left, right = x % a, x // a
        for j, key in enumerate(round_keys(self.seed)):
            v = right
            for p, (factor, summand) in zip(PRIMES, key):
                v = (v * factor + summand) % p
            left, right = right, (left + v) % (b if j % 2 else a)
        return a * right + left

    def place(self, row: int) -> int:
        x = self.once(row)
        while x >= self.n:
            x = self.once(x)
        return x

    def walks(self) -> int:
        """Passes that the longest walk takes: one more than from any place outside."""
        a, b = self.bases
        most = 0
        if not self.n:
            return 1
        for x in range(self.n, a * b):
            steps = 1
            while (x := self.once(x)) >= self.n:
                steps += 1
            most = max(most, steps)
        return 1 + most

    def once_column(self, x: Column) -> Column:
        a, b = self.bases
        left, right = x % a, F.floor((x - x % a) / F.lit(a)).cast("long")
        for j, key in enumerate(round_keys(self.seed)):
            v = right
            for p, (factor, summand) in zip(PRIMES, key):
                v = (v * F.lit(factor).cast("long") + F.lit(summand).cast("long")) % F.lit(p).cast("long")
            left, right = right, (left + v) % F.lit(b if j % 2 else a).cast("long")
        return F.lit(a).cast("long") * right + left


def locate(row: int, n: int, shards: int, seed: int) -> tuple[int, int]:
    """Shard and slot of the row with this number, among ``n``."""
    place = Permutation(n, seed).place(row)
    return place % shards, place // shards


def shard_rows(rows: DataFrame, order: list[str], shards: int = 24, seed: int = 20) -> DataFrame:
    """Add ``row_number``, ``shard`` and ``slot`` to rows; existing columns of these names are replaced."""
    found = numbered(rows.drop("row_number", "shard", "slot"), order)
    permutation = Permutation(found.count(), seed)
    placed = found.withColumn("_llm_place", permutation.once_column(F.col("row_number")))
    for _ in range(permutation.walks() - 1):
        again = permutation.once_column(F.col("_llm_place"))
        placed = placed.withColumn("_llm_place", F.when(F.col("_llm_place") >= permutation.n, again).otherwise(F.col("_llm_place")))
    place = F.col("_llm_place")
    return (
        placed.withColumn("shard", (place % shards).cast("int"))
        .withColumn("slot", F.floor((place - place % shards) / F.lit(shards)).cast("long"))
        .drop("_llm_place")
    )


def shard_documents(docs: DataFrame, shards: int = 24, seed: int = 20) -> DataFrame:
    """Shard, slot and digest columns of every document, under the law ``rows``."""
    raw = F.col("text").cast("string").cast("binary")
    thin = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(raw), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(raw, F.lit("").cast("binary"))).alias("text_crc32"),
    )
    placed = shard_rows(thin, ["doc_id", "size", "text_crc32"], shards, seed)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "row_number",
    )
