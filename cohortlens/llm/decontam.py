"""Benchmark decontamination by size-partitioned MinHash containment search.

Short items are looked for in long documents, so Jaccard similarity says little; what counts
is containment, the share of an item's shingles (five words) that the document has. Items are
partitioned by the size of their shingle set, in powers of two. The signature of an item is
the k smallest values of one hash over its shingles (bottom-k MinHash). A document that holds
at least the threshold's share of an item of size q misses at most q - ceil(t q) shingles, so
with k = u - ceil(t u) + 1, u the partition's largest size, it holds one of the k smallest at
least: the signature loses nothing. Only signature values are searched for; what shares one with
a document is a candidate, and the shingles of candidate pairs alone are counted, exactly.

Documents are read once, where they lie. A bit table of fixed size (``BITS``) over the items'
shingles tells which shingles of a document may matter; only those are kept and joined. With
more items the table lets more through and results stay the same.

Results of the awkward cases: null and empty texts have no shingles and match nothing; a text
of fewer than five words has one shingle, the whole; equal items are reported each; of rows
that share an id, the best containment per item is reported; null ids are reported as null;
empty tables give an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import WordHashes, shingles, texts, word_codes
from cohortlens.session import reliable_checkpoint

WORDS = 5
#: Containment is at least THRESHOLD / 100.
THRESHOLD = 80
#: Size of the bit table, 1 MB whatever the number of items.
BITS = 1 << 23


def signature_size(shingle_count: int, threshold: int = THRESHOLD) -> int:
    """Values in the signature of an item, by the size partition it falls in."""
    largest = (1 << int(shingle_count).bit_length()) - 1
    return largest - (-(-threshold * largest // 100)) + 1


def item_shingles(items: DataFrame) -> DataFrame:
    """One row per item and distinct shingle; ``in_signature`` marks the signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for name, raw in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist()):
                found = np.unique(shingles(word_codes(raw, hashes), WORDS))
                if len(found):
                    n, k = len(found), signature_size(len(found))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([name] * n, pa.int64()),
                            pa.array(found.view(np.int64)),
                            pa.array(np.full(n, n, np.int64)),
                            pa.array(np.full(n, n.bit_length(), np.int32)),
                            pa.array(np.arange(n) < k),  # ascending hash values
                        ],
                        ["item_id", "key", "n_shingles", "size_class", "in_signature"],
                    )

    rows = items.select(
        F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text")
    )
    return rows.mapInArrow(run, "item_id long, key long, n_shingles long, size_class int, in_signature boolean")


def bit_table(keys: DataFrame) -> np.ndarray:
    """Bits of all keys, in ``BITS / 64`` words at most."""
    at = F.pmod("key", F.lit(BITS))
    words = keys.groupBy(F.shiftright(at, 6).alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int"))).alias("bits"))
    table = np.zeros(BITS // 64, np.int64)
    for row in words.toLocalIterator():
        table[row["word"]] = row["bits"]
    return table.view(np.uint64)


def may_hold(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys & np.uint64(BITS - 1)
    return (table[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) > 0


def hits_of(docs: DataFrame, table: np.ndarray) -> DataFrame:
    """Shingles of each document that the items may have; ``version`` tells rows of an id apart."""
    shared = docs.sparkSession.sparkContext.broadcast(table)  # BITS / 8 bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, bits = WordHashes(), shared.value
        for batch in batches:
            names, versions, keys = [], [], []
            for name, version, raw in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "version", "text"))):
                found = shingles(word_codes(raw, hashes), WORDS)
                found = np.unique(found[may_hold(bits, found)])
                if len(found):
                    names += [name] * len(found)
                    versions += [version] * len(found)
                    keys.append(found)
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.int64()), pa.array(versions, pa.int64()), pa.array(np.concatenate(keys).view(np.int64))],
                    ["doc_id", "version", "key"],
                )

    rows = texts(docs).withColumn("version", F.xxhash64("text"))
    return rows.mapInArrow(run, "doc_id long, version long, key long").distinct()


def candidates(hits: DataFrame, inside: DataFrame) -> DataFrame:
    """Documents and items that share a value of the item's signature."""
    signature = inside.where("in_signature").select("key", "item_id")
    return hits.join(signature, "key").select("doc_id", "version", "item_id").distinct()


def contained_items(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Document and item, wherever the document holds the threshold's share of the item."""
    inside = reliable_checkpoint(item_shingles(items).distinct())
    hits = reliable_checkpoint(hits_of(docs, bit_table(inside.select("key").distinct())))
    wanted = candidates(hits, inside).join(inside.select("item_id", "key", "n_shingles"), "item_id")
    have = hits.select(F.col("doc_id").alias("_doc"), F.col("version").alias("_version"), F.col("key").alias("_key"))
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("version") == F.col("_version")) & (F.col("key") == F.col("_key"))
    counted = wanted.join(have, same).groupBy("doc_id", "version", "item_id", "n_shingles").agg(F.count("*").alias("n_shared"))
    held = counted.where(F.col("n_shared") * 100 >= F.col("n_shingles") * THRESHOLD)
    return (
        held.groupBy("doc_id", "item_id", "n_shingles")
        .agg(F.max("n_shared").alias("n_shared"))
        .withColumn("containment", F.round(F.col("n_shared") / F.col("n_shingles"), 6))
    )


def without_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id isn't reported, with all their columns.

    Rows that share an id stay or go together.
    """
    bad = contained_items(docs, items).select(F.col("doc_id").alias("_llm_id")).distinct()
    return docs.join(bad, F.col("doc_id").cast("long").eqNullSafe(F.col("_llm_id")), "left_anti")


#: Words, shingles and containment in SQL; two texts of an id are told apart by their text.
SQL = """
WITH d AS (SELECT doc_id, text, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM benchmark),
ds AS (SELECT DISTINCT doc_id, text, s FROM (SELECT doc_id, text, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k+4], ' ')) END) AS s FROM d WHERE len(w) > 0)),
s AS (SELECT DISTINCT item_id, s FROM (SELECT item_id, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k+4], ' ')) END) AS s FROM i WHERE len(w) > 0)),
n AS (SELECT item_id, COUNT(*) AS n_shingles FROM s GROUP BY item_id),
c AS (SELECT doc_id, text, item_id, COUNT(*) AS n_shared FROM ds JOIN s USING (s) GROUP BY ALL),
m AS (SELECT doc_id, item_id, n_shingles, MAX(n_shared) AS n_shared FROM c JOIN n USING (item_id) GROUP BY ALL)
SELECT doc_id, item_id, n_shingles, n_shared, ROUND(CAST(n_shared AS DOUBLE) / n_shingles, 6) AS containment
FROM m WHERE n_shared * 100 >= n_shingles * 80
"""
