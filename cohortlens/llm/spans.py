"""Substring deduplication by sliding spans of sentences.

A sentence ends with a run of ``.``, ``!`` or ``?``, or at a line end; blank ones don't count.
From every sentence a span runs over consecutive sentences of the document: the fewest that are
at least ``SENTENCES`` and have ``least_words`` words together. Spans of all documents are joined by a
hash of their words; the first occurrence is the one with the smallest document id, then
position. Every sentence that lies in a span which isn't the first of its kind is removed.

Without a least number of words these are all runs of ``SENTENCES`` sentences, and they remove what
all longer runs would: where a run occurred before, each run of ``SENTENCES`` within it did as well,
and together they cover it. That is the query's rule. With a least number of words (``WORDS`` if not
given), shorter repeats stay, and so do a passage's last sentences.

A span hash's first occurrence is a minimum that is combined before the shuffle; the join
back is one that Spark can split, so a passage in a third of all documents is no hot task.

Results of the awkward cases: a null or empty text has no sentences and keeps nothing; a
document with too few sentences or words keeps all; null ids come last in the order of
occurrences; rows that share an id are told apart by their text's hash, and equal rows count as
one occurrence, so that a repeated row is decided like its twin; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import WordHashes, at_home, homes_of, mixed, texts, word_codes
from cohortlens.session import reliable_checkpoint

SENTENCES = 2
WORDS = 20
END = np.uint64(0x5E)
SENTENCE = re.compile(rb"[^.!?\n]*[.!?]+|[^.!?\n]+")


def sentences(raw: bytes) -> list[tuple[int, int]]:
    """Start and end of each sentence that isn't blank."""
    return [m.span() for m in SENTENCE.finditer(raw) if m.group().strip()]


def spans(raw: bytes, hashes: WordHashes, least: int = SENTENCES, least_words: int = WORDS) -> list[tuple[int, int, int]]:
    """Hash, first and last sentence of every span."""
    codes = [word_codes(raw[a:b], hashes) for a, b in sentences(raw)]
    if len(codes) < least:
        return []
    sizes = np.array([len(c) for c in codes])
    upto = np.concatenate([[0], np.cumsum(sizes)])
    starts = np.arange(len(codes))
    ends = np.maximum(np.searchsorted(upto, upto[:-1] + least_words, "left"), starts + least)
    starts, ends = starts[ends <= len(codes)], ends[ends <= len(codes)]
    # sentence ends are part of the hash: the same words cut otherwise are another span
    marked = np.insert(np.concatenate(codes), upto[1:], END)
    at = upto + np.arange(len(upto))
    up, down = powers(len(marked))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(marked * up[: len(marked)], dtype=np.uint64)])
    keys = mixed((sums[at[ends]] - sums[at[starts]]) * down[at[starts]])
    return list(zip(keys.tolist(), starts.tolist(), (ends - 1).tolist()))


@lru_cache(maxsize=2)
def power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    base = 0x9E3779B97F4A7C15
    both = []
    for b in (base, pow(base, -1, 1 << 64)):
        out = np.full(n, b, np.uint64)
        out[0] = 1
        both.append(np.cumprod(out, dtype=np.uint64))
    return both[0], both[1]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64, at least ``n`` of each."""
    return power_table(max(1 << 16, 1 << int(n).bit_length()))


def span_rows(docs: DataFrame, least_words: int) -> DataFrame:
    """One row per span: document, hash, first and last sentence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            names, versions, keys, first, last = [], [], [], [], []
            for name, version, raw in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "version", "text"))):
                for key, i, j in spans(raw, hashes, least_words=least_words):
                    names.append(name)
                    versions.append(version)
                    keys.append(key)
                    first.append(i)
                    last.append(j)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(names, pa.int64()),
                    pa.array(versions, pa.int64()),
                    pa.array(np.array(keys, np.uint64).view(np.int64)),
                    pa.array(first, pa.int32()),
                    pa.array(last, pa.int32()),
                ],
                ["doc_id", "version", "key", "first", "last"],
            )

    return docs.mapInArrow(run, "doc_id long, version long, key long, first int, last int")


def versions(docs: DataFrame) -> DataFrame:
    return texts(docs).withColumn("version", F.xxhash64("text"))


def repeated_spans(docs: DataFrame, least_words: int = WORDS) -> DataFrame:
    """Spans that aren't the first of their kind."""
    rows = span_rows(versions(docs), least_words)
    place = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "version", F.col("first").alias("at"))
    firsts = rows.groupBy("key").agg(F.min(place).alias("origin"), F.max(place).alias("final"))
    # kept, so that both sides of the join are plain shuffles and Spark can split a frequent key
    firsts = reliable_checkpoint(firsts.where(F.col("origin") != F.col("final")).select("key", "origin"))
    return rows.join(firsts, "key").where(place != F.col("origin")).select("doc_id", "version", "first", "last")


def deduplicate(docs: DataFrame, least_words: int = WORDS) -> DataFrame:
    """Every document with its sentences and what is left of it.

    ``removed`` lists the removed sentences, from 0; ``kept_text`` is the text without their bytes, so
    that a text that loses nothing stays as it is, and empty if no sentence is left.
    """
    homes = homes_of(docs.sparkSession)
    texts_at = at_home(versions(docs), homes)
    covered = (
        repeated_spans(docs, least_words)
        .groupBy("doc_id", "version")
        .agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    )
    same = F.col("t.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("t.version") == F.col("c.version"))
    joined = texts_at.alias("t").join(covered.alias("c"), same, "left").select("t.doc_id", "t.text", "c.spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for name, raw, found in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "spans"))):
                cuts = sentences(raw)
                gone = np.zeros(len(cuts) + 1, np.int64)
                for s in found or ():
                    gone[s["first"]] += 1
                    gone[s["last"] + 1] -= 1
                covered = np.cumsum(gone)[:-1] > 0
                kept, at = [], 0
                for (a, b), c in zip(cuts, covered):
                    if c:
                        kept.append(raw[at:a])
                        at = b
                kept = b"" if covered.all() else b"".join([*kept, raw[at:]])
                out.append((name, len(cuts), int(covered.sum()), np.flatnonzero(covered).tolist(), kept))
            frame = pd.DataFrame(out, columns=["doc_id", "n_sentences", "n_removed", "removed", "kept"])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([o[0] for o in out], pa.int64()),
                    pa.array(frame["n_sentences"].to_numpy(np.int32)),
                    pa.array(frame["n_removed"].to_numpy(np.int32)),
                    pa.array([o[3] for o in out], pa.list_(pa.int32())),
                    pa.array([o[4] for o in out], pa.binary()),
                ],
                ["doc_id", "n_sentences", "n_removed", "removed", "kept"],
            )

    found = joined.mapInArrow(run, "doc_id long, n_sentences int, n_removed int, removed array<int>, kept binary")
    return found.select("doc_id", "n_sentences", "n_removed", "removed", F.col("kept").cast("string").alias("kept_text"))
