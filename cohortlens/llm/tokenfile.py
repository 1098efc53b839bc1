"""Token ids of documents in raw binary files, with keyed access in constant time.

A shard file holds the ids of its documents one after the other, in ascending order of
``doc_id``, as little-endian numbers of 2 bytes (4 for vocabularies of 65,536 ids or more),
each document closed by the end id. After them come a directory of the shard's keys and an
index: a minimal perfect hash from key to slot, and per slot a 16-bit fingerprint of the key,
the offset (in ids) and the number of ids. A lookup probes a few bit tables, reads one slot
and compares the fingerprint; keys that aren't there are told apart but for 1 in 65,536.

The files are written by Spark's text writer, so any store that Spark writes to will do: a
row is a document's ids as raw bytes, and the "line separator" is the end id. Shards are the
ranges of a ranges of a range split by id and text hash, as many as the bytes of text ask for, so that many rows
of one id are spread over files; text moves once, ids are written where they are made. Beside them
lies a small table of each file's first and last id. A lookup goes by that table to the files that
may have the key, and reads no others.

Results of the awkward cases: a null text is empty and has the end id only; null ids come
first and have a key like any other; rows of a repeated id are kept apart by their copy number
(by hash of the text, from 0, over all files); an empty table has no shards; further columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import mixed, parts_for, text_bytes, texts
from cohortlens.session import new_table_path, reliable_checkpoint

MAGIC = b"IDSHARD1"
CACHED = 450_000
BLOCK = 20_000
TEXT_BLOCK = 4 << 20
ASCII_MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
#: Letters that the tokenizer neither composes nor takes apart.
LATIN = frozenset(chr(c) for c in range(0x250) if chr(c).isalpha() and c != 0x130)
LEVEL_SPARE = 2.0
#: Distinct keys need far fewer levels; each level keeps more than half of its keys.
MOST_LEVELS = 64
#: Bytes of text for each file, and documents that are handed to the encoder at a time.
FILE_BYTES = 32 << 20
AT_ONCE = 2500


class Encoder:
    """Ids of whole texts; equal to encoding them in one go, but each distinct word once.

    The tokenizer drops white space and never joins across it, so chunks between spaces and
    line ends can be encoded apart; it also splits a full stop or comma from the letter before
    it. Texts are taken a block at a time; when the cache of chunks is full, only those of the
    last block stay.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.width = 2 if size < 65_536 else 4
        self.kind = f"<u{self.width}"
        self.closes = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(size)])
        self.cache: dict[str, bytes] = {"": b""}
        self.known_leads: dict[str, int] = {}
        self.marks: dict[str, bytes] = {}
        self.apart([".", ","], self.marks)

    def apart(self, chunks: list[str], into: dict[str, bytes]) -> None:
        """Encode chunks of any kind; their ids are told apart by their place in the text."""
        for at in range(0, len(chunks), BLOCK):
            block = chunks[at : at + BLOCK]
            starts = np.cumsum([0, *(len(c) + 1 for c in block)])
            found = self.tokenizer.encode(" ".join(block), add_special_tokens=False)
            first = np.array([o[0] for o in found.offsets], np.int64)
            self.put(block, np.array(found.ids, self.kind), np.searchsorted(first, starts), into)

    def plain(self, chunks: list[str], into: dict[str, bytes]) -> None:
        """Encode words of Latin letters; each closes with the one id that ends a word."""
        for at in range(0, len(chunks), BLOCK):
            block = chunks[at : at + BLOCK]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(block)], add_special_tokens=False)[0].ids, self.kind)
            cuts = np.flatnonzero(self.closes[ids]) + 1
            if len(cuts) == len(block):
                self.put(block, ids, np.concatenate([[0], cuts]), into)
            else:  # a vocabulary without word ends
                self.apart(block, into)

    def put(self, block: list[str], ids: np.ndarray, cuts: np.ndarray, into: dict[str, bytes]) -> None:
        raw, at = ids.tobytes(), (cuts * self.width).tolist()
        into.update(zip(block, [raw[a:b] for a, b in zip(at, at[1:])]))

    def learn(self, chunks: set[str]) -> None:
        cache, letters, others, stopped = self.cache, set(), [], []
        for c in chunks:
            if c[-1] in self.marks and c[-2:-1] in LATIN:
                stopped.append(c)
                c = c[:-1]
                if c in cache:
                    continue
            if c.isalpha() and LATIN.issuperset(c):
                letters.add(c)
            else:
                others.append(c)
        self.plain(list(letters), cache)
        self.apart(others, cache)
        cache.update((c, cache[c[:-1]] + self.marks[c[-1]]) for c in stopped)

    def leads(self, found: list[str]) -> np.ndarray:
        """First id of each word (0 if it has none).

        It is the first id of the letters that the word begins with, as the tokenizer splits
        letters from what follows; so words that differ in punctuation are encoded once.
        """
        cores = [w if w.isalpha() or w[:1] not in LATIN else w.rstrip(ASCII_MARKS) for w in found]
        known = self.known_leads
        new = set(cores).difference(known)
        if len(known) + len(new) > CACHED:
            known = self.known_leads = {}
            new = set(cores)
        ids: dict[str, bytes] = {}
        letters = [c for c in new if c.isalpha() and LATIN.issuperset(c)]
        self.plain(letters, ids)
        self.apart(list(new.difference(letters)), ids)
        known.update((c, int.from_bytes(i[: self.width], "little")) for c, i in ids.items())
        return np.fromiter(map(known.__getitem__, cores), np.uint32, len(cores))

    def encode(self, raws: list[bytes]) -> Iterator[bytes]:
        at = 0
        while at < len(raws):
            end, held = at, 0
            while end < len(raws) and (end == at or held + len(raws[end]) <= TEXT_BLOCK):
                held += len(raws[end])
                end += 1
            block = [raw.decode("utf-8", "replace").replace("\n", " ").replace("\t", " ").split(" ") for raw in raws[at:end]]
            used = set(chain.from_iterable(block))
            new = used.difference(self.cache)
            if new:
                if len(self.cache) + len(new) > CACHED:
                    self.cache = {c: ids for c, ids in self.cache.items() if c in used}
                    self.cache[""] = b""
                self.learn(new)
            look = self.cache.__getitem__
            for chunks in block:
                yield b"".join(map(look, chunks))
            at = end

    def encode_words(self, found: list[bytes]) -> list[bytes]:
        """``encode`` of distinct words without ASCII white space."""
        out: list[bytes] = []
        for at in range(0, len(found), CACHED // 2):
            chunks = b" ".join(found[at : at + CACHED // 2]).decode("utf-8", "replace").split(" ")
            used = set(chunks)
            new = used.difference(self.cache)
            if new:
                if len(self.cache) + len(new) > CACHED:
                    self.cache = {c: ids for c, ids in self.cache.items() if c in used}
                    self.cache[""] = b""
                self.learn(new)
            out += map(self.cache.__getitem__, chunks)
        return out

    def end(self, end_id: int) -> str:
        raw = int(end_id).to_bytes(self.width, "little")
        if max(raw) > 127:
            raise ValueError("each byte of the end id must be below 128")
        return raw.decode("ascii")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def key_hash(ids: np.ndarray, null: np.ndarray, copies: np.ndarray, salt: int) -> np.ndarray:
    """Hash of each key; id and copy number are hashed on their own, with another start for every salt."""
    seed = np.uint64(salt * 0x9E3779B97F4A7C15 % (1 << 64))
    of_id = mixed(ids.astype(np.int64).view(np.uint64) + seed)
    of_copy = mixed((copies.astype(np.uint64) << np.uint64(1) | null.astype(np.uint64)) ^ mixed(np.array([seed + np.uint64(1)]))[0])
    return mixed(of_id * np.uint64(0xC2B2AE3D27D4EB4F) + of_copy)


@dataclass
class PerfectHash:
    """Levels of bit tables: a key sits in the first level where no other key shares its bit.

    Its slot is the rank of that bit among all set bits, so n keys fill the slots 0..n-1.
    """

    levels: list[np.ndarray]  # of bool

    @staticmethod
    def build(ids: np.ndarray, null: np.ndarray, copies: np.ndarray) -> PerfectHash:
        left, levels = np.arange(len(ids)), []
        while len(left):
            if len(levels) == MOST_LEVELS:
                raise ValueError("two keys of a shard are equal")
            m = max(64, int(LEVEL_SPARE * len(left)))
            at = (key_hash(ids[left], null[left], copies[left], len(levels) + 1) % np.uint64(m)).astype(np.int64)
            alone = np.bincount(at, minlength=m) == 1
            levels.append(alone)
            left = left[~alone[at]]
        return PerfectHash(levels)

    def slots(self, ids: np.ndarray, null: np.ndarray, copies: np.ndarray) -> np.ndarray:
        """Slot of each key; for keys that weren't built in, any slot or -1."""
        out, left, base = np.full(len(ids), -1, np.int64), np.arange(len(ids)), 0
        for i, bits in enumerate(self.levels):
            rank = np.cumsum(bits)
            at = (key_hash(ids[left], null[left], copies[left], i + 1) % np.uint64(len(bits))).astype(np.int64)
            here = bits[at]
            out[left[here]] = base + rank[at[here]] - 1
            left, base = left[~here], base + int(rank[-1])
        return out


def fingerprint(ids: np.ndarray, null: np.ndarray, copies: np.ndarray) -> np.ndarray:
    return (key_hash(ids, null, copies, 0) >> np.uint64(48)).astype("<u2")


def tail(ids: np.ndarray, null: np.ndarray, copies: np.ndarray, counts: np.ndarray, width: int) -> bytes:
    """Directory, index and trailer of a shard."""
    index = PerfectHash.build(ids, null, copies)
    slots = index.slots(ids, null, copies)
    offsets = np.cumsum(counts) - counts
    prints, at, n = np.zeros(len(ids), "<u2"), np.zeros(len(ids), "<i8"), np.zeros(len(ids), "<i8")
    prints[slots], at[slots], n[slots] = fingerprint(ids, null, copies), offsets, counts
    parts = [ids.astype("<i8"), null.astype("u1"), copies.astype("<i8"), prints, at, n, *[np.packbits(b) for b in index.levels]]
    body = b"".join(p.tobytes() for p in parts)
    head = json.dumps({"keys": len(ids), "ids": int(counts.sum()), "width": width, "levels": [len(b) for b in index.levels]}).encode()
    return body + head + len(body).to_bytes(8, "little") + len(head).to_bytes(8, "little") + MAGIC


@dataclass
class Shard:
    """A shard file that has been read."""

    ids: np.ndarray
    null: np.ndarray
    copies: np.ndarray
    prints: np.ndarray
    at: np.ndarray
    n: np.ndarray
    index: PerfectHash
    payload: np.ndarray

    @staticmethod
    def read(content: bytes) -> Shard:
        view = memoryview(content)
        for width in (2, 4):  # the last separator follows the trailer
            end = len(view) - width
            if bytes(view[end - 8 : end]) == MAGIC:
                break
        else:
            raise ValueError("not a shard file")
        body, head = (int.from_bytes(view[end - 24 + i : end - 16 + i], "little") for i in (0, 8))
        facts = json.loads(bytes(view[end - 24 - head : end - 24]))
        at, k, arrays = end - 24 - head - body, facts["keys"], []
        payload = np.frombuffer(view[: facts["ids"] * facts["width"]], f"<u{facts['width']}")
        for kind in ("<i8", "u1", "<i8", "<u2", "<i8", "<i8"):
            arrays.append(np.frombuffer(view, kind, k, at))
            at += arrays[-1].nbytes
        levels = []
        for m in facts["levels"]:
            raw = np.frombuffer(view, "u1", (m + 7) // 8, at)
            levels.append(np.unpackbits(raw, count=m).astype(bool))
            at += raw.nbytes
        return Shard(arrays[0], arrays[1].astype(bool), *arrays[2:], PerfectHash(levels), payload)

    def find(self, ids: np.ndarray, null: np.ndarray, copies: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Offset and number of ids of each key; -1 and 0 for a key that isn't there."""
        if not len(self.prints):
            return np.full(len(ids), -1, np.int64), np.zeros(len(ids), np.int64)
        slot = self.index.slots(ids, null, copies)
        known = (slot >= 0) & (self.prints[slot] == fingerprint(ids, null, copies))
        return np.where(known, self.at[slot], -1), np.where(known, self.n[slot], 0)


def write_tokens(docs: DataFrame, tokenizer: str, path: str, end_id: int = 2, lookup: bool = True) -> None:
    """Encode all documents and write the shard files under ``path``; ``lookup``: and the table that ``fetch`` needs."""
    rows = texts(docs).withColumn("_llm_tie", F.xxhash64("text"))
    files = parts_for(docs.sparkSession, text_bytes(docs), FILE_BYTES)
    rows = rows.repartitionByRange(files, F.col("doc_id").asc_nulls_first(), F.col("_llm_tie"))
    rows = rows.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "_llm_tie").drop("_llm_tie")
    end = encoder(tokenizer).end(end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, ids, null, copies, counts = encoder(tokenizer), [], [], [], []
        last, copy = object(), 0
        for batch in (b.slice(i, AT_ONCE) for b in batches for i in range(0, b.num_rows, AT_ONCE)):
            names = batch.column("doc_id").to_pylist()
            out, held = [], 0
            for name, raw in zip(names, code.encode(batch.column("text").to_pylist())):
                copy = copy + 1 if name == last else 0
                last = name
                ids.append(name or 0)
                null.append(name is None)
                copies.append(copy)
                counts.append(len(raw) // code.width + 1)
                out.append(raw)
                held += len(raw)
                if held > 1 << 23:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
        if ids:
            end_of_file = tail(np.array(ids, np.int64), np.array(null, bool), np.array(copies, np.int64), np.array(counts, np.int64), code.width)
            yield pa.RecordBatch.from_arrays([pa.array([end_of_file], pa.binary())], ["value"])

    encoded = rows.mapInArrow(run, "value binary")
    encoded.select(F.col("value").cast("string").alias("value")).write.option("lineSep", end).text(f"{path}/ids")
    if lookup:
        write_ranges(docs.sparkSession, path)


def shard_files(spark: SparkSession, path: str, only: list[str] | None = None) -> DataFrame:
    files = spark.read.format("binaryFile").load(f"{path}/ids" if only is None else only).where(F.col("length") > 0)
    number = F.regexp_extract("path", r"part-(\d+)", 1).cast("int")
    return files.select(number.alias("shard"), "path", "content")


RANGES = "shard int, path string, low long, high long, low_null boolean, high_null boolean, low_rows long, high_rows long"


def write_ranges(spark: SparkSession, path: str) -> None:
    """First and last id of each file, and how many rows of the file have them: one row per file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, place, content in zip(batch.column("shard").to_pylist(), batch.column("path").to_pylist(), batch.column("content")):
                shard = Shard.read(content.as_buffer())
                rows = [int(((shard.ids == shard.ids[i]) & (shard.null == shard.null[i])).sum()) for i in (0, -1)]
                one = [[name], [place], [int(shard.ids[0])], [int(shard.ids[-1])], [bool(shard.null[0])], [bool(shard.null[-1])], [rows[0]], [rows[1]]]
                kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64()]
                names = ["shard", "path", "low", "high", "low_null", "high_null", "low_rows", "high_rows"]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(one, kinds)], names)

    shard_files(spark, path).mapInArrow(run, RANGES).write.parquet(f"{path}/ranges")


def read_ranges(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RANGES).parquet(f"{path}/ranges")


def ends_of(ranges: DataFrame) -> DataFrame:
    """First and last id of each file, each with its rows there."""
    ends = "array_distinct(array(struct(low as id, low_null as null_id, low_rows as n), struct(high as id, high_null as null_id, high_rows as n)))"
    return ranges.select("shard", F.explode(F.expr(ends)).alias("e")).select("shard", "e.*")


def ends_among(found: DataFrame) -> DataFrame:
    """The same from the files' documents."""
    key = F.struct(F.col("doc_id").isNotNull(), "doc_id")
    ends = found.groupBy("shard").agg(F.min(key).alias("low"), F.max(key).alias("high"))
    # one row per file
    at_end = found.join(F.broadcast(ends), "shard").where((key == F.col("low")) | (key == F.col("high")))
    return at_end.groupBy("shard", "doc_id").agg(F.count("*").alias("n")).select("shard", F.col("doc_id").alias("id"), F.col("doc_id").isNull().alias("null_id"), "n")


def earlier_rows(ends: DataFrame) -> DataFrame:
    """Rows of a file's first id in the files before it; only files whose first id began earlier."""
    before = Window.partitionBy("id", "null_id").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return ends.withColumn("earlier", F.coalesce(F.sum("n").over(before), F.lit(0))).where("earlier > 0").select("shard", "id", "null_id", "earlier")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Every document of the files: key, place and checksum, found through the index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("shard").to_pylist(), batch.column("content")):
                shard = Shard.read(content.as_buffer())
                at, n = shard.find(shard.ids, shard.null, shard.copies)
                sums = [zlib.crc32(shard.payload[a : a + k].astype("<u4").tobytes()) for a, k in zip(at, n)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shard.ids, mask=shard.null),
                        pa.array(shard.copies),
                        pa.array(np.full(len(at), name, np.int32)),
                        pa.array(at),
                        pa.array(n),
                        pa.array(np.array(sums, np.int64)),
                    ],
                    ["doc_id", "copy", "shard", "offset", "n_tokens", "ids_crc32"],
                )

    schema = "doc_id long, copy long, shard int, offset long, n_tokens long, ids_crc32 long"
    found = reliable_checkpoint(shard_files(spark, path).mapInArrow(run, schema))
    sizes = found.groupBy("shard").agg(F.sum("n_tokens").alias("held"))
    before = Window.partitionBy(F.lit(0)).orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("first"))
    # one row per file
    joined = found.join(F.broadcast(starts), "shard")
    again = earlier_rows(ends_among(found)).select("shard", F.when(~F.col("null_id"), F.col("id")).alias("_id"), "earlier")
    # at most one row per file
    again = F.broadcast(again.withColumnRenamed("shard", "_shard"))
    joined = joined.join(again, (F.col("shard") == F.col("_shard")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    joined = joined.withColumn("copy", F.col("copy") + F.coalesce("earlier", F.lit(0)))
    return joined.select("doc_id", (F.col("first") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", "copy", "shard", "offset")


def fetch(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """Ids of the given keys (``doc_id``, ``copy``), one row per key; null ids for absent keys.

    The table of ranges tells the files that may have a key; only these are read, and in each
    the index gives the key's place.
    """
    ranges = read_ranges(spark, path)
    asked = keys.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("copy", F.lit(0)).cast("long").alias("copy")).distinct()
    null = F.col("doc_id").isNull()
    inside = (~null & (F.col("low_null") | (F.col("doc_id") >= F.col("low"))) & ~F.col("high_null") & (F.col("doc_id") <= F.col("high"))) | (null & F.col("low_null"))
    # one row per file
    spot = asked.join(F.broadcast(ranges.select("shard", "path", "low", "low_null", "high", "high_null")), inside)
    again = earlier_rows(ends_of(ranges)).select(F.col("shard").alias("_shard"), F.when(~F.col("null_id"), F.col("id")).alias("_id"), "earlier")
    spot = spot.join(F.broadcast(again), (F.col("shard") == F.col("_shard")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    spot = spot.select("doc_id", "copy", "shard", "path", (F.col("copy") - F.coalesce("earlier", F.lit(0))).alias("nth")).where("nth >= 0")
    spot = reliable_checkpoint(spot)
    needed = [r["path"] for r in spot.select("path").distinct().collect()]  # names of files
    schema = "doc_id long, copy long, ids array<long>"
    if not needed:
        return asked.withColumn("ids", F.lit(None).cast("array<long>"))

    def probe(name: tuple, asks: pd.DataFrame, files: pd.DataFrame) -> pd.DataFrame:
        none = asks["doc_id"].isna().to_numpy()
        shard = Shard.read(files["content"].iloc[0])
        at, n = shard.find(asks["doc_id"].fillna(0).to_numpy(np.int64), none, asks["nth"].to_numpy(np.int64))
        found = [shard.payload[a : a + k].astype(np.int64).tolist() if a >= 0 else None for a, k in zip(at, n)]
        return pd.DataFrame({"doc_id": asks["doc_id"].astype("Int64"), "copy": asks["copy"], "ids": pd.Series(found, index=asks.index, dtype=object)})

    files = shard_files(spark, path, needed).select("shard", "content")
    hits = spot.select("doc_id", "copy", "nth", "shard").groupBy("shard").cogroup(files.groupBy("shard")).applyInPandas(probe, schema)
    hits = hits.where("ids is not null").select(F.col("doc_id").alias("_doc"), F.col("copy").alias("_copy"), "ids")
    return asked.join(hits, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("copy") == F.col("_copy")), "left").select("doc_id", "copy", "ids")


def token_table(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write the documents' ids to new files in the shared folder and read them back."""
    spark = docs.sparkSession
    path = new_table_path(spark, "tokens")
    write_tokens(docs, tokenizer, path, end_id, lookup=False)
    return read_tokens(spark, path)
