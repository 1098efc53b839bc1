"""Alignment of two tokenizers over a corpus, with inverted pair bitmaps.

Both tokenizers cut a text into byte ranges. Offsets where tokens of both end cut it into groups;
every token of the first (A) is linked with every token of the second (B) in its group.

* A task takes documents block by block (``BLOCK_DOCS``, ``BLOCK_BYTES``). Tokens don't reach over a
  single space, so every distinct chunk between spaces is encoded and aligned once; texts with white
  space at other places are aligned whole.
* A block's postings are bitmaps over its documents: per id pair one plane for each binary digit of
  the number of links in a document. A plane is a list of places, or bits when many are set.
* The postings of an A id meet in one partition. There the planes of a pair are OR-merged and
  popcounted: documents that hold the pair; planes' popcounts times their weights: links. Then the
  postings are walked again and return each document its sums, block by block.

A pair has one posting per document at most, so a pair that is in all documents weighs as much as a
few of a document's other pairs; the number of partitions comes from the bytes of text.

Results of the awkward cases: null and empty texts, and texts whose joined token bytes aren't the
text (for instance with U+2581, which B reads as a space), have no tokens: zeros and an empty digest.
Rows of a repeated id are documents of their own. A very long text is a block of its own; a group
with very many tokens on both sides is linked by distinct ids. Other columns are left out; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import mixed
from cohortlens.session import reliable_checkpoint, shuffle_width

BLOCK_DOCS = 1 << 16
BLOCK_BYTES = 3 << 20
#: Chunks that a worker remembers; when it has more, those of the last block stay.
CACHED = 300_000
#: Chunks that are aligned at a time, and those that are encoded as one text.
LEARNT = 16_000
JOINED = 2000
#: Chunks of which any number between spaces is encoded like each alone.
PLAIN = re.compile("[!-~\xa1-\xac\xae-\u024f][!-~\xa1-\xac\xae-\u024f\n]*").fullmatch
#: Fixed: how byte-level vocabularies of this kind cut a text before merging.
CUT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SAMPLE = "It's what they'd called Übung; 12345 times, x==y...\nNaïve façade (no. 7) @home --- 3.14"
#: Links that are made explicit at a time.
AT_ONCE = 4_000_000
#: Bytes of text for each partition of pairs.
PART_BYTES = 64 << 20
#: A plane with more places than this share of the block's documents is kept as bits.
DENSE = 1 / 16


@dataclass(frozen=True)
class Tokenizers:
    """Files of the two tokenizers: a byte-level vocabulary (A) and a piece model with byte fallback (B)."""

    a_path: str
    b_path: str

    def __reduce__(self) -> tuple:
        # a pickled tokenizer forgets that special tokens are plain text
        return Tokenizers, (self.a_path, self.b_path)

    @cached_property
    def a(self) -> object:
        from tokenizers import Tokenizer

        found = Tokenizer.from_file(self.a_path)
        found.encode_special_tokens = True
        return found

    @cached_property
    def b(self) -> object:
        from sentencepiece import SentencePieceProcessor

        return SentencePieceProcessor(model_file=self.b_path)

    @cached_property
    def a_bytes(self) -> list[bytes]:
        """Bytes of each A id: the printable stand-ins of a byte-level vocabulary undone."""
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in set(plain)]
        byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
        names = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        return [bytes(byte_of.get(c, 0) for c in name) for name in names]

    @cached_property
    def b_bytes(self) -> list[bytes]:
        b = self.b
        pieces = [b.id_to_piece(i) for i in range(b.get_piece_size())]
        return [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]

    @cached_property
    def a_quick(self) -> object | None:
        """The same vocabulary for a faster library, if its ids are its merge ranks."""
        from tiktoken import Encoding

        try:
            quick = Encoding("a", pat_str=CUT, mergeable_ranks={x: i for i, x in enumerate(self.a_bytes) if x and self.a.id_to_token(i) not in self.special}, special_tokens={})
            same = quick.encode_ordinary(SAMPLE) == self.a.encode(SAMPLE, add_special_tokens=False).ids
        except (ValueError, KeyError):
            same = False
        return quick if same else None

    @cached_property
    def special(self) -> set[str]:
        return {t.content for t in self.a.get_added_tokens_decoder().values()}

    def encode(self, chunks: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of a space and each chunk; B puts the space there itself."""
        found = self.a.encode_batch_fast([" " + c for c in chunks], add_special_tokens=False)
        return [e.ids for e in found], self.b.encode(chunks, num_threads=1)


def ends_of(ids: np.ndarray, sizes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Of each id the chunk (upper 32 bits) and the byte offset where it ends in it."""
    ends = np.cumsum(lengths[ids])
    base = np.r_[0, ends][np.cumsum(sizes) - sizes]
    return ends - np.repeat(base, sizes) + (np.repeat(np.arange(len(sizes)), sizes) << 32)


def flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    return np.array(list(chain.from_iterable(ids)), np.int64), np.fromiter(map(len, ids), np.int64, len(ids))


def summed(keys: np.ndarray, amounts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with the sums of their amounts."""
    order = np.argsort(keys, kind="stable")
    keys, amounts = keys[order], amounts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(amounts, first) if len(first) else amounts


@dataclass
class Chunks:
    """Aligned chunks: sizes, digest text and pairs of each (``pairs[cuts[i]:cuts[i + 1]]``)."""

    n: np.ndarray  # columns: tokens of A, tokens of B, groups, links
    usable: np.ndarray
    told: list[bytes]
    cuts: np.ndarray
    pairs: np.ndarray
    amounts: np.ndarray


@lru_cache(maxsize=1)
def aligner_of(tokenizers: Tokenizers) -> Aligner:
    """A worker's aligner; what it has learnt serves the next task."""
    return Aligner(tokenizers)


class Aligner:
    def __init__(self, tokenizers: Tokenizers) -> None:
        self.tokenizers = tokenizers
        self.a_len = np.array([len(x) for x in tokenizers.a_bytes], np.int64)
        self.b_len = np.array([len(x) for x in tokenizers.b_bytes], np.int64)
        self.width = len(self.b_len)
        # digest text of an id within a group, and at its end
        self.names = [b"%d%s" % (i, s) for end, n in ((b"|", len(self.a_len)), (b";", self.width)) for i in range(n) for s in (b",", end)]
        self.known: dict[str, int] = {}
        self.clear()

    def clear(self) -> None:
        self.known = {"": 0}
        self.held = Chunks(np.zeros((1, 4), np.int64), np.zeros(1, bool), [b""], np.zeros(2, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        self.regular = np.zeros(1, bool)  # a text with an empty chunk or one that starts with white space is taken whole

    def forget(self, used: set[str]) -> None:
        """Keep only chunks that are in use."""
        old, known = self.held, self.known
        names = [c for c in known if c and c in used]
        places = np.fromiter(map(known.__getitem__, names), np.int64, len(names))
        regular = self.regular
        self.clear()
        n = old.cuts[places + 1] - old.cuts[places]
        at = np.arange(int(n.sum())) + np.repeat(old.cuts[places] - (np.cumsum(n) - n), n)
        kept = Chunks(old.n[places], old.usable[places], [old.told[i] for i in places.tolist()], np.r_[0, np.cumsum(n)], old.pairs[at], old.amounts[at])
        self.put(names, kept, True)
        self.regular[1:] = regular[places]

    def encode_apart(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids and numbers of ids of each chunk, for both sides, and which chunks give their bytes back."""
        t = self.tokenizers
        a_ids, b_ids = t.encode(chunks)
        usable = np.zeros(len(chunks), bool)
        for i, (c, a, b) in enumerate(zip(chunks, a_ids, b_ids)):
            raw = b" " + c.encode("utf-8", "surrogatepass")
            usable[i] = bool(c) and b"".join(map(t.a_bytes.__getitem__, a)) == raw and b"".join(map(t.b_bytes.__getitem__, b)) == raw
            if not usable[i]:
                a_ids[i], b_ids[i] = [], []
        return *flat(a_ids), *flat(b_ids), usable

    def encode_joined(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The same for plain chunks, encoded as one text and told apart by their bytes."""
        t, text = self.tokenizers, " ".join(chunks)
        raw = (" " + text).encode()
        stops = np.cumsum([len(c.encode()) + 1 for c in chunks])
        out = []
        for ids, names, lengths in ((t.a_quick.encode_ordinary(" " + text), t.a_bytes, self.a_len), (t.b.encode(text), t.b_bytes, self.b_len)):
            if b"".join(map(names.__getitem__, ids)) != raw:
                return self.encode_apart(chunks)
            found = np.array(ids, np.int64)
            ends = np.cumsum(lengths[found])
            last = np.searchsorted(ends, stops)
            if (ends[last] != stops).any():
                return self.encode_apart(chunks)
            out += [found, np.diff(last, prepend=-1)]
        return *out, np.ones(len(chunks), bool)

    def encoded(self, chunks: list[str]) -> tuple[list[str], list[np.ndarray]]:
        """Chunks in another order, with what ``encode_apart`` tells of them."""
        plain = [c for c in chunks if PLAIN(c)] if self.tokenizers.a_quick else []
        others = list(set(chunks).difference(plain)) if len(plain) < len(chunks) else []
        found = [self.encode_joined(plain[i : i + JOINED]) for i in range(0, len(plain), JOINED)]
        found += [self.encode_apart(others)] if others else []
        return plain + others, [np.concatenate(x) for x in zip(*found)]

    def align(self, chunks: list[str], found: list[np.ndarray]) -> Chunks:
        a, a_sizes, b, b_sizes, usable = found
        a_end, b_end = ends_of(a, a_sizes, self.a_len), ends_of(b, b_sizes, self.b_len)
        common = np.intersect1d(a_end, b_end, assume_unique=True)
        ga, gb = np.searchsorted(common, a_end), np.searchsorted(common, b_end)
        in_a, in_b = np.bincount(ga, minlength=len(common)), np.bincount(gb, minlength=len(common))
        end_a, start_b = np.cumsum(in_a), np.cumsum(in_b) - in_b
        chunk = common >> 32
        n = len(chunks)
        tallies = np.stack([np.bincount(x >> 32, minlength=n) for x in (a_end, b_end, common)] + [np.zeros(n, np.int64)], axis=1)
        np.add.at(tallies[:, 3], chunk, in_a * in_b)
        # digest text: A tokens of a group, then its B tokens
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + start_b[ga] if len(a) else []] = 2 * a + np.r_[ga[1:] != ga[:-1], True][: len(a)]
        order[np.arange(len(b)) + end_a[gb] if len(b) else []] = 2 * (b + len(self.a_len)) + np.r_[gb[1:] != gb[:-1], True][: len(b)]
        names = list(map(self.names.__getitem__, order.tolist()))
        stops = np.cumsum(tallies[:, 0] + tallies[:, 1]).tolist()
        told = [b"".join(names[s:e]) for s, e in zip([0, *stops], stops)]
        keys, amounts = self.links(a, b, ga, start_b, in_b, in_a, end_a, chunk)
        cuts = np.searchsorted(keys // (len(self.a_len) * self.width), np.arange(n + 1))
        return Chunks(tallies, usable, told, cuts, keys % (len(self.a_len) * self.width), amounts)

    def links(self, a, b, ga, start_b, in_b, in_a, end_a, chunk) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (chunk, pair) keys and their numbers of links."""
        space = len(self.a_len) * self.width
        big = in_a * in_b > AT_ONCE
        found = []
        for g in np.flatnonzero(big):
            ua, na = np.unique(a[end_a[g] - in_a[g] : end_a[g]], return_counts=True)
            ub, nb = np.unique(b[start_b[g] : start_b[g] + in_b[g]], return_counts=True)
            for i in range(len(ua)):
                found.append((chunk[g] * space + ua[i] * self.width + ub, na[i] * nb))
        at = np.flatnonzero(~big[ga]) if len(a) else np.zeros(0, np.int64)
        times = in_b[ga[at]] if len(a) else np.zeros(0, np.int64)
        total = np.cumsum(times)
        for s in range(0, int(total[-1]) if len(total) else 0, AT_ONCE):
            i, j = np.searchsorted(total, [s, s + AT_ONCE], "right")
            mine, rep = at[i:j], times[i:j]
            if not len(mine):
                continue
            nth = np.arange(int(rep.sum())) - np.repeat(np.cumsum(rep) - rep, rep)
            left = np.repeat(mine, rep)
            key = chunk[ga[left]] * space + a[left] * self.width + b[start_b[ga[left]] + nth]
            found.append(summed(key, np.ones(len(key), np.int64)))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return summed(np.concatenate([k for k, _ in found]), np.concatenate([m for _, m in found]))

    def put(self, chunks: list[str], found: Chunks, name: bool) -> int:
        """Keep aligned chunks; returns the place of the first."""
        held, first = self.held, len(self.held.told)
        if name:
            self.known.update(zip(chunks, range(first, first + len(chunks))))
        held.n = np.concatenate([held.n, found.n])
        held.usable = np.concatenate([held.usable, found.usable])
        held.told += found.told
        held.cuts = np.concatenate([held.cuts, found.cuts[1:] + held.cuts[-1]])
        held.pairs = np.concatenate([held.pairs, found.pairs])
        held.amounts = np.concatenate([held.amounts, found.amounts])
        self.regular = np.concatenate([self.regular, np.array([not c[:1].isspace() for c in chunks], bool)])
        return first

    def block(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Sizes and digests of each text; (pair, place of the text, links) of all, ascending."""
        split = [t.split(" ") if t else [] for t in texts]
        used = set().union(*split)
        new = list(used.difference(self.known))
        if len(self.held.told) + len(new) > CACHED:
            self.forget(used)
        for i in range(0, len(new), LEARNT):
            names, found = self.encoded(new[i : i + LEARNT])
            self.put(names, self.align(names, found), True)
        places = [np.fromiter(map(self.known.__getitem__, x), np.int64, len(x)) for x in split]
        whole = [i for i, p in enumerate(places) if len(p) and not self.regular[p].all()]
        if whole:
            apart = [texts[i] for i in whole]
            first = self.put([""] * len(whole), self.align(apart, list(self.encode_apart(apart))), False)
            for j, i in enumerate(whole):
                places[i] = np.array([first + j])
        held = self.held
        sizes, digests = np.zeros((len(texts), 4), np.int64), [""] * len(texts)
        for i, p in enumerate(places):
            if len(p) and held.usable[p].all():
                sizes[i] = held.n[p].sum(axis=0)
                digests[i] = hashlib.sha256(b"".join(map(held.told.__getitem__, p.tolist()))[:-1]).hexdigest()
            else:
                places[i] = p[:0]
        lengths = np.array([len(p) for p in places])
        key, often = np.unique(np.repeat(np.arange(len(places)), lengths) << 32 | np.concatenate([np.zeros(0, np.int64), *places]), return_counts=True)
        doc, place = key >> 32, key & 0xFFFFFFFF
        n = held.cuts[place + 1] - held.cuts[place]
        at = np.arange(int(n.sum())) + np.repeat(held.cuts[place] - (np.cumsum(n) - n), n)
        return sizes, digests, held.pairs[at], np.repeat(doc, n), held.amounts[at] * np.repeat(often, n)


def ordered(pair: np.ndarray, doc: np.ndarray, links: np.ndarray, space: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sum up equal (pair, doc); ascending. One sort of packed numbers where they fit."""
    if len(pair) and space <= 1 << 31 and links.max() < 1 << 17:
        packed = np.sort(pair.astype(np.uint64) << np.uint64(33) | doc.astype(np.uint64) << np.uint64(17) | links.astype(np.uint64))
        key, links = packed >> np.uint64(17), (packed & np.uint64((1 << 17) - 1)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        key, links = key[first], np.add.reduceat(links, first)
    else:
        key, links = summed(pair.astype(np.uint64) << np.uint64(16) | doc.astype(np.uint64), links)
    return (key >> np.uint64(16)).astype(np.int64), (key & np.uint64(0xFFFF)).astype(np.int64), links


def postings(pair: np.ndarray, doc: np.ndarray, links: np.ndarray, n_docs: int) -> bytes:
    """Bitmaps over a block's documents for ascending (pair, doc): a plane for each binary digit of the links."""
    names, at = np.unique(pair, return_inverse=True)
    out = [np.array([n_docs, len(names)], "<i8").tobytes(), np.diff(names, prepend=0).astype("<i8").tobytes()]
    width = -(-n_docs // 8)
    for j in range(int(links.max()).bit_length()):
        on = np.flatnonzero(links >> j & 1)
        count = np.bincount(at[on], minlength=len(names))
        dense = count > max(8, n_docs * DENSE)
        loose = on[~dense[at[on]]]
        bits = np.zeros((int(dense.sum()), width * 8), np.uint8)
        tight = on[dense[at[on]]]
        bits[(np.cumsum(dense) - 1)[at[tight]], doc[tight]] = 1
        out += [np.where(dense, -1, count).astype("<i4").tobytes(), doc[loose].astype("<u2").tobytes(), np.packbits(bits, axis=1).tobytes()]
    return zstandard.compress(b"".join(out), 3)


class Postings:
    """Planes of a block's pairs, read back."""

    def __init__(self, blob: bytes) -> None:
        raw = zstandard.decompress(blob)
        self.n_docs, n = (int(x) for x in np.frombuffer(raw, "<i8", 2))
        self.pairs = np.cumsum(np.frombuffer(raw, "<i8", n, 16))
        at, width = 16 + 8 * n, -(-self.n_docs // 8)
        self.planes: list[np.ndarray] = []  # places of pairs and documents: index << 16 | document
        while at < len(raw):
            count = np.frombuffer(raw, "<i4", n, at)
            at += 4 * n
            dense = np.flatnonzero(count < 0)
            count = np.maximum(count, 0)
            loose = np.frombuffer(raw, "<u2", int(count.sum()), at).astype(np.int64)
            at += 2 * len(loose)
            bits = np.unpackbits(np.frombuffer(raw, np.uint8, len(dense) * width, at).reshape(len(dense), width), axis=1)
            at += len(dense) * width
            row, doc = np.nonzero(bits)
            self.planes.append(np.concatenate([np.repeat(np.arange(n), count) << 16 | loose, dense[row] << 16 | doc]))

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Documents (popcount of the OR of the planes) and links (weighted popcounts) of each pair."""
        any_plane = self.planes[0] if len(self.planes) == 1 else np.unique(np.concatenate(self.planes))
        documents = np.bincount(any_plane >> 16, minlength=len(self.pairs))
        return documents, sum(np.bincount(p >> 16, minlength=len(self.pairs)) << j for j, p in enumerate(self.planes))

    def return_scores(self, scores: np.ndarray) -> np.ndarray:
        """Per document the sum of links times each column of the pairs' scores."""
        out = np.zeros((self.n_docs, scores.shape[1]), np.int64)
        for j, p in enumerate(self.planes):
            np.add.at(out, p & 0xFFFF, scores[p >> 16] << j)
        return out


def pair_totals(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of a partition with documents and links over all blocks; blocks share no document."""
    pairs, documents, links, waiting = (np.zeros(0, np.int64),) * 3 + ([],)
    for i, blob in enumerate(blobs):
        p = Postings(blob)
        waiting.append((p.pairs, *p.counts()))
        if sum(len(w[0]) for w in waiting) > AT_ONCE or i + 1 == len(blobs):
            key = np.concatenate([pairs, *(w[0] for w in waiting)])
            pairs, at = np.unique(key, return_inverse=True)
            sums = np.zeros((2, len(pairs)), np.int64)
            np.add.at(sums[0], at, np.concatenate([documents, *(w[1] for w in waiting)]))
            np.add.at(sums[1], at, np.concatenate([links, *(w[2] for w in waiting)]))
            documents, links, waiting = sums[0], sums[1], []
    return pairs, documents, links


SIZES = ["n_a", "n_b", "n_groups", "n_links"]
ROWS = pa.schema(
    [("block", pa.int64()), ("part", pa.int32()), ("postings", pa.binary()), ("doc_id", pa.int64()), ("place", pa.int32())]
    + [(c, pa.int64()) for c in SIZES]
    + [("groups_sha256", pa.string())]
)
ROWS_DDL = "block long, part int, postings binary, doc_id long, place int, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def part_of(a_ids: np.ndarray, parts: int) -> np.ndarray:
    return (mixed(a_ids.astype(np.uint64) + np.uint64(1)) % np.uint64(parts)).astype(np.int64)


def aligned(docs: DataFrame, tokenizers: Tokenizers) -> DataFrame:
    """Rows of documents (``part`` is null) and postings by block and part, kept by a checkpoint."""
    thin = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = thin.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(shuffle_width(docs.sparkSession), -(-size // PART_BYTES))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, task = aligner_of(tokenizers), TaskContext.get().partitionId()
        part = part_of(np.arange(len(aligner.a_len)), parts)
        space = len(aligner.a_len) * aligner.width
        # pairs are numbered by partition, so that a partition's postings lie together
        by_part = np.argsort(part, kind="stable")
        rank = np.empty(len(part), np.int64)
        rank[by_part] = np.arange(len(part))
        first_of = np.searchsorted(part[by_part], np.arange(parts + 1)) * aligner.width
        n = 0
        for ids, texts in blocks(batches):
            block = task << 32 | n
            n += 1
            sizes, digests, pair, doc, links = aligner.block(texts)
            pair, doc, links = ordered(rank[pair // aligner.width] * aligner.width + pair % aligner.width, doc, links, space)
            cuts = np.searchsorted(pair, first_of)
            pair = by_part[pair // aligner.width] * aligner.width + pair % aligner.width
            m = len(texts)
            columns = [pa.array([block] * m, pa.int64()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary()), pa.array(ids, pa.int64()), pa.array(range(m), pa.int32())]
            yield pa.record_batch([*columns, *(pa.array(sizes[:, j]) for j in range(4)), pa.array(digests, pa.string())], ROWS)
            for q in np.flatnonzero(np.diff(cuts)):
                s, e = cuts[q], cuts[q + 1]
                blob = postings(pair[s:e], doc[s:e], links[s:e], m)
                empty = [pa.nulls(1, f.type) for f in ROWS][3:]
                yield pa.record_batch([pa.array([block], pa.int64()), pa.array([int(q)], pa.int32()), pa.array([blob], pa.binary()), *empty], ROWS)

    return reliable_checkpoint(thin.mapInArrow(rows, ROWS_DDL))


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    ids, texts, held = [], [], 0
    for b in batches:
        for i, t in zip(b["doc_id"].to_pylist(), b["text"]):
            text = t.as_py()
            if texts and (len(texts) == BLOCK_DOCS or held + len(text) > BLOCK_BYTES):
                yield ids, texts
                ids, texts, held = [], [], 0
            ids.append(i)
            texts.append(text)
            held += len(text)
    if texts:
        yield ids, texts


def pair_counts(docs: DataFrame, tokenizers: Tokenizers) -> DataFrame:
    """Every linked id pair: a_id, b_id, documents, links."""
    width = tokenizers.b.get_piece_size()

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        pairs, documents, links = pair_totals(list(pdf["postings"]))
        return pd.DataFrame({"a_id": pairs // width, "b_id": pairs % width, "documents": documents, "links": links})

    found = aligned(docs, tokenizers).where("part is not null")
    return found.select("part", "postings").groupBy("part").applyInPandas(count, "a_id long, b_id long, documents long, links long")


def alignment(docs: DataFrame, tokenizers: Tokenizers) -> DataFrame:
    """Sizes, scores and digest of every document's alignment."""
    rows = aligned(docs, tokenizers)
    width = tokenizers.b.get_piece_size()

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        pairs, documents, _ = pair_totals(list(pdf["postings"]))
        a = pairs // width
        first = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
        best = np.repeat(np.maximum.reduceat(documents, first), np.diff(np.r_[first, len(a)]))
        scores = np.stack([(documents == best).astype(np.int64), documents], axis=1)
        out = []
        for blob in pdf["postings"]:
            p = Postings(blob)
            sums = p.return_scores(scores[np.searchsorted(pairs, p.pairs)])
            place = np.flatnonzero(sums[:, 1])
            out.append(zstandard.compress(b"".join([place.astype("<u2").tobytes(), sums[place].T.astype("<i8").tobytes()]), 1))
        return pd.DataFrame({"block": pdf["block"], "sums": out})

    def finish(pdf: pd.DataFrame, sums: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros((2, len(pdf)), np.int64)
        for blob in sums["sums"]:
            raw = zstandard.decompress(blob)
            n = len(raw) // 18
            total[:, np.frombuffer(raw, "<u2", n).astype(np.int64)] += np.frombuffer(raw, "<i8", 2 * n, 2 * n).reshape(2, n)
        place = pdf["place"].to_numpy()
        out = pdf[["doc_id", *SIZES]].copy()
        out["n_best"], out["count_sum"], out["groups_sha256"] = total[0][place], total[1][place], pdf["groups_sha256"]
        return out

    returned = rows.where("part is not null").select("part", "block", "postings").groupBy("part").applyInPandas(score, "block long, sums binary")
    of_docs = rows.where("part is null").drop("part", "postings")
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return of_docs.groupBy("block").cogroup(returned.groupBy("block")).applyInPandas(finish, schema)
