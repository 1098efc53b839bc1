"""Phrase collocations, counted in HAT-tries.

A phrase of 2 to 4 words is a candidate if it occurs ``least`` times in its language. Its score is
how often it occurs against how often its two parts occur, at the weakest cut. Candidates that
mostly occur inside a longer one are dropped; the best ``top`` of each language are returned.

Counting takes three passes over the texts, because a frequent phrase has frequent parts only:
words, then pairs of frequent words, then runs of 3 and 4 words whose pairs are all frequent. What
is frequent reaches the tasks as a bitmap of bounded size (``BITS``); strange bits that are set
by chance cost counting and change no result.

In a task, ``Trie`` counts the phrases of one language. Its root leads from the first word's id to a
hash container of packed rests; a container of more than ``BURST`` keys bursts into one container for
each next word. At ``HELD`` keys the largest subtrees are spilled whole, as runs sorted by word codes
and cut by prefix partition (first two words, so that a frequent first word is spread). Each
prefix partition merges its runs; only frequent phrases leave it. Codes are 64-bit hashes of words;
two words of one code in a language are found by their bytes, and the count starts again with another seed.

Results of the awkward cases: a null text is empty and gives no phrase, a null language is ``und``;
repeated ids and rows are counted each; a very long text is taken piece by piece within its row;
ties are ranked by phrase; other columns are left out; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import mixed
from cohortlens.session import reliable_checkpoint, shuffle_width

LEAST = 30
TOP = 2000
LONGEST = 4
#: Words that a task remembers before its tries are spilled and its numbering starts anew; ids have 21 bits.
WORDS = 400_000
ID_BITS = 21
#: Keys of a hash container before it bursts, and of all tries of a task before subtrees are spilled.
BURST = 4096
HELD = 1_000_000
#: Words that are counted at a time.
BATCH = 400_000
#: Bits of a bitmap of what is frequent: 16 for each entry, 2^27 (16 MB) at most.
BITS = (1 << 16, 1 << 27)
#: Bytes of text for each prefix partition.
PART_BYTES = 4 << 20
CHUNK = 4096
#: Bytes of a text that are split into words at a time.
SLICE = 1 << 20
SPACE = re.compile(rb"[\x20\x09-\x0d]")

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0a\x0b\x0c\x0d", b"abcdefghijklmnopqrstuvwxyz " + b"\n" * 10)
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def marked_words(raw: bytes) -> list[bytes]:
    """The words of a text in order; ``\\n`` stands between pieces, empty strings mean nothing."""
    return raw.translate(LOWER).replace(b"\n", b" \n ").split(b" ")


def slices(raw: bytes) -> Iterator[bytes]:
    """A very long text bit by bit, cut where a word ends."""
    a = 0
    while len(raw) - a > SLICE:
        end = SPACE.search(raw, a + SLICE)
        b = end.start() if end else len(raw)
        yield raw[a:b]
        a = b
    yield raw[a:]


def code_of(word: bytes, seed: int) -> int:
    return xxhash.xxh64_intdigest(word, seed)


def lang_code(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(lang.encode(), 1))


def folded(codes: list[np.ndarray], lang: np.uint64) -> np.ndarray:
    """One number for a run of word codes of a language."""
    acc = np.full(len(codes[0]), lang, np.uint64)
    for c in codes:
        acc = mixed(acc * FACTOR + c)
    return acc


class Bitmap:
    """Which folded codes are frequent; may hold more."""

    def __init__(self, raw: bytes) -> None:
        self.bits = np.frombuffer(raw, np.uint8)
        self.mask = np.uint64(len(raw) * 8 - 1)

    def holds(self, folds: np.ndarray) -> np.ndarray:
        at = folds & self.mask
        return (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def texts_of(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.col("text").cast("string").cast("binary").alias("text"),
    ).where("text is not null and length(text) > 0")


def count_words(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("lang", pa.string()), ("code", pa.int64()), ("word", pa.binary()), ("n", pa.int64())])
    counts: dict[str, Counter] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for lang, found in counts.items():
            found.pop(b"", None)
            found.pop(b"\n", None)
            if found:
                words = list(found)
                codes = np.fromiter((code_of(w, seed) for w in words), np.uint64, len(words)).view(np.int64)
                yield pa.record_batch([pa.array([lang] * len(words)), pa.array(codes), pa.array(words, pa.binary()), pa.array(list(found.values()), pa.int64())], schema)
        counts.clear()

    for b in batches:
        for lang, raw in zip(b["lang"].to_pylist(), b["text"]):
            for piece in slices(raw.as_py()):
                counts.setdefault(lang, Counter()).update(marked_words(piece))
                if sum(map(len, counts.values())) > WORDS:
                    yield from out()
    yield from out()


def word_table(texts: DataFrame) -> tuple[DataFrame, int]:
    """All words (lang, code, word, n) and the seed of their codes, by which no two words of a language meet."""
    seed = 42
    while True:
        counted = texts.mapInArrow(partial(count_words, seed=seed), "lang string, code long, word binary, n long")
        words = counted.groupBy("lang", "code").agg(F.sum("n").alias("n"), F.min("word").alias("word"), F.max("word").alias("other"))
        words = reliable_checkpoint(words)
        if words.where("word <> other").isEmpty():
            return words.drop("other"), seed
        seed += 1


def bit_chunks(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    mine = np.zeros(bits // 8, np.uint8)
    for b in batches:
        langs = np.array([lang_code(x) for x in b["lang"].to_pylist()], np.uint64)
        codes = b["codes"].flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        width = len(codes) // max(1, len(langs))
        columns = [codes[j::width] for j in range(width)]
        acc = langs
        for c in columns:
            acc = mixed(acc * FACTOR + c)
        at = acc & np.uint64(bits - 1)
        np.bitwise_or.at(mine, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
    chunks = mine.reshape(-1, min(CHUNK, len(mine)))
    used = np.flatnonzero(chunks.any(axis=1))
    yield pa.record_batch([pa.array(used.astype(np.int32)), pa.array([chunks[i].tobytes() for i in used], pa.binary())], ["chunk", "bits"])


def any_of(pdf: pd.DataFrame) -> pd.DataFrame:
    joined = np.bitwise_or.reduce(np.stack([np.frombuffer(b, np.uint8) for b in pdf["bits"]]))
    return pd.DataFrame({"chunk": pdf["chunk"].iloc[:1], "bits": [joined.tobytes()]})


def bitmap_of(frequent: DataFrame) -> bytes:
    """Bitmap of (lang, codes) rows, all of one width; its size is at most ``BITS[1]`` / 8 bytes."""
    bits = min(BITS[1], max(BITS[0], 1 << (16 * frequent.count()).bit_length()))
    parts = frequent.select("lang", "codes").coalesce(16).mapInArrow(partial(bit_chunks, bits=bits), "chunk int, bits binary")
    rows = parts.groupBy("chunk").applyInPandas(any_of, "chunk int, bits binary").collect()
    whole = bytearray(bits // 8)
    for r in rows:
        whole[r["chunk"] * CHUNK : r["chunk"] * CHUNK + len(r["bits"])] = r["bits"]
    return bytes(whole)


class Vocabulary(dict):
    """Local id by word; -1 for nothing, -2 for the end of a piece and for words that are not frequent."""

    def __init__(self, lang: str, words: Bitmap, seed: int) -> None:
        super().__init__({b"": -1, b"\n": -2})
        self.code, self.words, self.seed = lang_code(lang), words, seed
        self.codes = np.zeros(0, np.uint64)

    def ids(self, found: list[bytes]) -> np.ndarray:
        new = list(set(found).difference(self))
        if new:
            codes = np.fromiter((code_of(w, self.seed) for w in new), np.uint64, len(new))
            often = self.words.holds(folded([codes], self.code))
            numbers = np.where(often, len(self.codes) - 1 + np.cumsum(often), -2)
            self.update(zip(new, numbers.tolist()))
            self.codes = np.concatenate([self.codes, codes[often]])
        return np.array(list(map(self.__getitem__, found)), np.int64)


class Container:
    """Hash container of packed word ids with counts; bursts into containers by next word."""

    __slots__ = ("children", "depth", "size", "table")

    def __init__(self, depth: int) -> None:
        self.depth = depth  # words that a key may still have
        self.table: Counter | None = Counter()
        self.children: dict[int, Container] = {}
        self.size = 0

    def add(self, keys: np.ndarray) -> None:
        """Count keys, which must be ascending."""
        if self.table is None:
            self.route(keys)
            return
        self.table.update(keys.tolist())
        self.size = len(self.table)
        if self.size > BURST and self.depth > 1:
            held, counts = self.sorted_arrays()
            self.table = None
            self.route(held, counts)

    def route(self, keys: np.ndarray, counts: np.ndarray | None = None) -> None:
        shift = np.uint64(ID_BITS * (self.depth - 1))
        word = keys >> shift
        cuts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]]) if len(keys) else []
        rest = keys & np.uint64((1 << int(shift)) - 1)
        for a, b in zip(cuts, np.r_[cuts[1:], len(keys)]):
            child = self.children.get(w := int(word[a]))
            if child is None:
                child = self.children[w] = Container(self.depth - 1)
            before = child.size
            if counts is None:
                child.add(rest[a:b])
            else:
                child.table.update(dict(zip(rest[a:b].tolist(), counts[a:b].tolist())))
                child.size = len(child.table)
            self.size += child.size - before
        if counts is not None:
            self.size = len(keys)

    def sorted_arrays(self) -> tuple[np.ndarray, np.ndarray]:
        if self.table is not None:
            keys = np.fromiter(self.table.keys(), np.uint64, len(self.table))
            counts = np.fromiter(self.table.values(), np.int64, len(self.table))
            order = np.argsort(keys)
            return keys[order], counts[order]
        shift = np.uint64(ID_BITS * (self.depth - 1))
        parts = [(w, *self.children[w].sorted_arrays()) for w in sorted(self.children)]
        return np.concatenate([k | (np.uint64(w) << shift) for w, k, _ in parts]), np.concatenate([c for _, _, c in parts])


class Trie:
    """Counts of phrases of one language: first word, then hash containers."""

    def __init__(self, longest: int) -> None:
        self.longest = longest
        self.root: dict[int, Container] = {}
        self.size = 0

    def add(self, first: np.ndarray, rest: np.ndarray) -> None:
        if self.longest == 2:  # both words fit in one number
            both = np.sort(first.astype(np.uint64) << np.uint64(ID_BITS) | rest)
            first, rest = (both >> np.uint64(ID_BITS)).astype(np.int64), both & np.uint64((1 << ID_BITS) - 1)
        else:
            order = np.lexsort((rest, first))
            first, rest = first[order], rest[order]
        cuts = np.flatnonzero(np.r_[True, first[1:] != first[:-1]]) if len(first) else []
        for a, b in zip(cuts, np.r_[cuts[1:], len(first)]):
            child = self.root.get(w := int(first[a]))
            if child is None:
                child = self.root[w] = Container(self.longest - 1)
            before = child.size
            child.add(rest[a:b])
            self.size += child.size - before

    def spill(self, keep: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """Take out whole subtrees, the largest first, until at most ``keep`` keys stay."""
        out = []
        for w in sorted(self.root, key=lambda w: -self.root[w].size):
            if self.size <= keep:
                break
            subtree = self.root.pop(w)
            self.size -= subtree.size
            out.append((w, *subtree.sorted_arrays()))
        return out


def run_rows(lang: str, spilled: list[tuple[int, np.ndarray, np.ndarray]], vocabulary: Vocabulary, width: int, parts: int) -> Iterator[pa.RecordBatch]:
    """Sorted runs of spilled subtrees, one per prefix partition: word codes by column, counts, numbers of words."""
    if not spilled:
        return
    first = np.repeat(np.array([w for w, _, _ in spilled], np.int64), [len(k) for _, k, _ in spilled])
    keys = np.concatenate([k for _, k, _ in spilled])
    counts = np.concatenate([c for _, _, c in spilled])
    mask = np.uint64((1 << ID_BITS) - 1)
    ids = [first, *(((keys >> np.uint64(ID_BITS * j)) & mask).astype(np.int64) - 1 for j in reversed(range(width - 1)))]
    codes = vocabulary.codes
    by_code = np.argsort(codes)
    rank = np.zeros(len(codes) + 1, np.int64)  # the last is for no word
    rank[by_code] = np.arange(1, len(codes) + 1)
    ranks = [rank[i] for i in ids]
    part = folded([codes[ids[0]], codes[ids[1]]], vocabulary.code) % np.uint64(parts)
    order = np.lexsort((*reversed(ranks), part))
    part, counts, ranks = part[order], counts[order], [r[order] for r in ranks]
    in_order = np.r_[np.uint64(0), codes[by_code]]
    cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
    for a, b in zip(cuts, np.r_[cuts[1:], len(part)]):
        sizes = np.sum([r[a:b] > 0 for r in ranks], axis=0).astype(np.uint8)
        columns = [in_order[r[a:b]] for r in ranks]
        raw = b"".join(x.tobytes() for x in (*columns, counts[a:b].astype("<u8"), sizes))
        yield pa.record_batch([pa.array([int(part[a])], pa.int32()), pa.array([lang]), pa.array([zstandard.compress(raw, 1)], pa.binary())], ["part", "lang", "run"])


def read_run(blob: bytes, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word codes by column (0 for no word), counts, and numbers of words."""
    raw = zstandard.decompress(blob)
    n = len(raw) // (8 * width + 9)
    columns = np.frombuffer(raw, "<u8", n * width).reshape(width, n)
    return columns, np.frombuffer(raw, "<u8", n, 8 * n * width), np.frombuffer(raw, np.uint8, n, 8 * n * (width + 1))


def merged_runs(pdf: pd.DataFrame, width: int, least: int) -> pd.DataFrame:
    """Frequent phrases of a prefix partition."""
    langs, codes, totals = [], [], []
    for lang, group in pdf.groupby("lang"):
        runs = [read_run(b, width) for b in group["run"]]
        columns, counts, sizes = (np.concatenate(x, axis=-1) for x in zip(*runs))
        del runs
        # the runs are sorted, and a stable sort merges them; phrases of a beginning are told apart by their size
        order = np.lexsort((sizes, *reversed(columns)))
        columns, counts, sizes = columns[:, order], counts[order].astype(np.int64), sizes[order]
        new = np.r_[True, (columns[:, 1:] != columns[:, :-1]).any(axis=0) | (sizes[1:] != sizes[:-1])]
        first = np.flatnonzero(new)
        sums = np.add.reduceat(counts, first)
        for at, n in zip(first[sums >= least], sums[sums >= least]):
            langs.append(lang)
            codes.append(columns[: sizes[at], at].view(np.int64).tolist())
            totals.append(int(n))
    return pd.DataFrame({"lang": pd.Series(langs, dtype=object), "codes": pd.Series(codes, dtype=object), "n": pd.Series(totals, dtype="int64")})


class Counting:
    """Counts the phrases of a task's texts; hands out sorted runs."""

    def __init__(self, sizes: tuple[int, ...], seed: int, words: bytes, pairs: bytes | None, parts: int) -> None:
        self.sizes, self.width, self.seed, self.parts = sizes, max(sizes), seed, parts
        self.words, self.pairs = Bitmap(words), Bitmap(pairs) if pairs else None
        self.vocabularies: dict[str, Vocabulary] = {}
        self.tries: dict[str, Trie] = {}
        self.waiting: dict[str, list[list[bytes]]] = {}
        self.n_waiting = 0

    def add(self, lang: str, raw: bytes) -> Iterator[pa.RecordBatch]:
        for piece in slices(raw):
            found = marked_words(piece)
            self.waiting.setdefault(lang, []).append(found)
            self.n_waiting += len(found)
            if self.n_waiting > BATCH:
                yield from self.flush()
        # as many ends as a phrase has words, so that no phrase is cut off by ``insert``
        self.waiting.setdefault(lang, []).append([b"\n"] * (self.width - 1))

    def insert(self, lang: str) -> None:
        """Count the phrases that start before the last few waiting words, which stay."""
        words = [w for x in self.waiting.pop(lang) for w in x if w]
        self.waiting[lang] = [words[-(self.width - 1) :]]
        if lang not in self.vocabularies:
            self.vocabularies[lang] = Vocabulary(lang, self.words, self.seed)
        vocabulary = self.vocabularies[lang]
        ids = vocabulary.ids(words)
        n = len(ids) - self.width + 1
        if n <= 0:
            return
        linked = (ids[:-1] >= 0) & (ids[1:] >= 0)
        if self.pairs:
            at = np.flatnonzero(linked)
            linked[at] = self.pairs.holds(folded([vocabulary.codes[ids[at]], vocabulary.codes[ids[at + 1]]], vocabulary.code))
        for size in self.sizes:
            good = linked[:n].copy()
            for j in range(1, size - 1):
                good &= linked[j : n + j]
            at = np.flatnonzero(good)
            rest = np.zeros(len(at), np.uint64)
            for j in range(1, self.width):
                rest <<= np.uint64(ID_BITS)
                if j < size:
                    rest |= (ids[at + j] + 1).astype(np.uint64)
            self.tries.setdefault(lang, Trie(self.width)).add(ids[at], rest)

    def flush(self) -> Iterator[pa.RecordBatch]:
        for lang in list(self.waiting):
            self.insert(lang)
        self.n_waiting = 0
        if sum(t.size for t in self.tries.values()) > HELD:
            yield from self.spill(HELD // 2 // len(self.tries))
        if sum(map(len, self.vocabularies.values())) > WORDS:
            yield from self.spill(0)
            self.vocabularies, self.tries = {}, {}

    def spill(self, keep: int) -> Iterator[pa.RecordBatch]:
        for lang, trie in self.tries.items():
            yield from run_rows(lang, trie.spill(keep), self.vocabularies[lang], self.width, self.parts)

    def close(self) -> Iterator[pa.RecordBatch]:
        for lang in list(self.waiting):
            self.insert(lang)
        yield from self.spill(0)


def count_phrases(batches: Iterator[pa.RecordBatch], **how: object) -> Iterator[pa.RecordBatch]:
    counting = Counting(**how)
    for b in batches:
        for lang, raw in zip(b["lang"].to_pylist(), b["text"]):
            yield from counting.add(lang, raw.as_py())
    yield from counting.close()


def phrase_table(texts: DataFrame, sizes: tuple[int, ...], least: int, **how: object) -> DataFrame:
    """Frequent phrases of these sizes: lang, codes, n."""
    runs = texts.mapInArrow(partial(count_phrases, sizes=sizes, **how), "part int, lang string, run binary")

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        return merged_runs(pdf, max(sizes), least)

    return reliable_checkpoint(runs.groupBy("part").applyInPandas(merge, "lang string, codes array<long>, n long"))


def counts(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """All words (lang, code, word, n), and all phrases of 1 to 4 words that occur ``least`` times (lang, codes, n)."""
    texts = texts_of(docs)
    spark = docs.sparkSession
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(shuffle_width(spark), -(-size // PART_BYTES))
    words, seed = word_table(texts)
    singles = words.where(F.col("n") >= least).select("lang", F.array("code").alias("codes"), "n")
    word_bits = bitmap_of(singles)
    pairs = phrase_table(texts, (2,), least, seed=seed, words=word_bits, pairs=None, parts=parts)
    longer = phrase_table(texts, tuple(range(3, LONGEST + 1)), least, seed=seed, words=word_bits, pairs=bitmap_of(pairs), parts=parts)
    return words, singles.unionByName(pairs).unionByName(longer)


def scored(phrases: DataFrame) -> DataFrame:
    """Candidates (lang, codes, a, l, r, score) that aren't mostly part of a longer one."""
    longer = phrases.where(F.size("codes") >= 2).withColumnRenamed("n", "a")
    cut = longer.select("lang", "codes", "a", F.explode(F.expr("sequence(1, size(codes) - 1)")).alias("k"))
    side = cut.select(
        "lang", "codes", "a", "k", F.explode(F.expr("array(named_struct('left', 1, 'part', slice(codes, 1, k)), named_struct('left', 0, 'part', slice(codes, k + 1, size(codes) - k)))")).alias("s")
    ).select("lang", "codes", "a", "k", "s.*")
    of_part = phrases.select("lang", F.col("codes").alias("part"), F.col("n").alias("f"))
    both = (
        side.join(of_part, ["lang", "part"])
        .groupBy("lang", "codes", "a", "k")
        .agg(F.max(F.when(F.col("left") == 1, F.col("f"))).alias("l"), F.max(F.when(F.col("left") == 0, F.col("f"))).alias("r"))
        .withColumn("score", F.expr("cast((cast(2000000 as decimal(20,0)) * cast(a as decimal(18,0))) div (cast(l as decimal(18,0)) + cast(r as decimal(18,0))) as long)"))
    )
    weakest = both.groupBy("lang", "codes", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("m")).select("lang", "codes", "a", "m.l", "m.r", "m.score")
    inner = (
        longer.where(F.size("codes") >= 3)
        .select("lang", "a", F.explode(F.expr("flatten(transform(sequence(2, size(codes) - 1), m -> transform(sequence(1, size(codes) - m + 1), i -> slice(codes, i, m))))")).alias("codes"))
        .groupBy("lang", "codes")
        .agg(F.max("a").alias("outer"))
    )
    return weakest.join(inner, ["lang", "codes"], "left").where("outer is null or 100 * outer < 80 * a").drop("outer")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    words, phrases = counts(docs, least)
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc())
    # ties stay until their words are known
    first = reliable_checkpoint(scored(phrases).withColumn("rank", F.rank().over(best)).where(F.col("rank") <= top).drop("rank"))
    spelled = (
        first.select("*", F.posexplode("codes").alias("at", "code"))
        .join(words.select("lang", "code", F.col("word").cast("string").alias("word")), ["lang", "code"])
        .groupBy("lang", "codes", "a", "l", "r", "score")
        .agg(F.expr("array_join(transform(array_sort(collect_list(struct(at, word))), x -> x.word), ' ')").alias("phrase"))
    )
    total = words.groupBy("lang").agg(F.sum("n").alias("n"))
    ranked = spelled.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")))
    return ranked.where(F.col("rank") <= top).join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


#: The same in SQL, for the query's table and limits.
SQL = f"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents WHERE text IS NOT NULL
), pieces AS (
  SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM texts
), lists AS (
  SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
), starts AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM lists
), grams AS (
  SELECT lang, list_slice(w, i, i + m - 1) AS g FROM starts, range(1, {LONGEST + 1}) AS sizes(m) WHERE i + m - 1 <= len(w)
), f AS (
  SELECT lang, g, count(*) AS n FROM grams GROUP BY ALL
), totals AS (
  SELECT lang, sum(n)::BIGINT AS n FROM f WHERE len(g) = 1 GROUP BY ALL
), often AS (
  SELECT lang, g, n AS a FROM f WHERE len(g) >= 2 AND n >= {LEAST}
), cuts AS (
  SELECT lang, g, a, unnest(range(1, len(g))) AS k FROM often
), both_parts AS (
  SELECT c.lang, c.g, c.a, c.k, x.n AS l, y.n AS r, (2000000::HUGEINT * c.a) // (x.n + y.n) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.g = list_slice(c.g, 1, c.k) JOIN f y ON y.lang = c.lang AND y.g = list_slice(c.g, c.k + 1, len(c.g))
), weakest AS (
  SELECT * FROM both_parts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1
), subs AS (
  SELECT lang, list_slice(g, i, i + m - 1) AS g, max(a) AS outside FROM often, range(2, {LONGEST}) AS sizes(m), range(1, {LONGEST}) AS places(i)
  WHERE m < len(g) AND i + m - 1 <= len(g) GROUP BY ALL
), kept AS (
  SELECT w.* FROM weakest w LEFT JOIN subs s ON s.lang = w.lang AND s.g = w.g WHERE s.outside IS NULL OR 100 * s.outside < 80 * w.a
), ranked AS (
  SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score::BIGINT AS score,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank FROM kept
)
SELECT k.lang, k.rank::INTEGER AS rank, k.phrase, k.a, k.l, k.r, t.n, k.score FROM ranked k JOIN totals t ON t.lang = k.lang WHERE k.rank <= {TOP}
"""
