"""Toxicity scores: boosted trees over dense features of a text, calibrated by isotonic regression.

Features are densities of a lexicon that is learned from labelled documents (plain words
and words with undone obfuscation), hits near a second-person pronoun, and rates of capitals,
punctuation, digits, repeated characters and obfuscated words. Language, source, id and labels
are never features. Every whole text is scored, where it lies; nothing but the model moves.

Learning uses at most ``SAMPLE`` labelled rows, those with the smallest hash of their id: the
lexicon's document counts are made by Spark, the trees are fitted on the rows' features.

Results of the awkward cases: a null text is the empty text and gets a score like any other;
null labels are left out, and of several labels of an id the largest counts; rows of a
repeated id are scored one by one; with no label, or only one kind, every score is the share
of toxic labels (0 if there are none); an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import id_fold, mixed, texts
from cohortlens.session import reliable_checkpoint

SAMPLE = 20_000
LEXICON = 800
LEAST_DOCUMENTS = 4
#: Least log-likelihood ratio of a lexicon entry.
LEAST_RATIO = 16.0
#: Lengths, in bytes, of the word beginnings that the lexicon knows as stems.
STEMS = (4, 5, 6)
NEAR = 6
#: Words that open the lexicon where labels are few.
SEED_WORDS = ("idiot", "idiots", "moron", "stupid", "imbecile", "scum", "loser", "losers", "pathetic", "worthless", "disgusting", "trash", "clown", "filth", "garbage", "vermin", "dumb")
SEED_WEIGHT = 2.0
SECOND_PERSON = frozenset(
    w.encode() for w in "you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch sie ihnen tú ti tus usted ustedes vosotros".split()
)
PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())
UNDONE = bytes.maketrans(b"013457@$", b"oieastas")
ODD = re.compile(rb"(?<![A-Za-z0-9@$])[0-9@$]?[A-Za-z]{0,20}[0-9@$*][A-Za-z0-9@$*]{0,20}[A-Za-z]|(?<![A-Za-z0-9])(?:[A-Za-z][.\-_*]){3,20}[A-Za-z]")
SHOUTED = re.compile(rb"(?<![A-Za-z])[A-Z]{3,}(?![a-z])")
NAMES = (
    "log_words",
    "hit_rate",
    "weight_rate",
    "log_hits",
    "distinct_hits",
    "top_weight",
    "hits_near_person",
    "person_rate",
    "capital_share",
    "shouted_rate",
    "punctuation_share",
    "exclamation_share",
    "odd_rate",
    "undone_hits",
    "run_share",
    "digit_share",
)


def plain_words(raw: bytes) -> list[bytes]:
    """Lower-case words without punctuation."""
    return raw.lower().translate(None, PUNCTUATION).split()


def forms(word: bytes) -> list[bytes]:
    """The word and its stems, as the lexicon writes them."""
    return [word, *[word[:k] + b"*" for k in STEMS if len(word) > k]]


def undone(piece: bytes) -> bytes:
    return piece.lower().translate(UNDONE).translate(None, PUNCTUATION)


class Lexicon(dict):
    """Weights by word or stem (ending in ``*``)."""

    def __init__(self, weights: dict[bytes, float]) -> None:
        super().__init__(weights)
        self.heads = frozenset(k.rstrip(b"*")[: STEMS[0]] for k in weights)

    def __reduce__(self) -> tuple:
        return Lexicon, (dict(self),)

    def weight(self, word: bytes) -> float:
        """Largest weight of the word's forms; 0 if none is known."""
        if word[: STEMS[0]] not in self.heads:
            return 0.0
        return max((self[f] for f in forms(word) if f in self), default=0.0)


def features(raw: bytes, lexicon: Lexicon) -> list[float]:
    found = plain_words(raw)
    heads, first = lexicon.heads, STEMS[0]
    n, size = max(1, len(found)), max(1, len(raw))
    bins = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    letters = max(1, int(bins[65:91].sum() + bins[97:123].sum()))
    weighed = [(i, lexicon.weight(w)) for i, w in enumerate(found) if w[:first] in heads]
    hits = [i for i, w in weighed if w > 0]
    weights = [w for _, w in weighed if w > 0]
    near = sum(not SECOND_PERSON.isdisjoint(found[max(0, i - NEAR) : i + NEAR + 1]) for i in hits)
    person = sum(map(SECOND_PERSON.__contains__, found))
    odd = ODD.findall(raw)
    again = [w for w in map(lexicon.weight, map(undone, odd)) if w > 0]
    same = np.frombuffer(raw, np.uint8)
    runs = int(((same[2:] == same[1:-1]) & (same[1:-1] == same[:-2])).sum()) if size > 2 else 0
    return [
        float(np.log1p(len(found))),
        len(hits) / n,
        sum(weights) / n,
        float(np.log1p(len(hits) + len(again))),
        float(len({found[i] for i in hits})),
        max([*weights, *again], default=0.0),
        float(near),
        person / n,
        int(bins[65:91].sum()) / letters,
        len(SHOUTED.findall(raw)) / n,
        int(bins[33:48].sum() + bins[58:65].sum() + bins[91:97].sum() + bins[123:127].sum()) / size,
        int(bins[33] + bins[63]) / size,
        len(odd) / n,
        float(len(again)),
        runs / size,
        int(bins[48:58].sum()) / size,
    ]


@dataclass
class Trees:
    """Additive trees of equal depth for a binary label; splits are indices into ``edges``."""

    edges: np.ndarray  # feature x bin
    split_on: list[np.ndarray]
    split_at: list[np.ndarray]
    leaves: list[np.ndarray]
    start: float

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(self.edges)], 1)

    def margin(self, x: np.ndarray) -> np.ndarray:
        b, out, rows = self.binned(x), np.full(len(x), self.start), np.arange(len(x))
        for on, at, leaf in zip(self.split_on, self.split_at, self.leaves):
            node = np.zeros(len(x), np.int64)
            for _ in range(len(leaf).bit_length() - 1):
                node = 2 * node + 1 + (b[rows, on[node]] > at[node])
            out += leaf[node - len(on)]
        return out


def fit_trees(x: np.ndarray, y: np.ndarray, rounds: int = 120, depth: int = 3, rate: float = 0.1, bins: int = 48, least: float = 1.0) -> Trees:
    """Second-order boosting on binned features; all nodes of a level are split together."""
    shares = np.linspace(0, 1, bins + 1)[1:-1]
    edges = np.stack([np.quantile(x[:, j], shares) for j in range(x.shape[1])])
    prior = float(np.clip(y.mean(), 1e-4, 1 - 1e-4))
    model = Trees(edges, [], [], [], float(np.log(prior / (1 - prior))))
    b = model.binned(x)
    margin = np.full(len(x), model.start)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        node, on, at = np.zeros(len(x), np.int64), [], []
        for level in range(depth):
            n = 1 << level
            gain, cut = np.full((x.shape[1], n), -1.0), np.zeros((x.shape[1], n), np.int64)
            for j in range(x.shape[1]):
                cell = node * bins + b[:, j]
                gl = np.cumsum(np.bincount(cell, g, n * bins).reshape(n, bins), 1)
                hl = np.cumsum(np.bincount(cell, h, n * bins).reshape(n, bins), 1)
                gr, hr = gl[:, -1:] - gl, hl[:, -1:] - hl
                won = gl**2 / (hl + 1) + gr**2 / (hr + 1) - gl[:, -1:] ** 2 / (hl[:, -1:] + 1)
                won[(hl < least) | (hr < least)] = -1
                cut[j] = won.argmax(1)
                gain[j] = won.max(1)
            best = gain.argmax(0)
            where = cut[best, np.arange(n)]
            where = np.where(gain.max(0) > 1e-9, where, bins)  # no gain: all go left
            on.append(best)
            at.append(where)
            node = 2 * node + (b[np.arange(len(x)), best[node]] > where[node])
        n = 1 << depth
        leaf = rate * np.bincount(node, g, n) / (np.bincount(node, h, n) + 1)
        model.split_on.append(np.concatenate(on))
        model.split_at.append(np.concatenate(at))
        model.leaves.append(leaf)
        margin += leaf[node]
    return model


def isotonic(score: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators; returns the pools' mean score and mean label."""
    order = np.argsort(score, kind="stable")
    pools: list[list[float]] = []
    for s, y in zip(score[order], label[order]):
        pools.append([s, y, 1.0])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    sums = np.array(pools)
    return sums[:, 0] / sums[:, 2], sums[:, 1] / sums[:, 2]


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    trees: Trees | None
    at: np.ndarray
    share: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None or not len(x):
            return np.full(len(x), float(self.share[0]))
        margin = self.trees.margin(x)
        # a thousandth of the raw probability orders texts within a pool
        raw = 1 / (1 + np.exp(-margin))
        return np.clip(0.999 * np.interp(margin, self.at, self.share) + 0.001 * raw, 0.0, 1.0)


def learned_lexicon(sample: DataFrame, toxic: int, clean: int) -> Lexicon:
    """Words and stems that are much more frequent in toxic documents, with their log odds."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by: tuple[Counter, Counter] = (Counter(), Counter())
            for raw, y in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                by[y].update({f for w in set(plain_words(raw)) for f in forms(w)})
            names = list(by[0].keys() | by[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.binary()), pa.array([by[1][w] for w in names], pa.int64()), pa.array([by[0][w] for w in names], pa.int64())],
                ["word", "t", "c"],
            )

    counted = sample.mapInArrow(count, "word binary, t long, c long").groupBy("word").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    t, c, n = F.col("t"), F.col("c"), toxic + clean
    odds = F.log((t + 0.5) / (toxic + 1)) - F.log((c + 0.5) / (clean + 1))
    seen = t + c
    ratio = 2 * (t * F.log(t * n / (seen * toxic)) + F.when(c > 0, c * F.log(c * n / (seen * clean))).otherwise(0))
    scored = counted.where(t >= LEAST_DOCUMENTS).select("word", odds.alias("w"), ratio.alias("ratio"))
    found = scored.where((F.col("w") > 1) & (F.col("ratio") >= LEAST_RATIO)).orderBy(F.desc("ratio"), "word").limit(LEXICON).collect()
    return Lexicon({w.encode(): SEED_WEIGHT for w in SEED_WORDS} | {bytes(r["word"]): float(r["w"]) for r in found})


def learn(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Fit on labelled rows outside the held-out fold."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & (id_fold(F.col("doc_id")) != 0))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    # at most SAMPLE rows of two numbers
    sample = reliable_checkpoint(texts(docs).join(F.broadcast(picked), "doc_id"))
    counts = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = counts.get(1, 0), counts.get(0, 0)
    if not toxic or not clean:
        share = toxic / max(1, toxic + clean)
        return ToxicityModel(Lexicon({}), None, np.zeros(1), np.array([share]))
    lexicon = learned_lexicon(sample, toxic, clean)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(raw, lexicon) for raw in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic"), pa.array(rows, pa.list_(pa.float64()))], ["doc_id", "toxic", "x"]
            )

    rows = sample.mapInArrow(measure, "doc_id long, toxic int, x array<double>").collect()
    rows.sort(key=lambda r: (r["doc_id"], list(r["x"])))
    x = np.array([r["x"] for r in rows])
    y = np.array([r["toxic"] for r in rows], float)
    fold = (mixed(np.array([r["doc_id"] for r in rows]).astype(np.uint64)) % np.uint64(4)).astype(int)
    margin = np.zeros(len(y))
    for f in range(4):
        out = fold == f
        if out.any() and 0 < y[~out].sum() < (~out).sum():
            margin[out] = fit_trees(x[~out], y[~out]).margin(x[out])
    return ToxicityModel(lexicon, fit_trees(x, y), *isotonic(margin, y))


def score_texts(rows: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id`` and ``score`` of every row of ``texts``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(raw, model.lexicon) for raw in batch.column("text").to_pylist()]).reshape(-1, len(NAMES))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(x))], ["doc_id", "score"])

    return rows.mapInArrow(run, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score and prediction of every document."""
    scored = score_texts(texts(docs), learn(docs, labels))
    return scored.select(
        "doc_id",
        (id_fold(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that aren't predicted toxic, with all their columns."""
    model = learn(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raws = [(t or "").encode() if isinstance(t, str) or t is None else t for t in batch.column("text").to_pylist()]
            x = np.array([features(raw, model.lexicon) for raw in raws]).reshape(-1, len(NAMES))
            yield batch.filter(pa.array(model.score(x) < 0.5))

    return docs.mapInArrow(run, docs.schema)
