"""Scores of documents under a causal self-attention model over subword ids.

The attention model reads the subword ids of a text in windows and predicts each next id: the class
of the id by a softmax, and the id in its class by its share of the training ids. Frequent ids are
classes of their own, the others share ``SHARED_CLASSES``; as inputs, ids beyond the first ``INPUTS``
share some numbers.

    p(id | before) = p(class | ids before) * (c + 1/2) / (C + S / 2)

with c and C the id's and the class's training counts and S the class's number of ids. A word's
probability is the product over its ids; ``MIX`` of it comes from the plain word frequencies, so that
a surprising word can't ruin a text. The end of a text is a class by itself. A word without ids has
only the plain share.

Everything that is counted covers all training documents; counts of words meet per word hash and
return only to the homes (buckets of documents, cut by bytes of text) that have the word. Every window
of every training document trains the network once: windows are dealt to ``ROUNDS`` turns by hash of
id, text and place; in a turn the homes train from common weights where their windows lie, and the
weights, a fixed number, are averaged by Spark. Homes, orders and seeds come from the data alone, so
scores don't depend on the number of partitions.

Scoring uses overlapping windows: each token is scored once, with ``OVERLAP`` tokens of context
before it at least (fewer only at the start of a text). Windows are scored in batches with one
causal mask.

Results of the awkward cases: a null text is empty and has its end as its one token; documents
whose id is null count as fold 0; rows of a repeated id are scored one by one (and learned from
as often); without training documents every token has probability 1 in the base and the class model
is uniform; a very long text is many windows of one home; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import WordHashes, id_fold, mixed, parts_for, text_bytes, texts, words
from cohortlens.llm.tokenfile import Encoder
from cohortlens.session import reliable_checkpoint

WINDOW = 32
OVERLAP = 4
ROUNDS = 3
BATCH = 128
DIM = 16
CLASSES = 64
SHARED_CLASSES = 16
INPUTS = 2048
#: Input numbers that the ids beyond the own ones share.
SHARED_INPUTS = 61
#: Bytes of text in a home, and bytes of the corpus for a bucket of words.
HOME_BYTES = 4 << 20
BUCKET_BYTES = 16 << 20
MIX = 0.02
LEARNING_RATE = 1e-2
SLICES = 8
#: Texts whose windows are scored together.
AT_ONCE = 500
PAD, START, END = 65535, 65534, 65533


def stored(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return zstandard.compress(out.getvalue(), 1)


def loaded(blob: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(zstandard.decompress(blob))) as found:
        return {k: found[k] for k in found.files}


# ---- the network


def new_weights(class_share: np.ndarray, seed: int = 3) -> dict[str, np.ndarray]:
    """Small random weights; at the start the prediction is the classes' share."""
    rng = np.random.default_rng(seed)

    def some(*shape: int, scale: float) -> np.ndarray:
        return rng.normal(0, scale, shape).astype(np.float32)

    return {
        "embed": some(INPUTS, DIM, scale=0.3),
        "place": some(WINDOW, DIM, scale=0.05),
        "qkv": some(DIM, 3 * DIM, scale=DIM**-0.5),
        "out": some(DIM, DIM, scale=0.3 * DIM**-0.5),
        "head": some(DIM, CLASSES, scale=0.02),
        "bias": np.log(np.maximum(class_share, 1e-9)).astype(np.float32),
    }


SEEN = np.tril(np.ones((WINDOW, WINDOW), np.float32))
#: Numbers of at most this size are raised without taking a row's largest off first.
CALM = 40.0


def calm(x: np.ndarray) -> bool:
    return bool(-CALM <= x.min(initial=0) and x.max(initial=0) <= CALM)


def attended(w: dict[str, np.ndarray], inputs: np.ndarray) -> dict[str, np.ndarray]:
    """The network up to its last layer (``h``), and what the gradient needs."""
    b, t = inputs.shape
    x = np.take(w["embed"], inputs, axis=0)
    x += w["place"][:t]
    qkv = (x.reshape(-1, DIM) @ w["qkv"]).reshape(b, t, 3 * DIM)
    q, k, v = qkv[..., :DIM], qkv[..., DIM : 2 * DIM], qkv[..., 2 * DIM :]
    q *= np.float32(DIM**-0.5)
    a = q @ k.transpose(0, 2, 1)
    if not calm(a):
        a[:, SEEN[:t, :t] == 0] = -np.inf
        a -= a.max(-1, keepdims=True)
    np.exp(a, out=a)
    a *= SEEN[:t, :t]
    a /= (a.reshape(-1, t) @ np.ones(t, a.dtype)).reshape(b, t, 1)
    c = a @ v
    h = (c.reshape(-1, DIM) @ w["out"]).reshape(b, t, DIM)
    h += x
    return {"x": x, "q": q, "k": k, "v": v, "a": a, "c": c, "h": h}


def class_odds(w: dict[str, np.ndarray], h: np.ndarray, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log probability of each place's target class; the classes' odds and their sums. Places are rows."""
    z = h.reshape(-1, DIM) @ w["head"]
    z += w["bias"]
    if not calm(z):
        z -= z.max(-1, keepdims=True)
    got = z.ravel()[np.arange(0, z.size, CLASSES) + targets.ravel()]
    np.exp(z, out=z)
    total = z @ np.ones(CLASSES, z.dtype)
    return got - np.log(total), z, total


def forward(w: dict[str, np.ndarray], inputs: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Log probabilities of the next class at every place, and what the gradient needs."""
    s = attended(w, inputs)
    z = s["h"] @ w["head"] + w["bias"]
    z -= z.max(-1, keepdims=True)
    z -= np.log(np.exp(z).sum(-1, keepdims=True))
    return z, s


def gradient(w: dict[str, np.ndarray], inputs: np.ndarray, targets: np.ndarray, scored: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean loss over the scored places and its gradient."""
    s = attended(w, inputs)
    n = max(1, int(scored.sum()))
    b, t = inputs.shape

    def flat(y: np.ndarray) -> np.ndarray:
        return y.reshape(-1, y.shape[-1])

    got, dz, total = class_odds(w, s["h"], targets)
    each = scored.ravel() / np.float32(n)
    loss = -float(got @ each)
    dz *= (each / total)[:, None]
    dz.ravel()[np.arange(0, dz.size, CLASSES) + targets.ravel()] -= each
    g = {"head": flat(s["h"]).T @ dz, "bias": np.ones(len(dz), dz.dtype) @ dz}
    dh = dz @ w["head"].T
    g["out"] = flat(s["c"]).T @ dh
    dc = (dh @ w["out"].T).reshape(b, t, DIM)
    da = dc @ s["v"].transpose(0, 2, 1)
    # the attention's weighted mean of da is what dc and c give together
    da -= ((dc * s["c"]).reshape(-1, DIM) @ np.ones(DIM, dc.dtype)).reshape(b, t, 1)
    da *= s["a"]
    dqkv = np.empty((b, t, 3 * DIM), da.dtype)
    np.matmul(da, s["k"], out=dqkv[..., :DIM])
    dqkv[..., :DIM] *= np.float32(DIM**-0.5)
    np.matmul(da.transpose(0, 2, 1), s["q"], out=dqkv[..., DIM : 2 * DIM])
    np.matmul(s["a"].transpose(0, 2, 1), dc, out=dqkv[..., 2 * DIM :])
    g["qkv"] = flat(s["x"]).T @ flat(dqkv)
    dx = dh
    dx += flat(dqkv) @ w["qkv"].T
    g["place"] = np.zeros_like(w["place"])
    g["place"][:t] = dx.reshape(b, t, DIM).sum(0)
    g["embed"] = np.zeros_like(w["embed"])
    order = np.argsort(inputs.ravel(), kind="stable")
    number = inputs.ravel()[order]
    first = np.flatnonzero(np.r_[True, number[1:] != number[:-1]])
    g["embed"][number[first]] = np.add.reduceat(dx[order], first, axis=0)
    return loss, g


def trained(w: dict[str, np.ndarray], inputs: np.ndarray, targets: np.ndarray, scored: np.ndarray, rate: float, seed: int) -> dict[str, np.ndarray]:
    """One pass of Adam steps over the windows, in seeded order."""
    w = {k: v.copy() for k, v in w.items()}
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    order, step = np.random.default_rng(seed).permutation(len(inputs)), 0
    for at in range(0, len(order), BATCH):
        rows = order[at : at + BATCH]
        _, g = gradient(w, inputs[rows], targets[rows], scored[rows])
        step += 1
        for k in w:
            first[k] += np.float32(0.1) * (g[k] - first[k])
            second[k] += np.float32(0.01) * (g[k] * g[k] - second[k])
            w[k] -= np.float32(rate / (1 - 0.9**step)) * first[k] / (np.sqrt(second[k] / np.float32(1 - 0.99**step)) + np.float32(1e-7))
    return w


class Vocabulary:
    """Class and input number of every subword id, from the ids' training counts."""

    def __init__(self, count: np.ndarray, documents: int) -> None:
        order = np.lexsort((np.arange(len(count)), -count))
        own = CLASSES - 1 - SHARED_CLASSES
        rank = np.empty(len(count), np.int64)
        rank[order] = np.arange(len(count))
        self.class_of = np.zeros(1 << 16, np.int16)  # class 0 is the end
        self.class_of[: len(count)] = np.where(rank < own, 1 + rank, 1 + own + (rank - own) % SHARED_CLASSES)
        self.input_of = np.zeros(1 << 16, np.int16)
        told = INPUTS - 3 - SHARED_INPUTS
        self.input_of[: len(count)] = np.where(rank < told, 3 + rank, 3 + told + (rank - told) % SHARED_INPUTS)
        self.input_of[[PAD, START, END]] = 0, 1, 2
        of = self.class_of[: len(count)]
        self.total = np.bincount(of, count, CLASSES)
        self.total[0] = documents
        size = np.bincount(of, minlength=CLASSES)
        # log probability of an id within its class; the end is the only token of its class
        self.within = np.zeros(1 << 16)
        self.within[: len(count)] = np.log(count + 0.5) - np.log(self.total + 0.5 * size)[of]

    def shares(self) -> np.ndarray:
        return (self.total + 0.5) / (self.total + 0.5).sum()


# ---- the passes over the corpus


def located(docs: DataFrame) -> DataFrame:
    rows = texts(docs).withColumn("fold", id_fold(F.col("doc_id")).cast("int")).withColumn("version", F.xxhash64("text"))
    homes = max(1, -(-text_bytes(docs) // HOME_BYTES))
    return rows.withColumn("home", F.pmod(F.xxhash64("doc_id", "version"), F.lit(homes)).cast("int"))


def in_order(docs: pd.DataFrame) -> pd.DataFrame:
    """A home's rows in an order of their own, however they came."""
    return docs.sort_values(["doc_id", "version"], kind="stable", ignore_index=True, na_position="first")


def read_home(docs: pd.DataFrame) -> tuple[list[np.ndarray], np.ndarray, list[bytes]]:
    """Each text's word numbers, and hash and bytes of the home's distinct words."""
    hashes, seen, spelled, numbers = WordHashes(), {}, [], []
    for raw in docs["text"]:
        found = words(bytes(raw))
        new = sorted(set(found).difference(seen))
        for w in new:
            seen[w] = len(spelled)
            spelled.append(w)
        numbers.append(np.fromiter(map(seen.__getitem__, found), np.int32, len(found)))
    codes = np.fromiter(map(hashes.__missing__, spelled), np.uint64, len(spelled)) if spelled else np.zeros(0, np.uint64)
    return numbers, codes, spelled


@dataclass
class Subwords:
    """Subword ids of distinct words: ``ids[cuts[i]:cuts[i + 1]]``."""

    ids: np.ndarray
    cuts: np.ndarray

    @staticmethod
    def of(spelled: list[bytes], encoder: Encoder) -> Subwords:
        raw = encoder.encode_words(spelled)
        kind = np.dtype(encoder.kind)
        cuts = np.cumsum([0, *(len(x) // kind.itemsize for x in raw)])
        return Subwords(np.frombuffer(b"".join(raw), kind).astype(np.uint16), cuts)

    def spread(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a text's words in order, and how many each word has."""
        n = self.cuts[numbers + 1] - self.cuts[numbers]
        at = np.arange(int(n.sum())) + np.repeat(self.cuts[numbers] - (np.cumsum(n) - n), n)
        return self.ids[at], n


def windows_of(ids: np.ndarray) -> np.ndarray:
    """All windows of a text: the id before, then up to ``WINDOW`` tokens."""
    tokens = np.concatenate([np.array([START], np.uint16), ids, np.array([END], np.uint16)])
    n = -(-(len(tokens) - 1) // WINDOW)
    padded = np.full(n * WINDOW + 1, PAD, np.uint16)
    padded[: len(tokens)] = tokens
    return np.concatenate([padded[:-1].reshape(n, WINDOW), padded[WINDOW::WINDOW, None]], axis=1)


def turns_of(name: int, n: int) -> np.ndarray:
    """The turn in which each window of a text trains."""
    return mixed(np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(name & ((1 << 64) - 1))) % np.uint64(ROUNDS)


def count_home(docs: pd.DataFrame, tokenizer: str, buckets: int) -> pd.DataFrame:
    """A home's distinct words by bucket (``kind`` 0), its reading (1), totals (2) and id counts (3).

    The reading is what training and scoring need of the texts: the documents, their words as places in
    the order of the words' hashes, and the subword ids of each word. Texts are read once.
    """
    docs = in_order(docs)
    home = int(docs["home"].iloc[0])
    numbers, codes, spelled = read_home(docs)
    subwords = Subwords.of(spelled, shared_encoder(tokenizer))
    train = docs["fold"].to_numpy() != 1
    learned = [n for n, t in zip(numbers, train) if t]
    counts = np.bincount(np.concatenate(learned), minlength=len(codes)) if learned else np.zeros(len(codes), np.int64)
    where = (((codes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(codes, kind="stable")  # a bucket is a range of hashes
    cuts = np.searchsorted(where[order], np.arange(buckets + 1))
    out = []
    for b in np.flatnonzero(np.diff(cuts)):
        i = order[cuts[b] : cuts[b + 1]]
        steps = np.diff(codes[i], prepend=np.uint64(0))
        out.append((0, int(b), home, stored(steps=steps, count=counts[i].astype(np.uint32))))
    place = np.empty(len(order), np.uint32)
    place[order] = np.arange(len(order), dtype=np.uint32)
    ids, sizes = subwords.spread(order)
    ends = np.cumsum([len(n) for n in numbers])
    known = docs["doc_id"].notna().to_numpy()
    reading = stored(
        doc_id=docs["doc_id"].fillna(0).to_numpy(np.int64), known=known, held=~train, version=docs["version"].to_numpy(np.int64),
        ends=ends, words=place[np.concatenate(numbers)], ids=ids, sizes=sizes.astype(np.uint32),
    )
    out.append((1, None, home, reading))
    out.append((2, None, home, stored(totals=np.array([int(counts.sum()) + int(train.sum()), int(train.sum())], np.int64))))
    each = np.bincount(subwords.ids, np.repeat(counts, np.diff(subwords.cuts)), 1 << 16).astype(np.int64)
    used = np.flatnonzero(each)
    out.append((3, None, home, stored(id=used, count=each[used])))
    return pd.DataFrame(out, columns=["kind", "bucket", "home", "body"]).astype({"bucket": "Int32"})


def subwords_of(reading: dict[str, np.ndarray]) -> Subwords:
    return Subwords(reading["ids"], np.concatenate([np.zeros(1, np.int64), np.cumsum(reading["sizes"], dtype=np.int64)]))


def turn_windows(reading: dict[str, np.ndarray], turn: int) -> np.ndarray:
    """The windows of a home's training documents that train in a turn."""
    subwords, out = subwords_of(reading), [np.zeros((0, WINDOW + 1), np.uint16)]
    for begin, end, held, name in zip(np.r_[0, reading["ends"]], reading["ends"], reading["held"], reading["version"]):
        if not held:
            windows = windows_of(subwords.spread(reading["words"][begin:end])[0])
            out.append(windows[turns_of(int(name), len(windows)) == turn])
    return np.concatenate(out)


def add_up(pdf: pd.DataFrame) -> pd.DataFrame:
    """Counts of a bucket's words over all homes: back to each home, and the bucket's sums (home -1)."""
    parts = [loaded(b) for b in pdf["body"]]
    codes = np.concatenate([np.cumsum(p["steps"], dtype=np.uint64) for p in parts])
    count = np.concatenate([p["count"] for p in parts]).astype(np.int64)
    order = np.argsort(codes, kind="stable")
    first = np.flatnonzero(np.r_[True, codes[order][1:] != codes[order][:-1]])
    total = np.add.reduceat(count[order], first)
    back = np.empty(len(codes), np.int64)
    back[order] = np.repeat(total, np.diff(np.r_[first, len(order)]))
    out, at = [(-1, stored(id=np.array([0, 1]), count=np.array([total.sum(), (total > 0).sum()])))], 0
    for home, p in zip(pdf["home"], parts):
        n = len(p["steps"])
        out.append((home, stored(steps=p["steps"], count=back[at : at + n].astype(np.uint64))))
        at += n
    return pd.DataFrame(out, columns=["home", "body"])


def summed(rows: DataFrame, size: int) -> np.ndarray:
    """Sums of (id, count) lists; a number per id at most."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body in batch.column("body").to_pylist():
                p = loaded(body)
                yield pa.RecordBatch.from_arrays([pa.array(p["id"].astype(np.int32)), pa.array(p["count"].astype(np.int64))], ["id", "c"])

    out = np.zeros(size, np.int64)
    for r in rows.select("body").mapInArrow(spread, "id int, c long").groupBy("id").agg(F.sum("c").alias("c")).collect():
        out[r["id"]] = r["c"]
    return out


def fitted(readings: DataFrame, vocabulary: Vocabulary) -> dict[str, np.ndarray]:
    """Turns of local training and averaging; each turn cuts its windows from the readings and moves only weights."""
    w = new_weights(vocabulary.shares())
    shapes = {k: v.shape for k, v in w.items()}

    def flat(x: dict[str, np.ndarray]) -> np.ndarray:
        joined = np.concatenate([x[k].ravel() for k in shapes]).astype(np.float64)
        return np.pad(joined, (0, -len(joined) % SLICES)).reshape(SLICES, -1)

    for turn in range(ROUNDS):
        now, rate = w, LEARNING_RATE * (1 - turn / ROUNDS)

        def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for home, body in zip(batch.column("home").to_pylist(), batch.column("body").to_pylist()):
                    tokens = turn_windows(loaded(body), turn)
                    if not len(tokens):
                        continue
                    inputs, nexts = vocabulary.input_of[tokens[:, :-1]], tokens[:, 1:]
                    scored = (nexts != PAD).astype(np.float32)
                    targets = np.where(nexts == END, 0, vocabulary.class_of[nexts])
                    got = trained(now, inputs, targets, scored, rate, 1000 * turn + home)
                    n = float(len(tokens))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.arange(SLICES, dtype=np.int32)), pa.array([home] * SLICES, pa.int32()), pa.array([n] * SLICES), pa.array([(part * n).tobytes() for part in flat(got)], pa.binary())],
                        ["part", "home", "n", "body"],
                    )

        def mean(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("home")
            total = sum(np.frombuffer(b, np.float64) for b in pdf["body"]) / pdf["n"].sum()
            return pd.DataFrame({"part": pdf["part"].iloc[:1], "body": [total.tobytes()]})

        sent = readings.select("home", "body").mapInArrow(local, "part int, home int, n double, body binary")
        rows = sent.groupBy("part").applyInPandas(mean, "part int, body binary").collect()  # SLICES rows of fixed size
        if not rows:
            continue
        joined = np.concatenate([np.frombuffer(r["body"], np.float64) for r in sorted(rows, key=lambda r: r["part"])])
        w, at = {}, 0
        for k, shape in shapes.items():
            n = int(np.prod(shape))
            w[k] = joined[at : at + n].reshape(shape).astype(np.float32)
            at += n
    return w


def class_scores(w: dict[str, np.ndarray], inputs: list[np.ndarray], targets: list[np.ndarray], batch: int = 256) -> list[np.ndarray]:
    """Natural log probability of every target class, each scored once.

    ``inputs[i]`` are the input numbers before each of ``targets[i]``.
    """
    ends = np.cumsum([len(t) for t in targets])
    if not len(ends) or not ends[-1]:
        return [np.empty(0) for _ in targets]
    return np.split(joined_scores(w, np.concatenate(inputs), np.concatenate(targets), ends, batch), ends[:-1])


def joined_scores(w: dict[str, np.ndarray], inputs: np.ndarray, targets: np.ndarray, ends: np.ndarray, batch: int = 256) -> np.ndarray:
    """``class_scores`` of texts that lie one behind the other and end at ``ends``."""
    out = np.empty(len(targets))
    sizes, step = np.diff(ends, prepend=0), WINDOW - OVERLAP
    # a text's windows begin ``step`` apart; all but the first leave out the overlap
    count = np.where(sizes > 0, 1 + np.maximum(0, -(-(sizes - WINDOW) // step)), 0)
    number = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    start = np.repeat(ends - sizes, count) + number * step
    length = np.minimum(np.repeat(ends, count) - start, WINDOW)
    skipped = np.where(number > 0, OVERLAP, 0)
    for wide, chosen in ((16, length <= 16), (WINDOW, length > 16)):  # short texts in short windows
        spots = np.flatnonzero(chosen)
        for part in (spots[at : at + batch] for at in range(0, len(spots), batch)):
            place = np.arange(wide)
            at = start[part][:, None] + place
            inside = place < length[part][:, None]
            at[~inside] = 0
            x, y = np.where(inside, inputs[at], 0), np.where(inside, targets[at], 0)
            got = class_odds(w, attended(w, x)["h"], y)[0].reshape(x.shape)
            new = inside & (place >= skipped[part][:, None])
            out[at[new]] = got[new]
    return out


def score_home(
    readings: pd.DataFrame, others: pd.DataFrame, w: dict[str, np.ndarray], vocabulary: Vocabulary, facts: tuple[int, int, int]
) -> pd.DataFrame:
    """Base and model scores of a home's documents."""
    columns = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    if not len(readings):
        return pd.DataFrame([], columns=columns)
    r = loaded(readings["body"].iloc[0])
    n, v, documents = facts
    subwords = subwords_of(r)
    # buckets are ranges of hashes, so one behind the other they list the home's words in order
    buckets = sorted((loaded(body) for body in others["body"]), key=lambda p: p["steps"][0]) if len(others) else []
    count = np.concatenate([np.zeros(0, np.int64), *[p["count"].astype(np.int64) for p in buckets]])
    below = n + 0.5 * (v + 1)
    plain = np.log(count + 0.5) - np.log(below)
    plain_end = np.log((documents + 0.5) / below)
    lengths = np.diff(r["ends"], prepend=0)
    base, score, known = (np.empty(len(lengths)) for _ in range(3))
    for at in range(0, len(lengths), AT_ONCE):
        mine = slice(at, at + AT_ONCE)
        size = lengths[mine]
        texts_end = np.cumsum(size + 1)  # every text has its end behind its words
        word = np.ones(texts_end[-1], bool)
        word[texts_end - 1] = False
        x = r["words"][r["ends"][at] - size[0] : r["ends"][mine][-1]]
        ids, of_word = subwords.spread(x)
        of_token = np.ones(len(word), np.int64)
        of_token[word] = of_word
        token_end = np.cumsum(of_token)
        stop = np.zeros(token_end[-1], bool)
        stop[token_end[texts_end - 1] - 1] = True
        targets, within, inputs = np.zeros(len(stop), np.int16), np.zeros(len(stop)), np.empty(len(stop), np.int16)
        targets[~stop], within[~stop] = vocabulary.class_of[ids], vocabulary.within[ids]
        before = np.r_[True, stop[:-1]]
        inputs[before] = vocabulary.input_of[START]
        inputs[~before] = vocabulary.input_of[ids]
        got = joined_scores(w, inputs, targets, token_end[texts_end - 1]) + within
        upto = np.r_[0.0, np.cumsum(got)]
        model = np.where(of_token > 0, upto[token_end] - upto[token_end - of_token], -np.inf)
        share = np.full(len(word), plain_end)
        share[word] = plain[x]
        mixture = np.logaddexp(np.log(1 - MIX) + model, np.log(MIX) + share)
        seen = np.ones(len(word))
        seen[word] = count[x] > 0
        first = texts_end - size - 1
        base[mine], score[mine] = np.add.reduceat(share, first), np.add.reduceat(mixture, first)
        known[mine] = np.add.reduceat(seen, first) - (documents == 0)
    ids = pd.array(r["doc_id"], "Int64")
    ids[~r["known"]] = pd.NA
    values = (ids, r["held"], lengths + 1, known.astype(np.int64), n, base / np.log(10), score / np.log(10))
    return pd.DataFrame(dict(zip(columns, values)))


def shared_encoder(path: str) -> Encoder:
    from cohortlens.llm.tokenfile import encoder

    return encoder(path)


def scores(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Token counts, base score and model score of every document."""
    rows = located(docs).select("home", "doc_id", "version", "fold", "text")
    buckets = parts_for(docs.sparkSession, text_bytes(docs), BUCKET_BYTES)
    size = shared_encoder(tokenizer).tokenizer.get_vocab_size()
    if size > END:
        raise ValueError("the tokenizer has too many ids")
    counted = rows.groupBy("home").applyInPandas(lambda d: count_home(d, tokenizer, buckets), "kind int, bucket int, home int, body binary")
    counted = reliable_checkpoint(counted)
    of_kind = lambda k: counted.where(F.col("kind") == k)
    reduced = reliable_checkpoint(of_kind(0).select("bucket", "home", "body").groupBy("bucket").applyInPandas(add_up, "home int, body binary"))
    documents = training_documents(counted)
    vocabulary = Vocabulary(summed(of_kind(3), size), documents)
    weights = fitted(of_kind(1), vocabulary)
    # training words with ends; distinct ones with the end
    n, v = summed(reduced.where(F.col("home") < 0), 2).tolist()
    facts = (n + documents, v + (documents > 0), documents)
    known = reduced.where(F.col("home") >= 0).select(F.col("home").alias("_home"), F.col("body").alias("_body")).toDF("home", "body")
    return of_kind(1).select("home", "body").groupBy("home").cogroup(known.groupBy("home")).applyInPandas(
        lambda d, o: score_home(d, o, weights, vocabulary, facts),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )


def training_documents(counted: DataFrame) -> int:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([int(loaded(b)["totals"][1]) for b in batch.column("body").to_pylist()], pa.int64())], ["n"])

    return counted.where(F.col("kind") == 2).select("body").mapInArrow(read, "n long").agg(F.sum("n")).first()[0] or 0
