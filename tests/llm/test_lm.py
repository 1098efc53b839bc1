import math
import zlib
from collections import Counter

import numpy as np
import pandas as pd

from cohortlens.llm import lm
from cohortlens.llm.queries import TOKENIZER


def test_gradient_is_right():
    rng = np.random.default_rng(1)
    w = {k: v.astype(np.float64) for k, v in lm.new_weights(np.full(lm.CLASSES, 1 / lm.CLASSES)).items()}
    x, y = rng.integers(0, lm.INPUTS, (3, 7)), rng.integers(0, lm.CLASSES, (3, 7))
    scored = (rng.random((3, 7)) < 0.8).astype(float)
    _, g = lm.gradient(w, x, y, scored)
    for k in w:
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in w[k].shape) if k != "embed" else (int(x[0, 1]), int(rng.integers(lm.DIM)))
            step, old = 1e-5, w[k][at]
            w[k][at] = old + step
            up = lm.gradient(w, x, y, scored)[0]
            w[k][at] = old - step
            down = lm.gradient(w, x, y, scored)[0]
            w[k][at] = old
            assert math.isclose((up - down) / (2 * step), g[k][at], rel_tol=1e-3, abs_tol=1e-7)


def test_attention_is_causal_and_windows_score_each_token_once():
    rng = np.random.default_rng(2)
    w = lm.new_weights(np.full(lm.CLASSES, 1 / lm.CLASSES), seed=4)
    w["head"] *= 20
    x = rng.integers(0, lm.INPUTS, 200)
    y = rng.integers(0, lm.CLASSES, 200)
    changed = x.copy()
    changed[20] = (changed[20] + 1) % lm.INPUTS
    a, _ = lm.forward(w, x[None, : lm.WINDOW])
    b, _ = lm.forward(w, changed[None, : lm.WINDOW])
    assert np.allclose(a[0, :20], b[0, :20]) and not np.allclose(a[0, 20:], b[0, 20:])
    got = lm.class_scores(w, [x, x[:5], x[:0]], [y, y[:5], y[:0]])
    want, begin = [], 0
    while begin < 200:
        start = max(0, begin - lm.OVERLAP)
        end = min(200, start + lm.WINDOW)
        z, _ = lm.forward(w, x[None, start:end])
        want += [z[0, i - start, y[i]] for i in range(begin, end)]
        begin = end
    assert np.allclose(got[0], want, atol=1e-4) and len(got[1]) == 5 and len(got[2]) == 0


def test_leads_are_first_ids():
    from cohortlens.llm.tokenfile import Encoder

    found = ["word.", "word", "it's", "<|endoftext|>", "<|endoftext|>.", "a<|endoftext|>", "'s.", "3.14,", "...", "é!!", "x" * 300 + "?", "漢字.", "\x1f", "ß***"]
    encoder = Encoder(TOKENIZER)
    whole = [encoder.tokenizer.encode(w, add_special_tokens=False).ids for w in found]
    assert encoder.leads(found).tolist() == [ids[0] if ids else 0 for ids in whole]


def test_counts_base_and_gain(spark, docs_of, odd_rows, prose):
    rows = [(100 + i, prose(i, 120)) for i in range(300)] + odd_rows
    got = lm.scores(docs_of(rows), TOKENIZER).collect()
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1
    count = Counter()
    for d, t in rows:
        if not held(d):
            count.update([*(t or "").encode().lower().split(), None])
    n, v = sum(count.values()), len(count)
    want = []
    for d, t in rows:
        tokens = [*(t or "").encode().lower().split(), None]
        want.append((str(d), held(d), len(tokens), sum(count[w] > 0 for w in tokens), n, round(sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens), 4)))
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in got) == sorted(want)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)


def test_model_learns_order(spark, docs_of):
    """Texts of alternating halves of a vocabulary: order tells more than counts do."""
    rng = np.random.default_rng(6)
    a, b = ["red", "green", "blue", "black", "white", "brown"], ["one", "two", "three", "four", "five", "six"]
    rows = [(i, " ".join(rng.choice(a if j % 2 else b) for j in range(400))) for i in range(250)]
    got = [r for r in lm.scores(docs_of(rows), TOKENIZER).collect() if r["held_out"]]
    assert sum(r["score"] for r in got) > 0.93 * sum(r["base_score"] for r in got)


def test_empty_tables(spark, docs_of):
    assert lm.scores(docs_of([]), TOKENIZER).count() == 0
    only_held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    r = lm.scores(docs_of([(only_held, "a b")]), TOKENIZER).collect()[0]
    assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) == (3, 0, 0, 0.0)


def test_windows_cover_every_token_once_and_all_train():
    ids = np.arange(100, dtype=np.uint16)
    w = lm.windows_of(ids)
    assert w[0, 0] == lm.START and (w[1:, 0] == w[:-1, -1]).all()
    tokens = w[:, 1:].ravel()
    assert tokens[:101].tolist() == [*range(100), lm.END] and (tokens[101:] == lm.PAD).all()
    assert len(lm.windows_of(ids[:0])) == 1 and len(lm.windows_of(np.zeros(lm.WINDOW - 1, np.uint16))) == 1
    turns = np.concatenate([lm.turns_of(name, 40) for name in range(200)])
    assert set(turns.tolist()) == set(range(lm.ROUNDS)) and np.bincount(turns.astype(int)).min() > 2000


def test_subwords_are_those_of_the_word():
    from cohortlens.llm.tokenfile import Encoder

    found = [b"word.", b"it's", "é!!".encode(), b"x" * 90, "漢字.".encode(), b"\x1f", b"<|endoftext|>"]
    encoder = Encoder(TOKENIZER)
    got = lm.Subwords.of(found, encoder)
    whole = [encoder.tokenizer.encode(w.decode(), add_special_tokens=False).ids for w in found]
    ids, n = got.spread(np.array([3, 0, 5, 0]))
    assert ids.tolist() == [*whole[3], *whole[0], *whole[5], *whole[0]] and n.tolist() == [len(whole[i]) for i in (3, 0, 5, 0)]


def test_classes_share_out_all_probability():
    rng = np.random.default_rng(4)
    count = rng.integers(0, 50, 3000) * rng.integers(0, 2, 3000)
    v = lm.Vocabulary(count, 7)
    per_class = np.bincount(v.class_of[:3000], np.exp(v.within[:3000]), lm.CLASSES)
    assert np.allclose(per_class[1:], 1) and v.within[lm.END] == 0 and v.class_of[lm.END] == 0
    told = lm.INPUTS - 3 - lm.SHARED_INPUTS
    assert len(set(v.input_of[np.lexsort((np.arange(3000), -count))[:told]].tolist())) == told


def test_scores_do_not_depend_on_partitions(spark, docs_of, odd_rows, prose, monkeypatch):
    monkeypatch.setattr(lm, "HOME_BYTES", 20_000)
    rows = [(100 + i, prose(i, 90)) for i in range(120)] + [r for r in odd_rows if r[0] not in (7, 8)]
    found, before = [], spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("4", "200"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            docs = docs_of(rows if n == "4" else rows[::-1])
            found.append(sorted(map(str, lm.scores(docs, TOKENIZER).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1]


def test_home_is_scored_from_its_reading():
    """A home's scores come from what its one reading kept, token by token as the network gives them."""
    texts = [b"the quick brown fox " * 30, b"", b"a \x1f word. it's", "漢字. é!! the fox".encode(), b"x " * 31, b"no more words. " * 9]
    docs = pd.DataFrame({"home": 0, "doc_id": [5, 3, 3, 9, None, 1], "version": range(6), "fold": [0, 0, 1, 2, 1, 0], "text": texts}).astype({"doc_id": "Int64"})
    out = lm.count_home(docs, TOKENIZER, 4)
    count = np.zeros(49_500, np.int64)
    for body in out["body"][out["kind"] == 3]:
        p = lm.loaded(body)
        count[p["id"]] = p["count"]
    vocabulary, w = lm.Vocabulary(count, 4), lm.new_weights(np.full(lm.CLASSES, 1 / lm.CLASSES))
    w["head"] *= 20
    got = lm.score_home(out[out["kind"] == 1], out[out["kind"] == 0].sample(frac=1, random_state=1), w, vocabulary, (300, 20, 4))
    assert len(lm.turn_windows(lm.loaded(out["body"][out["kind"] == 1].iloc[0]), 0)) > 0
    learned = Counter(x for t, f in zip(texts, docs["fold"]) if f != 1 for x in t.lower().split())
    encoder, want = lm.shared_encoder(TOKENIZER), []
    for d, t, f in zip(docs["doc_id"], texts, docs["fold"]):
        found = t.lower().split()
        each = [encoder.tokenizer.encode(x.decode(), add_special_tokens=False).ids for x in found]
        ids = np.array([i for e in each for i in e], np.int64)
        inputs, targets = vocabulary.input_of[np.r_[lm.START, ids]], np.r_[vocabulary.class_of[ids], 0]
        raw, begin = [], 0
        while begin < len(targets):
            start = max(0, begin - lm.OVERLAP)
            end = min(len(targets), start + lm.WINDOW)
            z, _ = lm.forward(w, inputs[None, start:end])
            raw += [z[0, i - start, targets[i]] for i in range(begin, end)]
            begin = end
        raw = np.array(raw) + np.r_[vocabulary.within[ids], 0]
        at = np.cumsum([0, *map(len, each)])
        model = [raw[a:b].sum() if b > a else -np.inf for a, b in zip(at, at[1:])] + [raw[-1]]
        plain = [math.log((learned[x] + 0.5) / (300 + 0.5 * 21)) for x in found] + [math.log(4.5 / (300 + 0.5 * 21))]
        score = np.logaddexp(np.log(1 - lm.MIX) + model, np.log(lm.MIX) + plain).sum()
        want.append((d, bool(f == 1), len(found) + 1, sum(learned[x] > 0 for x in found) + 1, round(sum(plain) / math.log(10), 6), round(float(score) / math.log(10), 3)))
    rows = zip(got["doc_id"], got["held_out"], got["n_tokens"], got["n_known"], got["base_score"].round(6), got["score"].round(3))
    assert sorted(map(str, rows)) == sorted(map(str, want))


def test_large_numbers_do_not_overflow():
    rng = np.random.default_rng(8)
    w = lm.new_weights(np.full(lm.CLASSES, 1 / lm.CLASSES))
    w["qkv"] *= 30
    w["head"] *= 2000
    x, y = rng.integers(0, lm.INPUTS, (5, lm.WINDOW)), rng.integers(0, lm.CLASSES, (5, lm.WINDOW))
    z, s = lm.forward(w, x)
    got, _, _ = lm.class_odds(w, s["h"], y)
    assert np.isfinite(got).all() and np.allclose(s["a"].sum(-1), 1, atol=1e-5) and not np.triu(s["a"][0], 1).any()
    assert np.allclose(got.reshape(y.shape), np.take_along_axis(z, y[..., None], 2)[..., 0], rtol=1e-4)


def test_words_are_encoded_as_texts_of_one_word():
    from cohortlens.llm.tokenfile import Encoder

    found = [b"word.", b"it's", "é!!".encode(), b"x" * 300, "漢字.".encode(), b"\x1f", b"<|endoftext|>", b"\xff\xfe.", b"\xe6\xbc", "a\u00a0b".encode()]
    assert Encoder(TOKENIZER).encode_words(found) == list(Encoder(TOKENIZER).encode(found)) and Encoder(TOKENIZER).encode_words([]) == []
