import random
import zlib

import numpy as np

from cohortlens.llm import toxicity


def corpus(prose, n=700, seed=3):
    rng, rows, labels = random.Random(seed), [], []
    for i in range(n):
        words, toxic = prose(i, rng.randint(20, 150)).split(), i % 5 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["idiot", "grumbly", "grumblex", "Grumblor,", "1d10t"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, toxic int")


def test_held_out_documents_are_told_apart(spark, docs_of, prose, odd_rows):
    rows, labels = corpus(prose)
    extra = [(d + 5000 if d is not None else None, t) for d, t in odd_rows]
    got = toxicity.toxicity(docs_of(rows + extra), labels_of(spark, [*labels, (1, None), (None, 1), (3, 0), (9999, 1)])).collect()
    assert len(got) == len(rows) + len(extra)
    truth = dict(labels)
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        assert r["held_out"] == (zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 5 == 0)
    held = [(truth[r["doc_id"]], r["score"], r["predicted"]) for r in got if r["held_out"] and r["doc_id"] in truth]
    pos, neg = [s for y, s, _ in held if y], [s for y, s, _ in held if not y]
    assert np.mean([p > n for p in pos for n in neg]) > 0.95
    assert np.mean([y == p for y, _, p in held]) > 0.95
    docs = docs_of(rows + extra)
    kept = toxicity.without_toxic(docs, labels_of(spark, labels))
    assert kept.columns == docs.columns
    clean = {r["doc_id"] for r in got if r["predicted"] == 0}
    assert {r["doc_id"] for r in kept.collect()} == clean


def test_without_usable_labels(spark, docs_of, odd_rows):
    docs = docs_of(odd_rows)
    assert {r["score"] for r in toxicity.toxicity(docs, labels_of(spark, [])).collect()} == {0.0}
    assert {r["score"] for r in toxicity.toxicity(docs, labels_of(spark, [(i, 1) for i in range(20)])).collect()} == {1.0}
    assert toxicity.toxicity(docs_of([]), labels_of(spark, [(1, 1)])).count() == 0


def test_isotonic_is_the_best_monotone_fit():
    rng = np.random.default_rng(1)
    x = rng.normal(size=300)
    y = (rng.random(300) < 1 / (1 + np.exp(-x))).astype(float)
    at, share = toxicity.isotonic(x, y)
    assert (np.diff(at) > 0).all() and (np.diff(share) > 0).all()
    assert abs(y.mean() - sum(share * np.diff(np.r_[0, np.searchsorted(np.sort(x), (at[1:] + at[:-1]) / 2), 300]) / 300)) < 0.05


def test_trees_separate_an_interaction():
    rng = np.random.default_rng(2)
    x = rng.random((2000, 4))
    y = ((x[:, 0] > 0.5) & (x[:, 2] < 0.4)).astype(float)
    assert ((toxicity.fit_trees(x, y).margin(x) > 0) == (y > 0)).mean() > 0.97


def test_features_are_finite_for_any_text():
    lexicon = toxicity.Lexicon({b"idiot": 2.0, b"grum*": 1.0})
    for raw in (b"", b" ", b"\xff\xfe", b"IDIOT!!! you 1d10t", b"a" * 100_000):
        assert len(toxicity.features(raw, lexicon)) == len(toxicity.NAMES) and np.isfinite(toxicity.features(raw, lexicon)).all()
    assert toxicity.features(b"you 1d10t", lexicon)[13] == 1 and toxicity.features(b"grumble", lexicon)[5] == 1
