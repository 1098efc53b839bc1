import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from cohortlens.llm import align

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both():
    return align.Tokenizers(*PATHS)


def groups_of(both, text):
    """Groups of one whole text, token by token; None without tokens."""
    if not text:
        return None
    (a,), (b,) = both.encode([text])
    raw = (" " + text).encode()
    if b"".join(both.a_bytes[i] for i in a) != raw or b"".join(both.b_bytes[i] for i in b) != raw:
        return None
    ends = []
    for ids, of in ((a, both.a_bytes), (b, both.b_bytes)):
        at, mine = 0, []
        for i in ids:
            at += len(of[i])
            mine.append(at)
        ends.append(mine)
    common = sorted(set(ends[0]) & set(ends[1]))
    out, i, j = [], 0, 0
    for end in common:
        k, m = ends[0].index(end) + 1, ends[1].index(end) + 1
        out.append((a[i:k], b[j:m]))
        i, j = k, m
    return out


def brute(both, rows):
    found, count = [], Counter()
    for doc_id, text in rows:
        groups = groups_of(both, text)
        links = Counter((x, y) for a, b in groups or [] for x in a for y in b)
        count.update(links.keys())
        found.append((doc_id, groups, links))
    best = {}
    for (a, _), n in count.items():
        best[a] = max(best.get(a, 0), n)
    out = Counter()
    for doc_id, groups, links in found:
        told = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups or [])
        out[
            (
                doc_id,
                sum(len(a) for a, _ in groups or []),
                sum(len(b) for _, b in groups or []),
                len(groups or []),
                sum(links.values()),
                sum(n for p, n in links.items() if count[p] == best[p[0]]),
                sum(n * count[p] for p, n in links.items()),
                hashlib.sha256(told.encode()).hexdigest() if groups else "",
            )
        ] += 1
    total = Counter()
    for _, _, links in found:
        total.update(links)
    return out, {(a, b, n, total[a, b]) for (a, b), n in count.items()}


def tangled(rng):
    parts = ["the", "Übung", "naïve", " ", "  ", "\n", " \n", "\n ", "\t", "漢字", "🙂", "\xa0", "　", "x" * 9, "don't", "1234567", "...", "<s>", "</s>", "<|endoftext|>", "<0x41>", "\x00", "é", "ﬁ"]
    return "".join(rng.choice(parts) + rng.choice(["", " ", " "]) for _ in range(rng.randint(1, 40)))


def check(spark, docs_of, both, rows):
    want, pairs = brute(both, rows)
    got = align.alignment(docs_of(rows), both)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(tuple(r) for r in got.collect()) == want
    assert {tuple(r) for r in align.pair_counts(docs_of(rows), both).collect()} == pairs


def test_alignment_equals_brute_force(spark, docs_of, both, odd_rows, prose):
    rng = random.Random(2)
    odd = [r for r in odd_rows if len(r[1] or "") < 20_000]
    rows = [(100 + i, tangled(rng)) for i in range(250)] + [(500 + i, prose(i % 30, 60)) for i in range(60)]
    rows += [(700, "a▁b"), (701, "▁"), (702, " "), (703, " lead"), (704, "trail "), (705, "漢" * 400), (706, "ab" * 900)]
    check(spark, docs_of, both, rows + odd)


def test_no_rows_and_no_tokens(spark, docs_of, both):
    assert align.alignment(docs_of([]), both).count() == 0
    check(spark, docs_of, both, [(1, None), (1, ""), (None, None)])


def test_small_blocks_caches_and_slices(both, monkeypatch):
    rng = random.Random(4)
    texts = [tangled(rng) for _ in range(60)] + ["a b a b", "漢字" * 30]
    _, pairs = brute(both, list(enumerate(texts)))
    for name, value in {"AT_ONCE": 7, "CACHED": 20}.items():
        monkeypatch.setattr(align, name, value)
    aligner, blobs = align.Aligner(both), []
    for at in range(0, len(texts), 9):
        _, _, pair, doc, links = aligner.block(texts[at : at + 9])
        pair, doc, links = align.ordered(pair, doc, links, len(aligner.a_len) * aligner.width)
        if len(pair):
            blobs.append(align.postings(pair, doc, links, 9))
    found, documents, links = align.pair_totals(blobs)
    assert {(p // aligner.width, p % aligner.width, n, m) for p, n, m in zip(found.tolist(), documents.tolist(), links.tolist())} == pairs


def test_postings_round_trip():
    rng = np.random.default_rng(3)
    n_docs = 300
    rows = sorted({(int(p) ** 3, int(d)) for p, d in zip(rng.integers(0, 40, 4000), rng.integers(0, n_docs, 4000))} | {(7, d) for d in range(5)})
    pair, doc = (np.array(x) for x in zip(*rows))
    links = rng.integers(1, 200_000, len(rows)) >> rng.integers(0, 17, len(rows)) | 1
    p = align.Postings(align.postings(pair, doc, links, n_docs))
    documents, total = p.counts()
    assert p.pairs.tolist() == sorted(set(pair.tolist()))
    for i, name in enumerate(p.pairs):
        assert documents[i] == (pair == name).sum() and total[i] == links[pair == name].sum()
    score = rng.integers(0, 1000, (len(p.pairs), 2))
    sums = np.zeros((n_docs, 2), np.int64)
    for a, d, m in zip(pair, doc, links):
        sums[d] += m * score[np.searchsorted(p.pairs, a)]
    assert (p.return_scores(score) == sums).all()


def test_packed_and_general_order_agree():
    rng = np.random.default_rng(5)
    pair, doc, links = rng.integers(0, 50, 999), rng.integers(0, 90, 999), rng.integers(1, 9, 999)
    one, other = align.ordered(pair, doc, links, 1 << 31), align.ordered(pair, doc, links, 1 << 40)
    assert all((x == y).all() for x, y in zip(one, other))
