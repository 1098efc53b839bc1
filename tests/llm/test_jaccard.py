import random

import numpy as np

from cohortlens.llm import jaccard


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 4]) for i in range(len(w) - 3)) or (frozenset([tuple(w)]) if w else frozenset())


def brute(rows):
    sets, up = [shingles(t) for _, t in rows], list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    links = [0] * len(rows)
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                links[i] += 1
                links[j] += 1
                up[max(top(i), top(j))] = min(top(i), top(j))
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if top(j) == top(i) and rows[j][0] is not None]
        out.append((d, len(sets[i]), min(ids, default=None), links[i]))
    return sorted(out, key=str)


def found(docs):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["n_links"]) for r in jaccard.components(docs).collect()), key=str)


def families(prose, n_families=12, seed=5):
    """Near copies around the threshold, chains among them."""
    rng, rows = random.Random(seed), []
    for f in range(n_families):
        base = prose(f, rng.choice([6, 30, 120, 300])).split()
        for c in range(rng.choice([1, 2, 5, 30])):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 40))):
                w[rng.randrange(len(w))] = f"e{rng.randint(0, 400)}"
            if rng.random() < 0.3:
                base = w  # a chain
            rows.append((len(rows) * 7 % 1009, " ".join(w).upper() if c % 4 == 3 else "  ".join(w)))
    return rows


def test_same_as_brute_force(docs_of, prose):
    rows = families(prose)
    want = brute(rows)
    assert found(docs_of(rows)) == want
    assert len({w[2] for w in want}) < len(rows) - 20


def test_many_blocks_and_chunks(docs_of, prose, monkeypatch):
    monkeypatch.setattr(jaccard, "MEMBERS", 3)
    monkeypatch.setattr(jaccard, "QUERIES", 4)
    rows = families(prose, 8, seed=9)
    assert found(docs_of(rows)) == brute(rows)


def test_bound_never_closes_a_qualifying_group():
    rng = np.random.default_rng(1)
    for _ in range(3000):
        sizes = rng.integers(1, 60, 3)
        n = int(rng.integers(1, 60))
        overlap = int(rng.integers(0, n + 1))
        best = [np.minimum(overlap, s) for s in sizes]
        if any(100 * i >= 85 * (n + s - i) for i, s in zip(best, sizes)):
            assert jaccard.may_qualify(overlap, n, int(sizes.min()), int(sizes.max()))


def test_odd_rows_and_survivors(docs_of, odd_rows, prose):
    docs = docs_of(odd_rows)
    assert found(docs) == brute(odd_rows)
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    blank = [r for r in odd_rows if not (r[1] or "").split()]
    assert sorted([g for g in got if not (g[1] or "").split()], key=str) == sorted(blank, key=str)
    full = [g for g in got if (g[1] or "").split()]
    groups = {}
    for d, t in odd_rows:
        if (t or "").split():
            groups.setdefault(shingles(t), []).append(d)
    assert len(full) == len(groups)
    assert sorted(d for d, _ in full) == sorted(min(x for x in g if x is not None) for g in groups.values())
    assert found(docs_of([])) == [] and jaccard.one_of_each(docs_of([])).count() == 0
