from collections import Counter

import corpus_pipeline
from cohortlens.llm import mixing, sharding, toxicity
from cohortlens.llm.queries import MIX


def shingles(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def first_of_groups(texts):
    """Smallest id of every component of similar documents, by brute force."""
    sets, up = {d: shingles(t, 5) for d, t in texts.items()}, {d: d for d in texts}

    def top(d):
        while up[d] != d:
            d = up[d]
        return d

    ids = sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                up[max(x, y)] = min(x, y)
    return {top(d) for d in texts}


def contaminated(texts, items):
    needs = [shingles(t, 5) for t in items.values()]
    return {d for d, t in texts.items() for have in [shingles(t, 5)] for need in needs if need and 100 * len(have & need) >= 80 * len(need)}


def test_stages_take_effect(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("labels", "benchmark"))
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_copies", "decontamination", "mixing", "sharding"]
    one, two, three, four, five = (f for _, f in corpus_pipeline.STAGES)
    toxic = {r["doc_id"] for r in toxicity.toxicity(docs, labels).collect() if r["predicted"]}
    first = one(spark, docs, folder)
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = {r["doc_id"]: r["text"] for r in first.collect()}
    assert kept == {d: t for d, t in rows.items() if d not in toxic}
    second = two(spark, first, folder)
    got = {r["doc_id"]: r["text"] for r in second.collect()}
    assert set(got) == first_of_groups(kept)
    third = three(spark, second, folder)
    clean = {r["doc_id"]: r["text"] for r in third.collect()}
    bad = contaminated(got, {r["item_id"]: r["text"] for r in items.collect()})
    assert set(clean) == set(got) - bad
    taken = {r["doc_id"]: r["taken_tokens"] for r in mixing.mix_documents(third, MIX).collect()}
    fourth = four(spark, third, folder)
    tokens = Counter()
    for r in fourth.collect():
        tokens[r["doc_id"]] += len(r["text"].encode().split())
    assert dict(tokens) == {d: n for d, n in taken.items() if n}
    assert first.columns == second.columns == third.columns == fourth.columns == docs.columns
    last = five(spark, fourth, folder).collect()
    assert Counter(r["doc_id"] for r in last) == Counter(r["doc_id"] for r in fourth.collect())
    assert all((r["shard"], r["slot"]) == sharding.locate(r["row_number"], len(last), 24, 20) for r in last)
    whole = corpus_pipeline.run(spark, folder).collect()
    assert sorted(map(tuple, whole), key=str) == sorted(map(tuple, last), key=str)


def similarity(a, b, k):
    x, y = shingles(a, k), shingles(b, k)
    return len(x & y) / len(x | y)


def test_near_copies_between_the_thresholds(spark, docs_of, prose, folder):
    rows, want = [], []
    for i in range(12):
        base, more = prose(2000 + i, 200), prose(3000 + i, 60).split()
        added = base + " " + " ".join(more[: 40 + (i % 3) * 10])  # 20 to 30% more
        cut = " ".join(base.split()[: 200 - (30 + i % 3 * 8)])  # 15 to 23% less
        rows += [(10 * i, base), (10 * i + 1, added), (10 * i + 2, cut)]
        want.append(10 * i)
        # groups are transitive, but the two copies are too far apart to be linked with one another
        want += [10 * i + j for j, t in ((1, added), (2, cut)) if similarity(base, t, 5) < 0.8]
    near = [(a, b) for i in range(12) for a, b in ((rows[3 * i][1], rows[3 * i + j][1]) for j in (1, 2))]
    assert sum(similarity(a, b, 5) >= 0.8 and similarity(a, b, 4) < 0.85 for a, b in near) >= 8
    assert any(similarity(a, b, 5) < 0.8 for a, b in near)
    kept = dict(corpus_pipeline.STAGES)["near_copies"](spark, docs_of(rows), folder)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(want)


def test_stages_take_odd_rows_and_empty_tables(spark, docs_of, odd_rows, folder):
    """Nulls, empty and very long texts, repeated ids and rows, further columns; then no rows at all."""
    rows = [r if len(r) == 4 else (*r, "en", "src1") for r in odd_rows] + [(90, "x y z", None, None), (91, None, None, "src2")]
    for docs in (docs_of(rows), docs_of([])):
        names, n = docs.columns, docs.count()
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, folder)
            assert docs.columns == names, name
            kept = docs.count()
            if name != "mixing":
                assert kept <= n
            n = kept
        last = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
        assert last.count() == n and {"doc_id", "shard", "slot"} <= set(last.columns)


def test_copies_leave_one_row_each(spark, docs_of, odd_rows, folder):
    kept = dict(corpus_pipeline.STAGES)["near_copies"](spark, docs_of(odd_rows), folder).collect()
    texts = [r["text"] for r in kept if r["text"] and r["text"].split()]
    assert len(texts) == len(set(texts))
